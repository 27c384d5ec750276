"""BPE with word ends, by prefix dynamic programming over a suffix automaton.

The tokenizer's file gives a vocabulary and ranked merges of pairs.  A word's
symbols are its characters in the byte alphabet, the last one with the end of
the word.  Every prefix of the symbols has one BPE encoding and so one last
token; that is stored for each prefix, and the ids are read off from the last
prefix backwards.

Which tokens end at a prefix is told by a suffix automaton of the vocabulary:
its state after a symbol is the longest suffix that occurs in any token, and
the suffix links from there lead through all shorter ones; each state knows
the next state on its links that is a token.  A token is the prefix's last one
exactly if it may follow the last token of the prefix before it: the pieces at
the two tokens' facing edges each exist from the merge that makes them to the
merge that takes them in, and no two of them that exist together may be a pair
whose merge is due.

What comes before the model is the file's own: its added tokens are cut out of
the raw text, then each white-space-delimited chunk is normalised and cut into
words by the tokenizers library's normaliser and pre-tokenizer, or, where it's
all ASCII, by the same rules here.

Defined cases: null text counts as empty, which has no ids and decodes to
nothing.  Repeated rows each get a result row; an empty table gives none.
Texts and words of any length are encoded whole (a word's time and memory grow
with its length).  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import table, text_of

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
#: A symbol that ends a word is one character, this far above the plain one.
ENDS = 0x1000
NEVER = 1 << 40
#: Entries of a worker's memo of chunks, of words, and of pairs; then the one before it goes.
MEMO = 250_000
#: Rows encoded at a time, and ids decoded at a time, about.
SLICE, IDS = 128, 1_000_000
#: Chunks are cut at the tokenizer's white space, which, other than str.split()'s, lacks U+001C to U+001F.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
CHUNK = re.compile("(?:[^\\s]|[\x1c-\x1f])+")
#: One of these after letters is a word of its own.
MARKS = frozenset(".,;:!?")
#: The pre-tokenizer's pattern for lower-cased ASCII without white space.
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where printable in Latin-1, else the next from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values
    others = [b for b in range(256) if b not in printable]
    return [chr(b if b in printable else 256 + others.index(b)) for b in range(256)]


class SuffixAutomaton:
    """Suffix automaton of many words; a word's state is known by ``state_of``."""

    def __init__(self, words: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = array("i", [-1]), array("i", [0])
        for word in words:
            last = 0
            for ch in word:
                last = self._extend(last, ch)
        self.link, self.length = self.link.tolist(), self.length.tolist()

    def _state(self, length: int, follow: dict[str, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, ch: str) -> int:
        """The state of p's longest string and ``ch``, apart from the longer strings of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        new = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(ch) == q:
            self.next[p][ch] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, ch: str) -> int:
        if (q := self.next[last].get(ch)) is not None:
            return self._split(last, q, ch)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and ch not in self.next[p]:
            self.next[p][ch] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][ch], ch)
        return new

    def state_of(self, word: str) -> int:
        at = 0
        for ch in word:
            at = self.next[at][ch]
        return at


class WordBpe:
    """A vocabulary's automaton, how its tokens are merged, and which may stand together."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = WORD_END):
        self.end = end
        self.ids = {self._symbols(t): i for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            pair = vocab[a], vocab[b]
            self.rank[pair] = rank
            self.joined[pair] = vocab[a + b]
            self.made_by.setdefault(vocab[a + b], pair)
        self.edges: dict[tuple[int, bool], list[tuple[int, int, int]]] = {}
        #: Tokens that merging makes of their own symbols; no others ever come out of it.
        made = {s: i for s, i in self.ids.items() if self.merged(s) == [i]}
        most = max(vocab.values()) + 1
        #: For each token, those it was asked to follow and whether it may.
        self.pairs: list[dict[int, bool]] = [{} for _ in range(most)]
        self.asked = 0
        sam = self.sam = SuffixAutomaton(made)
        token, above = [-1] * len(sam.next), [-1] * len(sam.next)
        for s, i in made.items():
            token[sam.state_of(s)] = i
        for v in sorted(range(1, len(sam.next)), key=sam.length.__getitem__):
            above[v] = token[sam.link[v]] if token[sam.link[v]] >= 0 else above[sam.link[v]]
        #: The longest token at a state's end: all of its string included, or only shorter ones.
        self.whole, self.above = [t if t >= 0 else a for t, a in zip(token, above)], above
        #: Of each token its number of symbols and the next shorter token that ends it.
        self.size, self.shorter = [0] * most, [-1] * most
        for s, i in made.items():
            self.size[i], self.shorter[i] = len(s), above[sam.state_of(s)]

    def _symbols(self, token: str) -> str:
        body = token.removesuffix(self.end)
        return body if body == token or not body else self.word(body)

    def word(self, characters: str) -> str:
        """The symbols of a whole word."""
        return characters[:-1] + chr(ord(characters[-1]) + ENDS)

    def merged(self, symbols: str) -> list[int]:
        """Ids by merging the pair of least rank, the leftmost first, until none is left (for tokens)."""
        if any(s not in self.ids for s in symbols):
            return []
        ids = [self.ids[s] for s in symbols]
        while len(ids) > 1:
            ranks = [self.rank.get(p, NEVER) for p in zip(ids, ids[1:])]
            if (least := min(ranks)) == NEVER:
                break
            at = ranks.index(least)
            ids[at:at + 2] = [self.joined[ids[at], ids[at + 1]]]
        return ids

    def _edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(piece, rank that makes it, rank that takes it in) along a token's edge, the token first."""
        if (known := self.edges.get((token, right))) is None:
            known, piece, taken = [], token, NEVER
            while piece is not None:
                pair = self.made_by.get(piece)
                rank = -1 if pair is None else self.rank[pair]
                known.append((piece, rank, taken))
                piece, taken = (None if pair is None else pair[right]), rank
            self.edges[token, right] = known
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the symbols of a and b ends with just these two tokens."""
        if (known := self.pairs[b].get(a)) is None:
            self.asked += 1
            if self.asked > MEMO:
                self.asked = 0
                for held in self.pairs:
                    held.clear()
            known = self.pairs[b][a] = not any(
                x_made < y_taken and y_made < x_taken and (due := self.rank.get((x, y), NEVER)) < x_taken and due <= y_taken
                for x, x_made, x_taken in self._edge(a, True) for y, y_made, y_taken in self._edge(b, False) if (x, y) in self.rank)
        return known

    def last_tokens(self, symbols: str) -> list[int]:
        """The last token of each prefix of the symbols, the empty one first (-1)."""
        follow, link, length, whole, above, size, shorter, pairs = (
            self.sam.next, self.sam.link, self.sam.length, self.whole, self.above, self.size, self.shorter, self.pairs)
        last, at, held, stop = [-1], 0, 0, 0
        for ch in symbols:
            stop += 1
            while (to := follow[at].get(ch)) is None and at:
                at = link[at]
                held = length[at]
            if to is None:
                raise ValueError(f"no token for {ch!r}")
            at, held = to, held + 1
            # Longest first: the state itself if all of it is matched, then up the links.
            t = whole[at] if held == length[at] else above[at]
            while t >= 0:
                if stop == size[t]:
                    break
                before = last[stop - size[t]]
                if (fits := pairs[t].get(before)) or fits is None and self.may_follow(before, t):
                    break
                t = shorter[t]
            else:
                raise ValueError("a prefix without a last token")
            last.append(t)
        return last

    def encode(self, symbols: str) -> list[int]:
        last, out, at = self.last_tokens(symbols), [], len(symbols)
        while at:
            out.append(last[at])
            at -= self.size[out[-1]]
        return out[::-1]


class Chunks(dict):
    """Ids (as unsigned 32-bit integers) of white-space-delimited chunks, made when asked for."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = WordBpe(model["vocab"], merges, model["end_of_word_suffix"])
        tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or "(?!)")
        self.normal, self.words = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.alphabet = "".join(byte_alphabet())
        self.known: dict[str, bytes] = {}
        self.old, self.old_known = {}, {}  # the memos before
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}

    def word(self, characters: str) -> bytes:
        """Ids of a word in the byte alphabet."""
        if (ids := self.known.get(characters)) is None:
            if (ids := self.old_known.get(characters)) is None:
                ids = array("I", self.bpe.encode(self.bpe.word(characters))).tobytes()
            if len(characters) <= 64:
                if len(self.known) >= MEMO:
                    self.old_known, self.known = self.known, {}
                self.known[characters] = ids
        return ids

    def _cut(self, chunk: str) -> list[str]:
        """A chunk's words in the byte alphabet."""
        mark = chunk[-1] if chunk[-1] in MARKS else ""
        core = (chunk[:-1] if mark else chunk).lower()
        if core.isalpha() and (core.isascii() or max(core) <= "\u017f"):  # composed Latin letters are one word, as they are
            word = core if core.isascii() else core.encode().decode("latin-1").translate(self.alphabet)
            return [word, mark] if mark else [word]
        if chunk.isascii():
            words = ASCII_WORD.findall(chunk.lower())
            return words if chunk.isprintable() else [w.translate(self.alphabet) for w in words]
        return [w for w, _ in self.words(self.normal(chunk))]

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.old.get(chunk)) is None:
            ids = b"".join(map(self.word, self._cut(chunk)))
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def text(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            parts = self.cut.split(text)
            return b"".join(array("I", [self.added[p]]).tobytes() if p in self.added else self.text(p) for p in parts if p)
        chunks = CHUNK.findall(text) if any(c in text for c in ODD_SPACE) else text.split()
        return b"".join(map(self.__getitem__, chunks))


@lru_cache(maxsize=1)
def chunks_of(path: str) -> Chunks:
    return Chunks(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): each row's token ids."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = chunks_of(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                ids = [memo.text(t) for t in b.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").view("<i4"))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the tokens' own strings, special ones included, joined by spaces.

    That is what the tokenizers library's decode() returns for a file without a decoder.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = chunks_of(path).names
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                texts = [" ".join(map(names.__getitem__, row.values.to_numpy().tolist())) for row in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(encode(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
