"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has one BPE encoding, and so one last token.  A
token t that ends at position i is that last token exactly if merging can't
cross the boundary between it and the last token of the prefix before it.  So
a table with each prefix's last token is filled from left to right, the ids
are read off from right to left, bytes can be appended without touching what
is there, and after an edit only the positions up to where the table agrees
again are filled anew.

Whether merging crosses the boundary of (a, b) follows from the tokens' own
merges: the pieces at a's right edge and at b's left edge each exist from the
merge that makes them to the merge that takes them in; if a pair of pieces
exists together when its own merge is due, it merges.  Of merges of equal
rank the left one is done first.

As the tiktoken library does, the text is cut by a pattern first and each
match encoded on its own; a match that is a token itself is that token.

Defined cases: null text counts as empty, which has no tokens.  Repeated rows
each get a result row; an empty table gives none.  Texts of any length are
encoded whole, never cut but by the pattern; a match's time and memory grow with
its length.  Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, text_of

RANKS = "byte_bpe_multi_50k.tiktoken"
NEVER = 1 << 40
#: Entries at most in a worker's memo of pieces, and of pairs; then it starts anew.
MEMO = 300_000
SLICE = 256


class Vocabulary:
    """Ranks, how each token is made, and which pairs of tokens may stand together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, int, int]]] = {}
        #: Tokens that merging makes; others only stand for whole matches.
        self.made = {k: v for k, v in ranks.items() if self.merged(k, NEVER) == [v]}
        self.matcher = ahocorasick.Automaton()
        for k, v in self.made.items():
            self.matcher.add_word(k.decode("latin-1"), (len(k), v))
        self.matcher.make_automaton()

    def merged(self, data: bytes, below: int) -> list[int]:
        """Ids of ``data`` after all merges of a rank under ``below``, the plain way (for tokens)."""
        ids = [self.ranks[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            ways = [self.ranks.get(self.bytes[a] + self.bytes[b], NEVER) for a, b in zip(ids, ids[1:])]
            if (least := min(ways)) >= below:
                break
            at = ways.index(least)
            ids[at:at + 2] = [least]
        return ids

    def edge(self, token: int, right: bool) -> list[tuple[bytes, int, int]]:
        """(piece, rank that makes it, rank that takes it in) at a token's edge, the token first."""
        if (found := self.edges.get((token, right))) is None:
            found, piece, end = [], token, NEVER
            while True:
                if piece not in self.halves:
                    cut = self.merged(self.bytes[piece], piece)
                    self.halves[piece] = (cut[0], cut[1]) if len(cut) == 2 else None
                parts = self.halves[piece]
                found.append((self.bytes[piece], piece if parts else -1, end))
                if not parts:
                    break
                piece, end = parts[right], piece
            self.edges[token, right] = found
        return found

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a, b is what merging makes of their bytes."""
        if (known := self.pairs.get(a << 32 | b)) is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self._stays(a, b)
        return known

    def _stays(self, a: int, b: int) -> bool:
        rank, lefts = self.ranks.get, self.edge(b, False)
        for x, x_made, x_end in self.edge(a, True):
            for y, y_made, y_end in lefts:
                if x_made < y_end and y_made < x_end and (way := rank(x + y)) is not None and way < x_end and way <= y_end:
                    return False
        return True

    def encode(self, data: bytes) -> list[int]:
        """Ids of a byte string, by the table of its prefixes' last tokens."""
        pairs, last, filled = self.pairs.get, [-1], 0
        for stop, (size, token) in self.matcher.iter(data.decode("latin-1")):
            if stop >= filled:
                before = stop + 1 - size
                if not before or (fits := pairs(last[before] << 32 | token)) or fits is None and self.may_follow(last[before], token):
                    last.append(token)
                    filled = stop + 1
        if filled != len(data):
            raise ValueError("bytes without a token")
        out = []
        while filled:
            out.append(last[filled])
            filled -= len(self.bytes[out[-1]])
        return out[::-1]


class PrefixTable:
    """The last token of every prefix of a byte string that grows and changes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self._fill(self.data + more, len(self.data), self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:end]; returns how many positions were filled anew."""
        old, shift = self.last, len(new) - (end - start)
        data = self.data[:start] + new + self.data[end:]
        return self._fill(data, start, old[:start + 1], old, start + len(new), shift)

    def _fill(self, data: bytes, start: int, last: list[int], old: list[int] | None = None, after: int = 0, shift: int = 0) -> int:
        longest, follow = self.v.longest, self.v.may_follow
        base = max(0, start - longest)  # a token that ends after start begins after this
        self.data, done, same = data, start, 0
        for stop, (size, token) in self.v.matcher.iter(data[base:].decode("latin-1")):
            end = base + stop + 1
            if end <= done:
                continue
            before = end - size
            if before == 0 or follow(last[before], token):
                last.append(token)
                done = end
                if old is not None and end >= after + 1:
                    # Equal bytes and as many equal entries as a token is long: the rest is equal.
                    same = same + 1 if old[end - shift] == token else 0
                    if same >= longest and end >= after + longest:
                        last.extend(old[end - shift + 1:])
                        break
        self.last = last
        if len(last) != len(data) + 1:
            raise ValueError("bytes without a token")
        return done - start

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.v.bytes[out[-1]])
        return out[::-1]


class Pieces(dict):
    """Encoded pieces of text, as little-endian unsigned 32-bit ids, made when asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.v.ranks.get(data)
        ids = [whole] if whole is not None else self.v.encode(data)
        out = np.array(ids, "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = out
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(vocabulary(path))


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids): each row's ids as little-endian unsigned 32-bit integers."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, find = pieces(path), regex.compile(pattern).findall
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                ids = [b"".join(map(memo.__getitem__, find(t.as_py()))) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that each row's ids stand for."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path).bytes
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                texts = [b"".join(map(known.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist())) for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(encode(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
