"""Packing token sequences: best fit, then swap-based local search.

Items (documents' token counts) are dealt into groups of about ``GROUP`` by a
hash that spreads repeated rows too.  In a group, best fit decreasing fills
bins; then items are exchanged between the emptiest bin and the others that
have room: a move, one for one, two for one or one for two, always the
exchange that fills the receiver most.  Each exchange raises the sum of
squared fills, so the search ends; a bin that has lost all items is gone.
It stops at the lower bound (total length over the capacity) or when no
exchange helps.  Bins still under ``OPEN`` of the capacity are taken apart and
their items packed again in the next round, over fewer, larger-reaching
groups, so that a group's last bins aren't lost space.

Only texts of more tokens than a sequence holds are cut, into full pieces and
one rest; full pieces are sequences of their own.

Defined cases: null text counts as empty and has the end id alone; repeated
rows are packed each; an empty table gives an empty one; texts of any length are
encoded whole; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import is_

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import materialise, table, text_of

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
#: Items of a group, about; the share of a bin under which it's packed again.
GROUP = 4096
OPEN = 0.99
#: Words of a generation of the memo, about; rows, and about how many bytes of text, encoded at a time.
MEMO = 500_000
SLICE, BYTES = 2048, 4_000_000
#: What str.split() takes for white space and the tokenizer's \s doesn't, and words as the latter cuts them.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
WORD = re.compile("(?:[^\\s]|[\x1c-\x1f])+")


class Words:
    """Encoded words of a tokenizer that looks at each white-space-delimited word alone.

    Most new words are Latin letters and at most one punctuation mark, which the
    tokenizer would lower-case and cut apart, then encode in the byte alphabet.
    That is done here for all of them, and the letters go straight to its model;
    any other word goes through the whole tokenizer.  A text that holds an added
    token's string goes to the tokenizer whole, in its default setting.  Words
    are kept in two generations: once the memo is full, it's the old one.
    """

    MARKS = ".,;:!?"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_file(path)
        #: The same model without added tokens, and without what comes before it.
        self.tokenizer, self.model = Tokenizer(self.whole.model), Tokenizer(self.whole.model)
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole.normalizer, self.whole.pre_tokenizer
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: bytes that stand for themselves
        others = [b for b in range(256) if b not in printable]
        self.alphabet = "".join(chr(b if b in printable else 256 + others.index(b)) for b in range(256))
        self.marks = {m: self._ids(self.tokenizer, [m])[0] for m in self.MARKS} | {"": b""}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.large: list[str] = []

    @staticmethod
    def _ids(tokenizer: Tokenizer, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encoded(self, texts: list[str]) -> list[bytes]:
        whole = [any(a in t for a in self.added) for t in texts]
        cut = [() if w else WORD.findall(t) if any(c in t for c in ODD_SPACE) else t.split() for t, w in zip(texts, whole)]
        for w in self.large:  # of the slice before
            self.known.pop(w, None)
        if len(self.known) > MEMO:
            self.old, self.known = self.known, {}
        known = self.known
        parts = [list(map(known.get, c)) for c in cut]
        gaps = [list(compress(range(len(p)), map(is_, p, repeat(None)))) for p in parts]  # where a word is new
        self.learn({c[i] for c, g in zip(cut, gaps) for i in g})
        for c, p, g in zip(cut, parts, gaps):
            for i in g:
                p[i] = known[c[i]]
        return [self._ids(self.whole, [t])[0] if w else b"".join(p) for t, p, w in zip(texts, parts, whole)]

    def learn(self, words: set[str]) -> None:
        known, old, alphabet = self.known, self.old, self.alphabet
        again = {w: old[w] for w in words if w in old}
        known.update(again)
        marks, letters, odd, plain = self.marks, [], [], set()
        for w in words.difference(again) if again else words:
            if w.isalpha():
                core, mark = w, ""
            else:
                core, mark = w[:-1], w[-1]
                if mark not in marks or not core.isalpha():
                    odd.append(w)
                    continue
            low = core.lower()
            if not core.isascii() and (not low.isalpha() or max(low) > "\u017f"):  # not composed Latin letters
                odd.append(w)
                continue
            if low not in known:
                plain.add(low)
            if low is not w:
                letters.append((w, low, marks[mark]))
        cores = {c: old[c] for c in plain if c in old}
        new = list(plain.difference(cores) if cores else plain)
        bytes_ = [c if c.isascii() else c.encode().decode("latin-1").translate(alphabet) for c in new]
        known.update(cores)
        known.update(zip(new, self._ids(self.model, bytes_)))
        for w, low, more in letters:
            known[w] = known[low] + more
        known.update(zip(odd, self._ids(self.tokenizer, odd)))
        self.large = [w for held in (new, odd) for w in held if len(w) > 256]
        self.large += [w for w, low, _ in letters if len(low) > 255]


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def tokenise(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): each row's ids and the end id, as little-endian unsigned 32-bit integers."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids_of, ids in _tokens(batches, path, end_id):
            yield pa.RecordBatch.from_arrays([ids_of, pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def _tokens(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """The ids of the batches' texts, some rows at a time, with the rows' doc_ids."""
    memo, end = words_of(path), np.array([end_id], "<u4").tobytes()
    for whole in batches:
        at, sizes = 0, pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False).cumsum()
        while at < whole.num_rows:
            stop = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES, "right"))
            b = whole.slice(at, min(max(stop - at, 1), SLICE))
            at += b.num_rows
            yield b.column(0), [x + end for x in memo.encoded(b.column(1).to_pylist())]


PIECES = "piece int, start long, length long, ids_crc32 long"


def _cut(ids_of: pa.Array, ids: Iterable[bytes], capacity: int) -> pa.RecordBatch:
    """The pieces of rows' ids."""
    rows, out = [], []
    for i, data in enumerate(map(memoryview, ids)):
        for start in range(0, len(data) // 4, capacity):
            part = data[4 * start:4 * (start + capacity)]
            rows.append(i)
            out.append((start // capacity, start, len(part) // 4, zlib.crc32(part)))
    cols = [pa.array(c) for c in np.array(out, np.int64).reshape(-1, 4).T]
    return pa.RecordBatch.from_arrays([ids_of.take(pa.array(rows, pa.int64())), cols[0].cast(pa.int32()), *cols[1:]],
                                      ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row's ids, cut only where longer than the capacity."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _cut(b.column(0), (x.as_buffer() for x in b.column(1)), capacity)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, {PIECES}")


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The :func:`pieces` of each row's tokens, the tokens themselves never leaving the worker."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids_of, ids in _tokens(batches, path, end_id):
            yield _cut(ids_of, ids, capacity)

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers, by best fit decreasing."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), sorted
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        if left > lengths[i]:
            insort(room, (left - lengths[i], k))
    return bins


def _choices(items: list[int], lengths: list[int], most: int) -> dict[int, tuple[int, ...]]:
    """A way to take up to ``most`` items for each sum that they can have."""
    by = {lengths[i]: i for i in items}
    out = {n: (i,) for n, i in by.items()}
    if most > 1:
        counts = Counter(lengths[i] for i in items)
        for a, i in by.items():
            for b, j in by.items():
                if a < b:
                    out.setdefault(a + b, (i, j))
                elif a == b and counts[a] > 1:
                    out.setdefault(a + b, (i, next(k for k in items if k != i and lengths[k] == a)))
    return out


def exchange(donor: list[int], receiver: list[int], room: int, lengths: list[int]) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """What to give and to take back so that the receiver's fill grows most: (1 or 2, 0), (1, 1), (2, 1) or (1, 2) items."""
    give, take = _choices(donor, lengths, 2), _choices(receiver, lengths, 2)
    take[0] = ()
    a, b = np.array(sorted(give)), np.array(sorted(take))
    best, found = 0, None
    for n in a.tolist():
        # The largest gain is the smallest sum taken back that still fits; two for two isn't among the exchanges.
        at = int(np.searchsorted(b, n - room))
        while at < len(b) and len(give[n]) + len(take[int(b[at])]) > 3:
            at += 1
        if at < len(b) and best < n - b[at] <= room:
            best, found = int(n - b[at]), (give[n], take[int(b[at])])
    return found


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search on bins; the sum of squared fills grows with each step."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    while len(bins) > least:
        order = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=fill.__getitem__)
        step = None
        for d in order[:2]:  # the emptiest bin, else the next
            for r in reversed(order):
                if r != d and fill[r] >= fill[d] and (step := exchange(bins[d], bins[r], capacity - fill[r], lengths)):
                    break
            if step:
                break
        if not step:
            break
        out, back = step
        bins[d] = [i for i in bins[d] if i not in out] + list(back)
        bins[r] = [i for i in bins[r] if i not in back] + list(out)
        moved = sum(lengths[i] for i in out) - sum(lengths[i] for i in back)
        fill[d], fill[r] = fill[d] - moved, fill[r] + moved
        if not bins[d]:
            bins[d], fill[d] = bins[-1], fill[-1]
            bins.pop()
            fill.pop()
    return bins


def pack_group(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, the bin's fill) of each item."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    where, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for k, items in enumerate(bins):
        at = 0
        for i in items:
            where[i], offset[i] = k, at
            at += lengths[i]
        fill[items] = at
    return where, offset, fill


def _packed(items: DataFrame, groups: int, round_: int, capacity: int) -> DataFrame:
    """``items`` with sequence_id, offset and fill set, packed in ``groups`` groups."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        where, offset, fill = pack_group(rows["length"].tolist(), capacity)
        rows["sequence_id"] = where + (int(key[0]) << 32) + (round_ << 60)
        rows["offset"], rows["fill"] = offset, fill
        return rows

    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_)), F.lit(groups))
    made = items.drop("sequence_id", "offset", "fill").withColumn("group", spread)
    out = made.selectExpr("*", "0L AS sequence_id", "0L AS offset", "0L AS fill").schema
    return made.groupBy("group").applyInPandas(run, out).drop("group")


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``items`` (any columns and ``length``, 1 to capacity) with sequence_id and offset."""
    items = materialise(items, "pack-items")
    last, done = 3, []
    for round_ in range(last + 1):
        groups = max(1, -(-items.count() // group))
        packed = materialise(_packed(items, groups, round_, capacity), "packed")
        if groups == 1 or round_ == last:
            done.append(packed)
            break
        done.append(packed.filter(F.col("fill") >= OPEN * capacity))
        items = packed.filter(F.col("fill") < OPEN * capacity)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("fill")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every row's pieces with the sequence and the offset they go to."""
    return pack(document_pieces(docs, capacity, path), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
