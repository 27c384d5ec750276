"""Removal of long strings that repeat, over the suffixes of all texts.

A byte goes if a ``SIZE``-byte string that covers it also starts elsewhere, in
any text.  The suffixes are ordered by their first SIZE bytes only as far as
that needs, blockwise, in buckets that a cover sample defines:

1. Cover sample: of every ``SPAN`` consecutive positions, the one whose next 16
   bytes hash lowest (the first such) is sampled.  As with a difference cover,
   any two equal strings of SIZE bytes have a sample position at the same
   offset, less than SPAN; here the offset is the first lowest one, and depends
   on the string's own bytes.  A sample's rank is the hash of its next
   SIZE - SPAN + 1 bytes, which lie inside every string it stands for.
2. The suffixes that a sample stands for are a run of start positions; runs
   of equal rank are a bucket.  Only equal rank and offset can tie, so buckets
   are independent, and those with one run are done.
3. In a bucket, runs with equal bytes over all they span are one run; being two
   or more, all their strings repeat.  What is left are runs that differ
   somewhere near.  Their positions go to cells of ``CELL`` offsets: cells that
   agree in all the bytes they span are settled, cells whose common core is
   alone are out, and only in the others each suffix is told apart by the hash
   of its SIZE bytes.  A cell or a suffix is a row, so that a bucket of any size
   is spread.
4. Repeated strings' spans are joined to the texts and cut out.

Defined cases: null text counts as empty; shorter texts than SIZE bytes stay;
rows that repeat id and text are texts of their own, so theirs repeat; a cut
may split a character, so what is kept is binary; texts of any length are cut
whole; an empty table gives none; other columns, whatever their names, take no
part.  Strings are told apart by
two 64-bit hashes (the rank's and their own).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, table, text_of

SIZE = 400
SPAN = 273
CELL = 8
#: Bytes of text that are worked on at a time, but for one longer text.
CHUNK = 4 << 20


def _lowest(data: np.ndarray, span: int) -> np.ndarray:
    """For each position, the sampled one of the next ``span``; data is padded with span + 16 bytes."""
    n = len(data) - 16
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    key = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key += words[8:n + 8]
    key *= np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xC2B2AE3D27D4EB4F)
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(n, dtype=np.uint64)  # the first of equals is the lowest
    width = 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:width - span], key[span - width:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(texts: list[bytes], size: int = SIZE, span: int = SPAN) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, sample, first, last, rank, spanned) of the runs of start positions of each text."""
    long = [i for i, t in enumerate(texts) if len(t) >= size]
    if not long:
        return
    lengths = np.array([len(texts[i]) for i in long])
    starts = np.cumsum(lengths) - lengths
    joined = b"".join(texts[i] for i in long)
    lowest = _lowest(np.frombuffer(joined + bytes(span + 32), np.uint8), span)
    count = lengths - size + 1
    of = np.repeat(np.arange(len(long)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + starts[of]
    sample = lowest[at]
    new = np.flatnonzero(np.concatenate([[True], (sample[1:] != sample[:-1]) | (of[1:] != of[:-1])]))
    last = at[np.concatenate([new[1:], [len(at)]]) - 1]
    data, rank_bytes, digest = memoryview(joined), size - span + 1, xxhash.xxh3_64_intdigest
    for k, p, lo, hi in zip(of[new].tolist(), sample[new].tolist(), at[new].tolist(), last.tolist()):
        s = int(starts[k])
        yield long[k], p - s, lo - s, hi - s, digest(data[p:p + rank_bytes]), digest(data[lo:hi + size])


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Slices of rows of CHUNK bytes or so."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > CHUNK:
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().cast("binary").alias("text"))


def runs(docs: DataFrame, size: int = SIZE, span: int = SPAN) -> DataFrame:
    """(doc_id, text_hash, sample, first, last, rank, spanned) of all texts' runs."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = [len(x.as_buffer()) for x in whole.column(2)]
            for start, stop in _chunks(sizes):
                b = whole.slice(start, stop - start)
                rows = list(runs_of(b.column(2).to_pylist(), size, span))
                if not rows:
                    continue
                cols = list(zip(*rows))
                of = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(of), b.column(1).take(of), *[pa.array(c, pa.int32()) for c in cols[1:4]],
                     *[pa.array(np.array(c, np.uint64).view(np.int64)) for c in cols[4:]]],
                    ["doc_id", "text_hash", "sample", "first", "last", "rank", "spanned"])

    rows = _texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, sample int, first int, last int, rank long, spanned long")


def contexts(docs: DataFrame, open_: DataFrame, size: int = SIZE) -> DataFrame:
    """``open_`` (rank, spanned, n, doc_id, text_hash, sample, first, last) with ``bytes``, what the run spans."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data, wanted = memoryview(b.column(2)[i].as_buffer()), b.column(3)[i].as_py()
                cols = [[w[c] for w in wanted] for c in ("rank", "spanned", "n", "sample", "first", "last")]
                parts = [bytes(data[w["first"]:w["last"] + size]) for w in wanted]
                same = pa.array(np.full(len(wanted), i))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, cols[:3]), b.column(0).take(same), b.column(1).take(same),
                     *[pa.array(c, pa.int32()) for c in cols[3:]], pa.array(parts, pa.binary())], NAMES)

    wanted = open_.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_list(F.struct("rank", "spanned", "n", "sample", "first", "last")).alias("wanted"))
    rows = _texts(docs)
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["__id"]) & (rows["text_hash"] == wanted["__hash"]))
    kind = rows.schema["doc_id"].dataType.simpleString()
    kinds = ["long", "long", "long", kind, "long", "int", "int", "int", "binary"]
    return rows.select("doc_id", "text_hash", "text", "wanted").mapInArrow(run, ", ".join(map(" ".join, zip(NAMES, kinds))))


NAMES = ["rank", "spanned", "n", "doc_id", "text_hash", "sample", "first", "last", "bytes"]


def cells(open_: DataFrame, size: int, width: int, only: bool = False) -> DataFrame:
    """(rank, cell, core, wide, n, spanned, doc_id, text_hash, at, stop): each run's start positions
    in cells of ``width`` offsets from the sample.

    ``core`` is the hash of what the strings of a cell's positions share, ``wide`` of all they
    span in this run, from ``at`` to ``stop``, and of what they'd span beyond it.  With ``only``, the
    cells of width 1 inside the cells that the column ``wanted`` (of width CELL) lists.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            rows = b.to_pydict()
            out, of = [], []
            for i, (sample, first, last, data) in enumerate(zip(rows["sample"], rows["first"], rows["last"], rows["bytes"])):
                span = memoryview(data)
                near, far = sample - last, sample - first  # the offsets of the run's positions
                if only:
                    listed = [o for c in rows["wanted"][i] for o in range(max(near, c * CELL), min(far, c * CELL + CELL - 1) + 1)]
                else:
                    listed = range(near // width, far // width + 1)
                for cell in listed:
                    start = sample - cell * width - first  # of the core, in the run's bytes
                    core = digest(span[start:start + size - width + 1])
                    low, high = max(start - width + 1, 0), min(start + size, len(span))
                    missing = (low - start + width - 1) * width + start + size - high
                    out.append((cell, core, digest(span[low:high], missing), low + first, high + first))
                    of.append(i)
            if out:
                cell, core, wide, at, stop = zip(*out)
                of = pa.array(of, pa.int64())
                take = lambda c: b.column(c).take(of)
                yield pa.RecordBatch.from_arrays(
                    [take("rank"), pa.array(cell, pa.int32()), *[pa.array(np.array(h, np.uint64).view(np.int64)) for h in (core, wide)],
                     take("n"), take("spanned"), take("doc_id"), take("text_hash"), pa.array(at, pa.int32()), pa.array(stop, pa.int32())],
                    ["rank", "cell", "core", "wide", "n", "spanned", "doc_id", "text_hash", "at", "stop"])

    kind = open_.schema["doc_id"].dataType.simpleString()
    return open_.mapInArrow(run, f"rank long, cell int, core long, wide long, n long, spanned long, doc_id {kind}, text_hash long, at int, stop int")


def repeated_spans(docs: DataFrame, size: int = SIZE, span: int = SPAN) -> DataFrame:
    """(doc_id, text_hash, start, stop): spans whose bytes are covered by repeated strings; they may overlap."""
    all_ = materialise(runs(docs, size, span), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "first", "last", "sample")
    again = all_.groupBy("rank").agg(F.count("*").alias("n")).filter("n > 1").select("rank")
    all_ = materialise(all_.join(again, "rank", "left_semi"), "repeated-runs")
    alike = materialise(all_.groupBy("rank", "spanned").agg(F.count("*").alias("n"), F.min(place).alias("one")), "alike-runs")
    buckets = alike.groupBy("rank").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1").select("rank")
    whole = all_.join(alike.filter("n > 1").select("rank", "spanned"), ["rank", "spanned"], "left_semi").select(
        "doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + size).alias("stop"))
    open_ = alike.join(buckets, "rank", "left_semi").select("rank", "spanned", "n", "one.*").drop("none")
    open_ = materialise(contexts(docs, open_, size), "open-runs")

    # Cells of offsets: a cell's wide string twice settles all its strings; a core that is alone excludes them all.
    parts = materialise(cells(open_, size, CELL), "cells")
    kinds = parts.groupBy("rank", "cell", "core", "wide").agg(F.sum("n").alias("n"), F.min("spanned").alias("spanned"))
    kinds = materialise(kinds, "cell-kinds")
    settled = parts.filter("n = 1").join(kinds.filter("n > 1").select("rank", "cell", "wide"), ["rank", "cell", "wide"], "left_semi").select(
        "doc_id", "text_hash", F.col("at").alias("start"), "stop")
    mixed = kinds.groupBy("rank", "cell", "core").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1")
    wanted = kinds.join(mixed.select("rank", "cell", "core"), ["rank", "cell", "core"], "left_semi").groupBy("rank", "spanned").agg(
        F.collect_set("cell").alias("wanted"))

    # What is left is told apart string by string.
    each = materialise(cells(open_.join(wanted, ["rank", "spanned"]), size, 1, only=True), "strings")
    twice = each.groupBy("rank", "core").agg(F.sum("n").alias("all")).filter("all > 1").select("rank", "core")
    single = each.filter("n = 1").join(twice, ["rank", "core"], "left_semi").select(
        "doc_id", "text_hash", F.col("at").alias("start"), "stop")
    return whole.unionByName(settled).unionByName(single)


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, kept, removed): what is left of each text's bytes, and its removed (start, stop), disjoint and in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, removed = [], []
            for text, spans in zip(b.column(1), b.column(2)):
                data, parts, gone, at = text.as_py(), [], [], 0
                for x in spans.as_py() or ():
                    if gone and x["start"] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], x["stop"])
                    else:
                        gone.append([x["start"], x["stop"]])
                for start, stop in gone:
                    parts.append(data[at:start])
                    at = stop
                kept.append(b"".join([*parts, data[at:]]))
                removed.append([{"start": s, "stop": e} for s, e in gone])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kept, pa.binary()), pa.array(removed, SPANS)],
                                             ["doc_id", "text", "kept", "removed"])

    per = spans.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    rows = _texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.join(per, rows["doc_id"].eqNullSafe(per["__id"]) & (rows["text_hash"] == per["__hash"]), "left")
    return rows.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, text binary, kept binary, removed array<struct<start:int,stop:int>>")


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def remove_repeats(docs: DataFrame, size: int = SIZE, span: int = SPAN) -> DataFrame:
    """(doc_id, text, kept, removed) of every row of ``docs``, texts as UTF-8 bytes."""
    return cut(docs, repeated_spans(docs, size, span))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))

    def total(spans: Column) -> Column:
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x["stop"] - x["start"])

    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), total(F.col("removed")).alias("n_removed"),
                       F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                       F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
