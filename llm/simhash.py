"""SimHash near-duplicates by multi-index hashing.

A document's 64-bit fingerprint has a bit set where over half of its word
shingles' XXH64 values have it.  Two fingerprints link at ``max_distance``
(2 at most) or fewer differing bits; a group is a connected component.

The fingerprint is split into two 32-bit segments.  If two fingerprints differ
in at most two bits, the low segments differ in at most one bit or the high
segments are equal.  So each distinct fingerprint is entered in one table per
segment, and looks up the radius-1 ball of its low segment and the radius-0
ball of its high segment; matches are kept when the complete distance holds.
Of two fingerprints the one with the larger segment value looks up the other.

A segment value that more than ``BUCKET`` fingerprints share (many near copies
of one text) isn't paired up.  There the rest of the fingerprint is enumerated
too, which is exact and linear: fingerprints equal in this segment and within
two bits of each other have a common point at distance one or less in the
other segment, so each links to the smallest fingerprint at each of its
points; a look-up that already spent one bit in the segment asks for the at
most 33 complete fingerprints that are left.

Defined cases: null text counts as empty; a text without words has fingerprint
zero, which links like any other; repeated rows each get a result row (near_dedup
keeps one row of a doc_id and text); null
``doc_id`` rows take part and are never chosen as the smallest id unless alone
(then null).  Columns other than ``doc_id`` and ``text`` are not read.

The pipeline's stage calls ``near_dedup`` as it is: three words, two bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, spare, table, text_of
from llm.components import connected_components

SEED = 42
BUCKET = 64
LOW = 0xFFFFFFFF
#: XOR masks of the radius-1 ball of a 32-bit segment, the centre first.
BALL = f"explode(array(0L, {', '.join(f'{1 << i}L' for i in range(32))}))"


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each word shingle of a UTF-8 text; bytes.split() cuts at \\x20 \\x09-\\x0D."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:i + n] for i in range(width)))) if n > 1 else iter([b" ".join(words)])
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)


def majority(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits (0 or 1) that over half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return (2 * ones > len(hashes)).astype(np.uint8)


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned fingerprint of a UTF-8 text."""
    return int(np.packbits(majority(shingle_hashes(text, width)), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) per row of ``docs``; fp is the fingerprint as a
    signed long, text_hash an XXH64 that tells rows repeating an id apart."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, width) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def links(nodes: DataFrame, max_distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect every pair
    within ``max_distance`` bits, directly or through other edges."""
    if not 0 <= max_distance <= 2:
        raise ValueError("two segments with radius-1 balls cover distances up to 2")
    low, high = F.col("fp").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned("fp", 32)
    entries = nodes.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), low.alias("key")),
        F.struct(F.lit(1).alias("seg"), high.alias("key")))).alias("e")).select("fp", "e.seg", "e.key")
    hot = entries.groupBy("seg", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket).select("seg", "key")
    hot = materialise(hot, "simhash-hot")
    asked = (entries.filter("seg = 0").withColumn("mask", F.expr(BALL))
             .withColumn("key", F.col("key").bitwiseXOR(F.col("mask")))
             .filter(F.col("key") <= F.col("fp").bitwiseAND(F.lit(LOW)))
             .unionByName(entries.filter("seg = 1").withColumn("mask", F.lit(0).cast("bigint"))))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    found = (asked.join(hot, ["seg", "key"], "left_anti").withColumnRenamed("fp", "a")
             .join(entries.withColumnRenamed("fp", "b"), ["seg", "key"])
             .filter((F.col("a") != F.col("b")) & near).select("a", "b"))

    # Hot segment values: enumerate the other segment as well.
    in_hot = entries.join(hot, ["seg", "key"], "left_semi")
    points = (in_hot.select("fp", "seg", F.expr(BALL).alias("m"))
              .select("fp", "seg", F.expr("fp ^ shiftleft(m, CASE WHEN seg = 0 THEN 32 ELSE 0 END)").alias("point")))
    # A point keeps the whole fingerprint but one bit, so at most 33 fingerprints meet at it.
    least = points.groupBy("seg", "point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    stars = points.join(least, ["seg", "point"]).select(F.col("fp").alias("a"), "b").filter((F.col("a") != F.col("b")) & near)
    spent = (asked.filter("mask != 0").join(hot, ["seg", "key"], "left_semi")
             .select(F.col("fp").alias("a"), "mask", F.expr(BALL).alias("m"))
             .select("a", F.expr("a ^ mask ^ shiftleft(m, 32)").alias("b")).filter(near)
             .join(nodes.select(F.col("fp").alias("b")), "b").select("a", "b"))
    return found.unionByName(stars).unionByName(spent).distinct()


def _labelled(docs: DataFrame, width: int, max_distance: int, bucket: int) -> DataFrame:
    """The rows of :func:`fingerprints` with a label that the rows of a group share."""
    fps = materialise(fingerprints(docs, width), "simhash-fp")
    edges = materialise(links(fps.select("fp").distinct(), max_distance, bucket), "simhash-links")
    labels = connected_components(edges).withColumnRenamed("node", "fp")
    return fps.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def groups(docs: DataFrame, width: int = 3, max_distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) per row: the smallest doc_id of the row's group."""
    rows = _labelled(docs, width, max_distance, bucket)
    least = rows.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "label").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, width: int = 3, max_distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest doc_id (rows
    with a null id only where a group has no other).  Columns as given."""
    rows = _labelled(docs, width, max_distance, bucket)
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"))
    id_, hash_, text = spare(docs, "id", "hash", "text")
    keep = first.select(F.col("k.doc_id").alias(id_), F.col("k.text_hash").alias(hash_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.xxhash64(text_of()))
    # Of rows repeating an id and text, whatever their other columns, one stays.
    kept = docs.join(keep, same, "left_semi").withColumn(text, text_of())
    return kept.dropDuplicates(["doc_id", text]).drop(text)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
