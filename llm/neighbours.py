"""Approximate nearest neighbours by shifted space-filling curves.

Vectors with equal components are one point with its smallest ids (as many as
an answer may hold), so a vector that a third of the rows share is one point.
For each of ``CURVES`` curves, points are projected to a few random directions,
shifted, and placed on a Hilbert curve; points of one cell go along a finer curve
in it, twice, so that a dense cluster is ordered by place, not by id.  Spark range-partitions and sorts all
points by (curve, keys); their ranks, from the partitions' sizes, cut the order
into blocks of ``BLOCK`` points.  A query looks at its own block and the two
beside it, so at BLOCK points or more on either side of it, on every curve.
Blocks score their queries on the original vectors in double precision; the
best of all blocks are merged.  A block holds a fixed number of points however
the vectors lie, so no task grows with a cluster's size.

A fixed number of candidates finds less in a larger table.  So ``SAMPLE`` of the
queries are also compared with all points, and while less than ``RECALL`` of their
nearest is found, a further round looks along as many other curves, up to
``ROUNDS``.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, as queries or candidates; vectors are compared within
one dimension; a row repeating an id and vector counts once; ties go to the
smaller id; fewer candidates than asked for give fewer rows; an empty table gives
none; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import materialise, table

CURVES = 32
BLOCK = 512
DIMS, BITS = 8, 7
#: Keys of a point on a curve: BITS of each coordinate, then the next BITS, and the next.
KEYS = ("key", "key2", "key3")
#: Queries whose recall is measured, the recall that ends the rounds, and the most rounds.
SAMPLE, RECALL, ROUNDS = 200, 0.95, 8
SEED = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Keys along the Hilbert curve of cells (n x d, d * bits at most 63), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for i in range(d):
            flip = (x[i] & high) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> level & 1)
    return key


def curve_keys(vectors: np.ndarray, curve: int, dims: int = DIMS, bits: int = BITS) -> list[np.ndarray]:
    """The points' keys on one curve, coarse to fine: directions and shift are drawn from the curve's number."""
    rng = np.random.default_rng([SEED, curve, vectors.shape[1]])
    dims = min(dims, vectors.shape[1])
    axes = np.linalg.qr(rng.normal(size=(vectors.shape[1], dims)))[0]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    z = unit @ axes * np.sqrt(vectors.shape[1])  # about one wide, for directions without structure
    at = (z + 3.0) / 6.0 * (1 << bits) + rng.random(dims) * (1 << (bits - 2))
    keys = []
    for _ in KEYS:
        cells = np.clip(np.floor(at), 0, (1 << bits) - 1)
        keys.append(hilbert(cells, bits))
        at = np.clip(at - cells, 0, 1) * (1 << bits)  # where in the cell
    return keys


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def sound(vector: str) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def points(rows: DataFrame, keep: int) -> DataFrame:
    """(point, vector, members): distinct vectors with their ``keep`` smallest ids; point is the smallest."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.withColumn("r", F.dense_rank().over(order)).filter(F.col("r") <= keep)  # limited before the shuffle
    return least.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("members")).select(
        F.col("members")[0].alias("point"), "vector", "members")


def ordered(pts: DataFrame, curves: int, first_curve: int = 0) -> DataFrame:
    """``pts`` on every curve from ``first_curve``, with their ranks in the order of (curve, keys)."""
    def keyed(batches):
        for b in batches:
            sizes = b.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(sizes):
                part = b.filter(pa.array(sizes == n))
                vectors = _matrix(part.column("vector"))
                for c in range(curves):
                    extra = [pa.array(np.full(len(part), int(n) * curves + c)), *map(pa.array, curve_keys(vectors, first_curve + c))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, "curve", *KEYS])

    kind = pts.schema["vector"].dataType.simpleString()
    on = pts.select("point", "vector", "asked").mapInArrow(keyed, f"point long, vector {kind}, asked boolean, curve long, {', '.join(f'{k} long' for k in KEYS)}")
    dealt = on.repartitionByRange("curve", *KEYS, "point").sortWithinPartitions("curve", *KEYS, "point")
    dealt = materialise(dealt.drop(*KEYS).select("*", F.spark_partition_id().alias("part"),
                                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "curves")
    sizes = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    first = dealt.sparkSession.createDataFrame(starts, "part int, first long")
    return dealt.join(first, "part").withColumn("rank", F.col("first") + F.col("at"))


def scored(ranked: DataFrame, block: int, k: int) -> DataFrame:
    """(query, point, score): the k best of each query point in each block it looks at."""
    rows = ranked.withColumn("dim", F.size("vector")).withColumn("own", F.floor(F.col("rank") / block).cast("bigint"))
    near = F.when(F.col("asked"), F.array(F.lit(0), F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("point", "vector", "asked", "dim", "own", F.explode(near).alias("step")).withColumn("block", F.col("own") + F.col("step"))

    def best(group: pa.Table) -> pa.Table:
        vectors = _matrix(group["vector"])
        ids, asked = group["point"].to_numpy(), group["asked"].to_numpy(zero_copy_only=False).astype(bool)
        here = group["step"].to_numpy() == 0
        ask, cand = np.flatnonzero(asked), np.flatnonzero(here)
        cand = cand[np.argsort(ids[cand], kind="stable")]
        norms = np.sqrt((vectors * vectors).sum(1))
        q, p, s = [], [], []
        for at in range(0, len(ask) if len(cand) else 0, 256):
            some = ask[at:at + 256]
            score = (vectors[some] @ vectors[cand].T) / (norms[some][:, None] * norms[cand][None, :])
            score[ids[some][:, None] == ids[cand][None, :]] = -np.inf
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            got = np.take_along_axis(score, top, 1)
            fine = np.isfinite(got)
            q.append(np.repeat(ids[some], fine.sum(1)))
            p.append(ids[cand][top][fine])
            s.append(got[fine])
        if not q:
            return pa.table({"query": pa.array([], pa.int64()), "point": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.table({"query": np.concatenate(q), "point": np.concatenate(p), "score": np.concatenate(s)})

    return rows.groupBy("block", "dim").applyInArrow(best, "query long, point long, score double")


def nearest_of_sample(pts: DataFrame, k: int, sample: int) -> DataFrame:
    """(query, kth, of): the score of the k-th nearest (or last) of a sample of the query points, compared with all points."""
    picked = pts.filter("asked").orderBy(F.xxhash64("point"), "point").select("point", "vector").limit(sample).collect()
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(r["vector"]) for r in picked}:
        some = [r for r in picked if len(r["vector"]) == size]
        v = np.array([r["vector"] for r in some], float)
        by_size[size] = np.array([r["point"] for r in some]), v / np.linalg.norm(v, axis=1, keepdims=True)

    def best(batches):
        for b in batches:
            sizes = b.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for size, (queries, unit) in by_size.items():
                part = b.filter(pa.array(sizes == size))
                if not len(part):
                    continue
                v, ids = _matrix(part.column("vector")), part.column("point").to_numpy()
                score = unit @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T
                score[queries[:, None] == ids[None, :]] = -np.inf
                top = -np.sort(-score, axis=1)[:, :k]
                fine = np.isfinite(top)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(queries, fine.sum(1))), pa.array(top[fine])], ["query", "score"])

    scores = pts.select("point", "vector").mapInArrow(best, "query long, score double")
    r = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    return scores.withColumn("r", r).filter(F.col("r") <= k).groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("of"))


def candidates(pts: DataFrame, k: int, curves: int, block: int, rounds: int, recall: float = RECALL) -> DataFrame:
    """(query, point, score) found in as many rounds as the sample's recall asks for."""
    truth = materialise(nearest_of_sample(pts, k, SAMPLE), "nearest") if rounds > 1 else None
    found = None
    for round_ in range(rounds):
        new = scored(ordered(pts, curves, round_ * curves), block, k)
        new = new if found is None else new.unionByName(found)
        found = materialise(new.groupBy("query", "point").agg(F.max("score").alias("score")), "found")
        if round_ + 1 < rounds:
            near = found.join(truth, "query").filter(F.col("score") >= F.col("kth") - 1e-9).groupBy("query").agg(F.count("*").alias("n"))
            met = truth.join(near, "query", "left").agg(F.sum(F.least("of", F.coalesce("n", F.lit(0)))).alias("n"), F.sum("of").alias("of")).first()
            if (met["n"] or 0) >= recall * (met["of"] or 0):
                break
    return found


def search(vectors: DataFrame, asked: Column, k: int = 5, curves: int = CURVES, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of (vec_id, embedding) that ``asked`` holds for."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.filter(sound("vector") & F.col("vec_id").isNotNull())
    queries = rows.filter(asked).distinct()
    pts = materialise(points(rows, k + 1), "points")
    wanted = queries.select("vector").distinct().withColumn("asked", F.lit(True))
    pts = materialise(pts.join(wanted, "vector", "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "points")
    found = candidates(pts, k, curves, block, rounds)
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    own = pts.filter("asked").select(F.col("point").alias("query"), "point", (norm / (F.sqrt(norm) * F.sqrt(norm))).alias("score"))
    rows_of = found.unionByName(own).join(pts.select("point", "members"), "point")
    each = rows_of.select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = each.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)  # one may be the query itself
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("best"))
    named = queries.select(F.col("vec_id").alias("query_id"), "vector").join(pts.select("vector", F.col("point").alias("query")), "vector")
    others = named.select("query_id", "query").join(lists, "query").select(
        "query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    return others.select("query_id", F.posexplode("best").alias("i", "b")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")


def op7_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
