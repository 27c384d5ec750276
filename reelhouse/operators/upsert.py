"""Upsert (MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *).

Plain Parquet has no MERGE, so the merge is expressed as two joins on the
business key:

* ``target LEFT ANTI updates`` — target rows no update matches stay as
  they are (no delete clause);
* ``updates LEFT OUTER target`` — every update row, once per target row it
  matches: matched rows take every update column, and a target column the
  updates lack keeps the target value (schema evolution); unmatched updates
  are inserted once.  Duplicate target keys therefore stay duplicates, each
  updated, exactly as MERGE updates each of them.

NULL keys never match (plain ``=``), so NULL-key rows are always kept or
inserted.  One target row matched by two updates is an error in MERGE
(:func:`multi_matched_keys` finds them; the table writer raises).  Updates that
are equal in every column don't contradict each other: with ``alike`` they
update each target row of their key once, and are all inserted if there's none,
so that a load that repeats rows can be merged again.  Updates of one key that
differ replace its target rows as a whole (``whole``) if they are as many: the
key is loaded anew, and nothing is left open.  If they are more or fewer, or the
target rows differ in columns that the updates lack, it is open which update a
row gets (:func:`open_keys`; the table writer raises).

Plan and cost: each join shuffles its sides on the key.  The anti join's
build side is the update *keys* only and the left join's build side the
target keys (plus target-only columns), so compared with one full outer
join the extra shuffle is two narrow key projections.  In exchange both join
types are covered by AQE's skew-join rule, which splits a key holding a
large share of the rows — a full outer join cannot be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FACT_RATINGS_KEYS = ("user_id", "movie_id", "created_at")

def _match_condition(keys, left: str, right: str) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        cond = c if cond is None else (cond & c)
    return cond


def upsert(target: DataFrame, updates: DataFrame, keys=FACT_RATINGS_KEYS, alike: bool = False, whole: bool = False) -> DataFrame:
    """The merged relation (lazy).  Column order: target's, then new columns.

    ``alike``: equal update rows count as one where they match.  ``whole`` (with
    ``alike``): the different ones of a key replace its target rows as a whole.
    """
    keys = list(keys)
    t_cols, s_cols = target.columns, updates.columns
    out_cols = t_cols + [c for c in s_cols if c not in t_cols]
    kept = target.join(updates.select(*keys), keys, "left_anti")
    t_only = [c for c in t_cols if c not in s_cols]
    t, match = target.select(*keys, *t_only), _match_condition(keys, "s", "t")
    # By key first: the grouping and the join then need one shuffle.
    s = updates.repartition(*keys).groupBy(*s_cols).agg(F.count(F.lit(1)).alias("__times")) if alike else updates
    if whole:
        of_key = Window.partitionBy(*keys)
        s = s.withColumn("__kinds", F.count(F.lit(1)).over(of_key))
        t = t.withColumn("__nth", F.row_number().over(of_key.orderBy(F.lit(1))))
        match = match & ((F.col("s.__kinds") == 1) | (F.col("t.__nth") == 1))
    written = s.alias("s").join(t.alias("t"), match, "left_outer")
    values = [F.col(f"s.{c}") if c in s_cols else F.col(f"t.{c}") for c in out_cols]
    if alike:
        new = F.col(f"t.{keys[0]}").isNull()
        times = F.when(new | (F.col("__kinds") > 1) if whole else new, F.col("__times")).otherwise(1)
        values.append(F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("__time"))
    written = written.select(*values)
    typed = [F.lit(None).cast(f.dataType).alias(f.name) for f in updates.schema.fields
             if f.name not in t_cols]
    return kept.select(*t_cols, *typed).unionByName(written.select(*out_cols))


def multi_matched_keys(target: DataFrame, updates: DataFrame, keys=FACT_RATINGS_KEYS) -> DataFrame:
    """Keys where more than one update row matches a target row (MERGE fails)."""
    keys = list(keys)
    repeated = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("update_rows")).filter(F.col("update_rows") > 1)
    return repeated.join(target.select(*keys), keys, "left_semi")


def differing_keys(updates: DataFrame, keys=FACT_RATINGS_KEYS) -> DataFrame:
    """(keys, update_rows): keys of which the updates have rows that differ."""
    keys = list(keys)
    kinds = updates.repartition(*keys).groupBy(*updates.columns).agg(F.count(F.lit(1)).alias("__times"))
    found = kinds.groupBy(*keys).agg(F.sum("__times").alias("update_rows"), F.count(F.lit(1)).alias("__kinds"))
    return found.filter(F.col("__kinds") > 1).drop("__kinds")


def open_keys(target: DataFrame, updates: DataFrame, differing: DataFrame, keys=FACT_RATINGS_KEYS) -> DataFrame:
    """The ``differing`` keys (:func:`differing_keys`) whose target rows the updates can't replace as a whole."""
    keys = list(keys)
    t_only = [c for c in target.columns if c not in updates.columns]
    held = target.select(*keys, *t_only).join(differing, keys)
    held = held.groupBy(*keys, *t_only).agg(F.count(F.lit(1)).alias("__rows"), F.first("update_rows").alias("update_rows"))
    held = held.groupBy(*keys).agg(F.sum("__rows").alias("target_rows"), F.first("update_rows").alias("update_rows"), F.count(F.lit(1)).alias("__kinds"))
    return held.filter((F.col("target_rows") != F.col("update_rows")) | (F.col("__kinds") > 1)).drop("__kinds")
