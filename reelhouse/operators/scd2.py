"""Slowly changing dimension, type 2, over a mart.

History columns: the mart's columns + ``valid_from``, ``valid_to``,
``is_current``.  One run against a new source:

* a current row whose watched columns changed (null-safe) is closed
  (``valid_to`` = the run's clock, ``is_current`` = false) and the source
  row is opened as the new current version;
* keys new in the source are opened;
* keys gone from the source stay current (no delete);
* unchanged rows and closed history are kept as they are (including
  unwatched columns such as ``refreshed_at``).

Runs come in the order of their clocks here; :func:`late_merge` fits in one that
comes late.  Closing and opening use the same ``effective_ts``, so versions are
contiguous ``[valid_from, valid_to)`` intervals.

Plan: the current rows and the source meet in one full outer join on the
key; each joined row emits one or two output rows through a single
``explode``, and the closed history is passed through untouched — one
shuffle on the key, no second pass over the join.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.columns import as_of_literal

SCD_COLUMNS = ["valid_from", "valid_to", "is_current"]

# Key and watched columns of each mart's history.
SNAPSHOT_SPECS = {
    "mart_movie_analytics": ("movie_id", ["total_ratings", "avg_rating", "quality_tier"]),
    "mart_user_behavior": ("user_id", ["total_ratings", "user_segment"]),
    "mart_genre_performance": ("genres", ["total_ratings", "avg_rating", "popularity_tier"]),
}

_CUR, _SRC = "__cur", "__src"


def initial_history(source: DataFrame, effective_ts: datetime | None = None) -> DataFrame:
    """First load: every source row opened at ``effective_ts``."""
    return source.select("*", as_of_literal(effective_ts).alias("valid_from"),
                         F.lit(None).cast("timestamp").alias("valid_to"),
                         F.lit(True).alias("is_current"))


def changed(cols: list[str], left: str, right: str) -> Column:
    cond = None
    for c in cols:
        diff = ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        cond = diff if cond is None else (cond | diff)
    return cond


def scd2_merge(history: DataFrame | None, source: DataFrame, key: str, check_cols: list[str],
               effective_ts: datetime | None = None) -> DataFrame:
    """The full new history (lazy).  ``history=None`` is the first load."""
    if history is None:
        return initial_history(source, effective_ts)
    ts = as_of_literal(effective_ts)
    data_cols = [c for c in history.columns if c not in SCD_COLUMNS]
    data_cols += [c for c in source.columns if c not in data_cols]
    out_cols = data_cols + SCD_COLUMNS

    closed = history.filter(~F.col("is_current") | F.col("is_current").isNull())
    cur = history.filter(F.col("is_current")).withColumn(_CUR, F.lit(True)).alias("c")
    src = source.withColumn(_SRC, F.lit(True)).alias("s")
    j = cur.join(src, F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")

    has_cur = F.col(f"c.{_CUR}").isNotNull()
    has_src = F.col(f"s.{_SRC}").isNotNull()
    is_changed = has_cur & has_src & changed(check_cols, "c", "s")

    types = {f.name: f.dataType for f in source.schema.fields}
    types.update({f.name: f.dataType for f in history.schema.fields})

    def side(prefix: str, cols: list[str]):
        present = history.columns if prefix == "c" else source.columns
        return [F.col(f"{prefix}.{c}") if c in present else F.lit(None).cast(types[c])
                for c in cols]

    cur_row = F.struct(*[v.alias(c) for v, c in zip(side("c", data_cols), data_cols)],
                       F.col("c.valid_from").alias("valid_from"),
                       F.when(is_changed, ts).otherwise(F.col("c.valid_to")).alias("valid_to"),
                       F.when(is_changed, F.lit(False)).otherwise(F.col("c.is_current"))
                       .alias("is_current"))
    new_row = F.struct(*[v.alias(c) for v, c in zip(side("s", data_cols), data_cols)],
                       ts.alias("valid_from"),
                       F.lit(None).cast("timestamp").alias("valid_to"),
                       F.lit(True).alias("is_current"))
    versions = F.array(F.when(has_cur, cur_row),
                       F.when(has_src & (~has_cur | is_changed), new_row))
    merged = (j.select(F.explode(versions).alias("v"))
              .filter(F.col("v").isNotNull()).select("v.*"))
    return closed.unionByName(merged, allowMissingColumns=True).select(*out_cols)


def late_merge(history: DataFrame, source: DataFrame, key: str, check_cols: list[str],
               effective_ts: datetime, next_run: datetime) -> DataFrame:
    """The history after a run whose clock lies before later runs, as if the runs had come in order (lazy).

    ``history`` holds the versions that are current or were closed after
    ``effective_ts``; ``next_run`` is the clock of the first later run.  Per key
    of the source:

    * the version that holds the clock has other watched values: it ends at
      the clock, and the source row is valid from there up to the next run,
      which had the old values again (they return as a version of their own)
      or brought the next version (which takes over the source row, valid from
      the clock, if its watched values are the same);
    * all versions begin later: the source row is valid up to the first, or
      the first one begins at the clock if its watched values are the same;
    * no version: the source row is current.

    A later run that left a version as it was counts as having seen it.
    Versions of a key are as many as its changes since the clock, so the
    window per key is small.  The result has no overlap and no gap.
    """
    ts, after = as_of_literal(effective_ts), as_of_literal(next_run)
    data_cols = [c for c in history.columns if c not in SCD_COLUMNS]
    data_cols += [c for c in source.columns if c not in data_cols]
    types = {f.name: f.dataType for f in [*source.schema.fields, *history.schema.fields]}

    h = history.select(*[F.col(c) if c in history.columns else F.lit(None).cast(types[c]).alias(c) for c in data_cols], *SCD_COLUMNS)
    h = h.select(F.struct(*data_cols).alias("h"), *SCD_COLUMNS, F.col(key).alias("__key"))
    s = source.select(F.struct(*[F.col(c) if c in source.columns else F.lit(None).cast(types[c]).alias(c) for c in data_cols]).alias("s"),
                      F.col(key).alias("__key"))
    j = h.join(s, "__key", "full_outer")

    has_h, has_s = F.col("h").isNotNull(), F.col("s").isNotNull()
    by_key = Window.partitionBy("__key").orderBy(F.col("valid_from").asc_nulls_first())
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}"))
    j = j.withColumn("__holds", has_h & (F.col("valid_from") <= ts)).withColumn("__differs", has_h & has_s & differs)
    j = j.withColumn("__split", F.col("__holds") & F.col("__differs"))
    j = (j.withColumn("__next_same", F.lead(~F.col("__differs")).over(by_key))
         .withColumn("__before_holds", F.lag("__holds").over(by_key)).withColumn("__before_split", F.lag("__split").over(by_key)))

    def version(row: str, start: Column, end: Column, current: Column) -> Column:
        return F.struct(F.col(row).alias("row"), start.alias("valid_from"), end.cast("timestamp").alias("valid_to"), current.alias("is_current"))

    own, to, now, no = F.col("valid_from"), F.col("valid_to"), F.col("is_current"), F.lit(False)
    returns = to.isNull() | (to > after)  # the next run had the old values again
    taken_over = ~returns & F.coalesce("__next_same", no)
    first_later = has_h & has_s & ~F.col("__holds") & F.col("__before_holds").isNull()
    joins_split = F.coalesce("__before_split", no) & (own == after) & ~F.col("__differs")
    none = F.lit(None).cast("timestamp")
    rows = (F.when(~has_h, F.array(version("s", ts, none, F.lit(True))))
            .when(F.col("__split"), F.array(version("h", own, ts, no), F.when(~taken_over, version("s", ts, after, no)),
                                            F.when(returns, version("h", after, to, now))))
            .when(first_later & F.col("__differs"), F.array(version("s", ts, own, no), version("h", own, to, now)))
            .when(first_later | joins_split, F.array(version("s", ts, to, now)))
            .otherwise(F.array(version("h", own, to, now))))
    out = j.select(F.explode(F.filter(rows, lambda v: v.isNotNull())).alias("v"))
    return out.select("v.row.*", "v.valid_from", "v.valid_to", "v.is_current").select(*data_cols, *SCD_COLUMNS)


def assert_single_source_rows(current: DataFrame, source: DataFrame, key: str) -> None:
    """Raise if the source repeats the key of a current row (MERGE would)."""
    twice = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    bad = current.select(key).join(twice, key, "left_semi").limit(5).collect()
    if bad:
        raise ValueError(f"SCD2: a current row is matched by several source rows; first keys: {[r[0] for r in bad]}")
