"""Incremental rating ingestion: new CSV files → staged → merged into the
year-partitioned ``fact_ratings``.

This is the streaming form of the yearly incremental load (B3/B9): each
micro-batch of newly arrived rating files is typed like ``stg_ratings``,
filtered like ``fact_ratings`` (valid rating, partition year, known movie and user)
and upserted with :meth:`TableStore.merge_upsert`, which rewrites only the
year partitions the batch touches.  The upsert is idempotent — replaying a
batch after a failure replaces the same rows with the same values — so the
``foreachBatch`` sink gives exactly-once table contents together with the
stream checkpoint.  ``available_now`` processes what has arrived and stops,
the usual way to run a file feed on a schedule.

Ratings whose user or movie the stored dimensions don't know yet wait in
``pending_ratings``.  Each batch, each start of the feed and
:func:`release_pending` look them up again: those known by now are merged into
the fact, then the rest is written back.  The merge is idempotent, so a run
that ends between the two merges the same rows once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse.operators import facts, staging
from reelhouse.operators.upsert import FACT_RATINGS_KEYS
from reelhouse.plans.files import stage
from reelhouse.plans.tables import TableStore
from reelhouse.sources.csv import SOURCE_FILES, _all_string


PENDING = "pending_ratings"


def merge_ratings(store: TableStore, ratings: DataFrame) -> int:
    """Merge valid ratings whose movie and user are known; the others wait.  Returns how many wait.

    Rows that waited and rows that come now are one batch.  Of several of a key
    the one that came last counts: what waits is numbered by batch.
    """
    waiting = store.read(PENDING) if store.exists(PENDING) else None
    last = 0 if waiting is None else waiting.agg(F.max("batch")).first()[0] or 0
    rows = ratings.select("user_id", "movie_id", "rating", "created_at", "year").withColumn("batch", F.lit(last + 1))
    if waiting is not None:
        newer = rows.select(*FACT_RATINGS_KEYS)
        rows = waiting.join(newer, list(FACT_RATINGS_KEYS), "left_anti").unionByName(rows)
    staged, where, _ = stage(rows, store.root)
    try:
        known = facts.known_rows(staged, store.read("dim_movies"), store.read("dim_users")).select(*staged.columns)
        store.merge_upsert("fact_ratings", known.drop("batch"))
        unknown = staged.filter("user_id IS NOT NULL AND movie_id IS NOT NULL").exceptAll(known)
        return store.full_refresh(PENDING, unknown).row_count
    finally:
        store.folders.remove(where)


def release_pending(store: TableStore) -> int:
    """Merge the waiting ratings whose users and movies are known by now; returns how many still wait."""
    if not store.exists(PENDING):
        return 0
    return merge_ratings(store, store.read(PENDING).limit(0))


def _merge_batch(store: TableStore, years):
    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_ratings(store, facts.valid_ratings(staging.stg_ratings(batch), years))
    return merge


def start_ratings_feed(spark: SparkSession, store: TableStore, landing_dir: str,
                       checkpoint_location: str, years=None, available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the feed; ``checkpoint_location`` must be on shared storage."""
    release_pending(store)
    reader = (spark.readStream.schema(_all_string(SOURCE_FILES["ratings"][1]))
              .option("header", True).option("escape", '"').option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    writer = (raw.writeStream.foreachBatch(_merge_batch(store, years))
              .option("checkpointLocation", checkpoint_location)
              .queryName("ratings_feed"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
