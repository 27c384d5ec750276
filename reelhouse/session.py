"""Session construction and the few settings the semantics depend on.

The marts use ``year``, ``to_date`` and ``datediff``, which follow the
session time zone, and the fact table is partitioned by the rating's year,
so the zone is pinned to UTC.  AQE is left on so that a join side is only
broadcast after its real size has been measured at run time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or files.  Everything else is left to the cluster
# (table writes set their partition-overwrite mode per write).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Timestamps with statistics: the default type (INT96) has none, so that no
    # filter on a time skips a row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# JVM flags for sessions this module starts.  Catalyst fuses long chains of
# string parsing into one generated method; above HotSpot's 8000-byte limit
# such a method is never JIT-compiled and the stage runs interpreted (3x
# slower on the staging casts).  Lifting the limit keeps them compiled.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"

# Settings that only change the physical plan.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Without those flags (a session someone else started) a stage whose generated
# method is above HotSpot's limit runs as its operators' own, smaller code.
CODEGEN_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SPARKS_LIMIT, HOTSPOTS_LIMIT = "65535", "8000"


def build_session(master: str | None = None, app_name: str = "reelhouse",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the engine relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.extraJavaOptions", JVM_OPTIONS)
    builder = builder.config("spark.executor.extraJavaOptions", JVM_OPTIONS).config("spark.ui.showConsoleProgress", "false")
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Pin the result-changing settings on a session someone else built, and keep its generated code compiled."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(CODEGEN_LIMIT, SPARKS_LIMIT) == SPARKS_LIMIT:
        spark.conf.set(CODEGEN_LIMIT, HOTSPOTS_LIMIT)
    return spark


def checkpoint_dir(spark: SparkSession, fallback_root: str | None = None) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``.  Only when that is unset
    is another folder used: one under ``fallback_root`` (a table root) or under
    the session's warehouse, which are shared storage as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        root = fallback_root or spark.conf.get("spark.sql.warehouse.dir")
        configured = root.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
