"""Bronze: raw CSV sources.

The four source files are read with a header row and **no inference**, so
every column is a string, exactly as they were delivered.  Two deliberate
corrections over a default CSV read:

* ``escape='"'`` — RFC-4180 doubles a quote inside a quoted field
  (``"The ""Great"" One, Part 2"``); the default backslash escape would
  shift the following columns silently.
* ``multiLine`` — a newline inside quotes stays in the field.  It stops
  Spark from splitting a file, so it defaults on only for the movie list,
  whose titles may hold one, and off for links, ratings and tags, whose
  files grow with the users' activity.

Columns are found by their header names, in any order; a file whose header
lacks a column, or differs from the other files' order, is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

# Source file names and their header columns.
SOURCE_FILES = {
    "movies": ("movies.csv", ["movieId", "title", "genres"]),
    "links": ("links.csv", ["movieId", "imdbId", "tmdbId"]),
    "ratings": ("ratings.csv", ["userId", "movieId", "rating", "timestamp"]),
    "tags": ("tags.csv", ["userId", "movieId", "tag", "timestamp"]),
}
MULTILINE_DEFAULT = {"movies": True, "links": False, "ratings": False, "tags": False}


def _all_string(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, name: str,
                 multi_line: bool | None = None) -> DataFrame:
    """Read one raw source as all-string columns."""
    _, columns = SOURCE_FILES[name]
    if multi_line is None:
        multi_line = MULTILINE_DEFAULT[name]
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    header = reader.csv(path).columns  # one header line is read
    if missing := [c for c in columns if c not in header]:
        raise ValueError(f"{path}: the header lacks {missing}; it has {header}")
    # enforceSchema=false compares every file's header with these names.
    return (reader.schema(_all_string(header)).option("enforceSchema", False)
            .csv(path).select(*columns))


def source_path(src_dir: str, name: str) -> str:
    return f"{src_dir.rstrip('/')}/{SOURCE_FILES[name][0]}"


def source_file_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``row_count``, ``file_size_bytes`` and ``source_path``.

    ``path`` may be one file or a directory of part files, each with its own
    header line: the count is, per file, physical lines minus the header
    (floored at 0), summed.  Lines are physical, so a quoted newline counts
    twice, as a plain line count of the file does.  The per-file counts are
    a distributed aggregate; sizes come from the file metadata column.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.file_size").alias("size"))
    per_file = lines.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    return per_file.agg(
        F.coalesce(F.sum(F.greatest(F.col("n") - 1, F.lit(0))), F.lit(0)).cast("bigint")
         .alias("row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("file_size_bytes"),
    ).select("row_count", "file_size_bytes", F.lit(path).alias("source_path"))


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a raw relation as CSV part files the reader above reads back
    unchanged: header per file, doubled quotes, blanks kept, NULL as an
    empty field and the empty string as ``""``."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def land_raw(spark: SparkSession, src_dir: str, bronze_root: str | None = None,
             names=tuple(SOURCE_FILES)) -> dict[str, DataFrame]:
    """A1: land each source unchanged (all strings) as a bronze Parquet table.

    Returns ``{name: DataFrame}`` of the raw relations.  When ``bronze_root``
    is given each relation is written to ``<bronze_root>/<name>`` and the
    returned frame reads the landed copy back.
    """
    out = {}
    for name in names:
        df = read_raw_csv(spark, source_path(src_dir, name), name)
        if bronze_root:
            dst = f"{bronze_root.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(dst)
            df = spark.read.parquet(dst)
        out[name] = df
    return out
