"""Helpers the operators share: inputs, shared-storage tables, text columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.plans.files import Folders
from reelhouse.session import checkpoint_dir

#: ASCII white space, the word separator of the text contracts: \\x20 \\x09-\\x0D.
SPACE = r"[\x20\x09-\x0D]"
#: Spark's setting that removes the shuffle files of an action when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "llm_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name in ("llm", "reelhouse"):
            for folder, _, files in os.walk(os.path.join(top, name)):
                for f in files:
                    if f.endswith(".py"):
                        z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), top))
    sc.addPyFile(path)
    sc._llm_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each altered until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (partitioned by ``by``) to shared storage and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    The files live in the checkpoint folder and go when that is cleaned, or by ``release``.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


@contextmanager
def short_lived_shuffles(spark: SparkSession, on: bool = True) -> Iterator[None]:
    """Shuffle files go when the action ends that made them, not when the driver's memory is collected."""
    before = spark.conf.get(CLEANUP, None)
    if on:
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if on and before is None:
            spark.conf.unset(CLEANUP)
        elif on:
            spark.conf.set(CLEANUP, before)


def release(*tables: DataFrame) -> None:
    """Remove the files of materialised tables whose results have been written."""
    for t in tables:
        if path := getattr(t, "_llm_path", None):
            Folders(t.sparkSession).remove(path)
