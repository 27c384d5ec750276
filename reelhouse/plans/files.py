"""Folders on any Hadoop file system, through the session's JVM (driver side only)."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import checkpoint_dir


class Folders:
    """The few file operations table writes need: look, move, remove, small JSON notes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def has_data(self, path: str) -> bool:
        """Does a file other than hidden ones (_SUCCESS, .crc) lie anywhere below?"""
        fs, p = self._at(path)
        if not fs.exists(p):
            return False
        files = fs.listFiles(p, True)
        while files.hasNext():
            if not files.next().getPath().getName().startswith(("_", ".")):
                return True
        return False

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def remove_at_exit(self, path: str) -> str:
        """``path``, which goes when the driver ends."""
        fs, p = self._at(path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        return path

    def write_note(self, path: str, note: dict) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(note).encode()))
        finally:
            out.close()

    def put_once(self, path: str, note: dict) -> bool:
        """Write ``note`` whole under a name that nobody has taken yet; False if it's taken.

        The note is written beside and renamed without overwriting, which the
        file system does in one step (HDFS; elsewhere as its rename allows).
        """
        made = f"{path}.{uuid.uuid4().hex}.tmp"
        self.write_note(made, note)
        jvm = self._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
        source, target = jvm.Path(made), jvm.Path(path)
        files = jvm.FileContext.getFileContext(target.toUri(), self._conf) if target.toUri().getScheme() else jvm.FileContext.getFileContext(self._conf)
        try:
            files.rename(source, target, none)
            return True
        except Py4JJavaError as error:
            self.remove(made)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise

    def data_files(self, path: str) -> list[str]:
        """Names of the data files right in a folder."""
        return [n for n in self.names(path) if not n.startswith(("_", "."))]

    def age(self, path: str) -> float:
        """Seconds since a folder or file was last changed."""
        fs, p = self._at(path)
        return self._jvm.java.lang.System.currentTimeMillis() / 1000 - fs.getFileStatus(p).getModificationTime() / 1000

    def read_note(self, path: str) -> dict | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        data = fs.open(p)
        try:
            return json.loads(bytes(data.readAllBytes()))
        finally:
            data.close()


def stage(df: DataFrame, root: str) -> tuple[DataFrame, str, int]:
    """Evaluate ``df`` once into the shared checkpoint folder: (the copy, its path, its rows)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark, fallback_root=root).rstrip('/')}/staged-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path, int(seen.get["n"])
