"""Intermediate tables in the folder shared by all executors.

Iterative operators cut their lineage by writing a table there and reading it back: the files survive the loss of an executor, which
blocks kept by executors do not. The folder is ``spark.checkpoint.dir``; only where that is unset and the master is local (tests, a laptop)
a temporary one is made.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
#: With it, the files of a query's shuffles go when the query has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session, or under a local master a fresh one that is removed at exit. A cluster must name one: a folder
    of one machine would be read half empty by the others."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="sievework-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return "file://" + _local[0]


class Scratch:
    """Tables of one run of an operator. ``drop`` removes one that nothing will read again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        atexit.register(self.clear)

    def write(self, df: DataFrame, name: str = "t", release: bool = False) -> DataFrame:
        """Materialise ``df`` and return a DataFrame that reads the written files. ``release``: its shuffles' files are removed then."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        before = self.spark.conf.get(CLEANUP, None)
        try:
            if release:
                self.spark.conf.set(CLEANUP, "true")
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            if release:
                self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            self._delete(path)

    def clear(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001 - the session may have ended already
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
