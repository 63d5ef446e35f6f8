"""Session helpers: the shared folder for cut lineage and staged tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[int] = Counter()  # open scopes by session
_before: dict[int, str] = {}
_scopes = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. A cluster
    without it is an error, because a machine-local folder dies with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="basketry-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside leave no shuffle files: they go when the query has run.

    Otherwise they stay on the executors' disks until the driver happens to collect its garbage, and those of
    every step add up. Scopes may overlap in threads; the setting is as before when the last one ends.
    """
    key = id(spark)
    with _scopes:
        if not _freeing[key]:
            _before[key] = spark.conf.get(FREED)
            spark.conf.set(FREED, "true")
        _freeing[key] += 1
    try:
        yield
    finally:
        with _scopes:
            _freeing[key] -= 1
            if not _freeing[key]:
                spark.conf.set(FREED, _before.pop(key))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint; its shuffle files go."""
    shared_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint()  # planned in this scope


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a staged table."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/staged/{app}/{name}-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables; call it when their results have been read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/staged/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back; its shuffle files go."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
