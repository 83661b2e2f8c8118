"""Durable intermediates: tables and checkpoints in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediates, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder. On a cluster a machine-local folder would not be seen by the other
    executors, so a missing setting is an error there.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/cohortlens-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="cohortlens-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_written(spark: SparkSession) -> bool:
    """Delete all intermediates of this application; False if there were none.

    Results built from them cannot be read afterwards, so this comes last.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once as a shared parquet table and return a scan of it.

    For an intermediate that several later steps read: it is computed once, its
    columns are pruned per reader, and lost executors do not bring it back to
    the source scan.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` but keep its partitions and their row order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory or on disk inside the block, and release it after."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
