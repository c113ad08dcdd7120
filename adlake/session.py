"""Session facts the library relies on: the shared folder and materialised frames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_REMOVED_AT_END: set[str] = set()
#: Files that a task of a partitioned write holds open at once. Only rows of further partitions are sorted first.
OPEN_FILES = 16
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, private to this application and removed when its JVM ends.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that runs on
    one machine may fall back to a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="adlake-")
        base = _LOCAL_FOLDERS[context.applicationId]
    folder = f"{base.rstrip('/')}/adlake/{context.applicationId}"
    if folder not in _REMOVED_AT_END:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)  # only what exists can be marked
        files.deleteOnExit(path)
        _REMOVED_AT_END.add(folder)
    return folder


def materialize(frame: DataFrame, label: str, partition_by: Sequence[str] = (), **options: object) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    The returned frame has no lineage to recompute when executors are lost, and its
    file size gives Catalyst a true bound for choosing broadcast joins.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/frames/{label}-{uuid.uuid4().hex}"
    frame.write.options(**{"compression": "zstd", **options}).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session for the time of a write."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)
