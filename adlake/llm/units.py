"""Units: hash-dealt groups of whole documents of a few megabytes, and the exchange of hashes between them.

An operator that asks "does this hash also occur elsewhere" sends each distinct hash of a
unit once to the bucket of the hash, and the bucket answers the unit. So a hash that a third
of all documents hold costs one entry per unit, never one per document.
"""

from __future__ import annotations

import gc
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT_BYTES = 4 << 20


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files and broadcasts of frames that are written and no longer referred to.

    It acts on what the driver's garbage collection finds, which by itself may come long after many rounds of a job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def with_units(docs: DataFrame, unit_bytes: int = UNIT_BYTES) -> tuple[DataFrame, int]:
    """doc_id, text and a unit dealt by doc_id; the number of units follows the bytes of all texts.

    Rows without a doc_id are no documents and are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    count = max(1, math.ceil(text_bytes(docs) / unit_bytes))
    return docs.withColumn("unit", F.expr(f"pmod(xxhash64(doc_id), {count}L)")), count


def cut(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, first and last place of each run of ascending hashes that go to one bucket."""
    if not len(hashes):
        return []
    bucket = (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    firsts = [0, *edges.tolist()]
    return [(int(bucket[a]), a, b) for a, b in zip(firsts, [*firsts[1:], len(hashes)], strict=True)]
