"""Splitting a sort order into ranges of near-equal size.

Sort-dependent operators (dense keys, forward fill) need work split along the order
itself, so that neither one task nor one key carries it all. The ranges are Spark's
own; each row's range is written down with it, so no later task can disagree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.session import materialize


def ranged(frame: DataFrame, order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """The frame with ``_bucket``, the number of its row's range in the order (nulls first).

    There are as many ranges as shuffle partitions, unless ``buckets`` says otherwise. The frame
    is read twice, for the bounds and for the rows, and written once.
    """
    sort = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    parts = buckets or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(frame.repartitionByRange(parts, *sort).withColumn("_bucket", F.spark_partition_id()), "ranges")
