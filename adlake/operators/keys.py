"""Dense surrogate keys and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.ranges import ranged
from adlake.session import materialize

SMALL_ROWS = 100_000


def dense_key(
    frame: DataFrame, order: Sequence[str], key_name: str, small_rows: int = SMALL_ROWS, buckets: int | None = None
) -> DataFrame:
    """Number rows 1..n in the given order (nulls first); order tuples must be distinct.

    Up to ``small_rows`` rows one window does it. Beyond that rows are numbered
    within ranges and shifted by the count of all earlier ranges, so the sort is
    spread over tasks; only the counts of the ranges reach the driver. The frame is
    read several times: pass a written table, not a long plan.
    """
    rows = frame.count()
    sort = [F.col(c).asc_nulls_first() for c in order]
    if rows <= small_rows:
        return frame.withColumn(key_name, F.row_number().over(Window.orderBy(*sort)))
    placed = ranged(frame, order, buckets)
    counts = dict(placed.groupBy("_bucket").count().collect())
    starts, total = [], 0
    for bucket in range(max(counts) + 1):
        starts.append(total)
        total += counts.get(bucket, 0)
    whole = "int" if total < 2**31 else "bigint"
    start = F.get(F.array(*[F.lit(s).cast(whole) for s in starts]), F.col("_bucket"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*sort))
    return placed.withColumn(key_name, (start + local).cast(whole)).drop("_bucket")


def dimension(
    frame: DataFrame, natural_key: Sequence[str], key_name: str, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Distinct natural keys with a dense surrogate key in natural-key order.

    The distinct members are written once, because numbering reads them repeatedly.
    """
    members = materialize(frame.select(*natural_key).distinct(), key_name)
    return dense_key(members, natural_key, key_name, small_rows)


def unkeyed_rows(frame: DataFrame, dim: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Natural keys an inner join on them would drop (a null part, or no member), with their rows.

    Rows are counted per key first, so a hot key reaches the join once per task.
    """
    used = frame.groupBy(*natural_key).agg(F.count("*").alias("rows"))
    return used.join(dim.select(*natural_key), list(natural_key), "left_anti")


def attach_keys(
    fact: DataFrame, dim: DataFrame, natural_key: Sequence[str], key_name: str, null_safe: bool = False
) -> DataFrame:
    """Inner join that adds the surrogate key; a null key part drops the row unless ``null_safe``.

    No broadcast is forced: a dimension read from a table carries its size, and
    Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``; above that
    the join shuffles and adaptive execution splits hot keys.
    """
    if not null_safe:
        return fact.join(dim.select(*natural_key, key_name), list(natural_key), "inner")
    other = dim.select(*[F.col(c).alias(f"_{c}") for c in natural_key], key_name)
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in natural_key]
    return fact.join(other, match, "inner").drop(*[f"_{c}" for c in natural_key])
