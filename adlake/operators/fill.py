"""Forward fill along an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.ranges import ranged
from adlake.session import materialize


def ffill(
    frame: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Replace each null by the last value before it within its group, in the given order.

    ``order_by`` must be total within a group. Rows are cut into ranges over (group,
    order), so one huge group becomes many window partitions. A value may then have to
    cross the borders of ranges: that concerns only the groups that ranges begin with, so
    the carried values are few, at most two a range, and are broadcast. The source is read once.
    """
    placed = ranged(materialize(frame, "unfilled"), [*partition_by, *order_by], buckets)
    groups = [*partition_by, "_bucket"]
    sort = [F.col(c).asc_nulls_first() for c in order_by]
    window = Window.partitionBy(*groups).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(window) for c in columns}
    first = placed.groupBy("_bucket").agg(F.min(F.struct(*[F.col(c).alias(f"_cut_{c}") for c in partition_by])).alias("g"))
    cut_groups = first.select("g.*").distinct()

    def same(prefix: str):
        return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in partition_by]

    at = F.struct(*[F.col(c) for c in order_by])
    ends = (
        placed.join(F.broadcast(cut_groups), same("_cut_"), "left_semi")
        .groupBy(*groups)
        .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])
    )
    before = (
        Window.partitionBy(*partition_by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        *[F.col(c).alias(f"_carry_{c}") for c in groups],
        *[F.last(c, ignorenulls=True).over(before).alias(f"_last_{c}") for c in columns],
    )
    match = [*same("_carry_"), F.col("_bucket") == F.col("_carry__bucket")]
    joined = placed.withColumns(filled).join(F.broadcast(carried), match, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_last_{c}")).alias(c) if c in columns else F.col(c) for c in frame.columns]
    )
