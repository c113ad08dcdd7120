"""Feature selection, skew-driven imputation and stable splits."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.ml.quantiles import SMALL_ROWS, medians
from adlake.operators.fill import ffill
from adlake.operators.pick import row_digest
from adlake.session import materialize

SKEW_LIMIT = 1.0
DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def clean_names(frame: DataFrame) -> DataFrame:
    """Column names with every run of characters outside A-Z, a-z, 0-9 and _ as one underscore."""
    return frame.toDF(*[re.sub("[^A-Za-z0-9_]+", "_", c) for c in frame.columns])


def numeric_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema if isinstance(f.dataType, T.NumericType)]


def datetime_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema if isinstance(f.dataType, DATETIME)]


def without_nan(frame: DataFrame) -> DataFrame:
    """NaN as null, so that both count as missing wherever statistics are taken or values filled."""
    floats = [f for f in frame.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return frame.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)) for f in floats}) if floats else frame


def drop_null_columns(frame: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all, where NaN is none; one pass decides for all of them."""
    filled = without_nan(frame).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in frame.columns]).first()
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if filled[c]])


def feature_columns(frame: DataFrame, categorical: Sequence[str] = ()) -> list[Column]:
    """Numeric and date-time columns plus the categories asked for; decimals as double."""
    chosen = []
    for f in frame.schema:
        if isinstance(f.dataType, T.DecimalType):
            chosen.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.NumericType, *DATETIME)) or f.name in categorical:
            chosen.append(F.col(f"`{f.name}`"))
    return chosen


def feature_frame(frame: DataFrame, categorical: Sequence[str] = ()) -> DataFrame:
    """The feature columns that hold a value."""
    return drop_null_columns(frame.select(*feature_columns(frame, categorical)))


def adjusted_skewness(column: str) -> Column:
    """Sample skewness with bias correction: null below three values, 0 without spread."""
    n = F.count(column).cast("double")
    g1 = F.skewness(F.col(column).cast("double"))
    spread = F.min(column) < F.max(column)
    corrected = g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n < 3, None).when(spread, corrected).otherwise(F.lit(0.0))


def skew_profile(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: value count, mean and adjusted skewness; one pass."""
    names = list(columns or numeric_columns(frame))
    measured = without_nan(frame).agg(
        *[F.count(c).alias(f"n_{c}") for c in names],
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in names],
        *[adjusted_skewness(c).alias(f"s_{c}") for c in names],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{c}").alias("value_count"),
            F.col(f"m_{c}").alias("mean"),
            F.col(f"s_{c}").alias("skewness"),
        )
        for c in names
    ]
    return measured.select(F.inline(F.array(*rows)))


def strategy(skewness: Column) -> Column:
    return (
        F.when(F.isnan(skewness), "most_frequent")
        .when(skewness <= SKEW_LIMIT, "mean")
        .when(skewness > SKEW_LIMIT, "median")
        .otherwise("most_frequent")
    )


def impute_plan(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each numeric column's fill strategy: mean up to skewness 1, median above, else most frequent."""
    return skew_profile(frame, columns).withColumn("strategy", strategy(F.col("skewness")))


def modes(frame: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the lowest on ties.

    Columns of one type share a pass: values are counted per column with map-side
    combining, so a frequent value costs no more than a rare one, and one best row
    per column and task goes on to the final choice.
    """
    found: dict[str, object] = dict.fromkeys(columns)
    frame = without_nan(frame)
    by_type: dict[str, list[int]] = {}
    for i, c in enumerate(columns):
        by_type.setdefault(frame.schema[c].dataType.simpleString(), []).append(i)
    for places in by_type.values():
        cells = [F.struct(F.lit(i).alias("place"), F.col(f"`{columns[i]}`").alias("value")) for i in places]
        counted = (
            frame.select(F.inline(F.array(*cells)))
            .filter(F.col("value").isNotNull())
            .groupBy("place", "value")
            .agg(F.count("*").alias("uses"))
        )
        best = F.min(F.struct((-F.col("uses")).alias("order"), F.col("value"))).alias("best")
        for row in counted.groupBy("place").agg(best).select("place", "best.value").collect():
            found[columns[row.place]] = row["value"]
    return found


@dataclass(frozen=True)
class Fill:
    column: str
    strategy: str
    value: object


def impute_stats(frame: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS) -> DataFrame:
    """Mean, exact median and mode of each numeric column, all as double."""
    frame = without_nan(frame)
    profile = {r.column_name: r for r in skew_profile(frame, columns).collect()}
    middle = medians(frame, {c: profile[c]["value_count"] for c in columns}, small_rows)
    frequent = modes(frame, columns)
    rows = [
        (c, profile[c]["mean"], middle[c], None if frequent[c] is None else float(frequent[c])) for c in columns
    ]
    return frame.sparkSession.createDataFrame(rows, "column_name string, mean double, median double, mode double")


def fit_impute(frame: DataFrame, small_rows: int = SMALL_ROWS) -> list[Fill]:
    """Fill values learnt from the training frame, one per column.

    Numeric columns follow :func:`impute_plan`; all others, dates included, take the mode.
    """
    frame = without_nan(frame)
    plan = {r.column_name: r for r in impute_plan(frame).collect()} if numeric_columns(frame) else {}
    by_strategy = {c: r.strategy for c, r in plan.items()}
    skewed = [c for c, s in by_strategy.items() if s == "median"]
    middle = medians(frame, {c: plan[c]["value_count"] for c in skewed}, small_rows)
    frequent = modes(frame, [c for c in frame.columns if by_strategy.get(c, "most_frequent") == "most_frequent"])
    fills = []
    for c in frame.columns:
        chosen = by_strategy.get(c, "most_frequent")
        value = {"mean": lambda: plan[c]["mean"], "median": lambda: middle[c]}.get(chosen, lambda: frequent[c])()
        fills.append(Fill(c, chosen, value))
    return fills


def apply_impute(frame: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """Nulls and NaNs replaced by the fitted values; mean- and median-filled columns become double."""
    by_column = {f.column: f for f in fills}
    frame = without_nan(frame)
    columns = []
    for f in frame.schema:
        value = F.col(f"`{f.name}`")
        fill = by_column.get(f.name)
        if fill and fill.strategy in ("mean", "median"):
            value = F.coalesce(value.cast("double"), F.lit(fill.value))
        elif fill and fill.value is not None:
            value = F.coalesce(value, F.lit(fill.value).cast(f.dataType))
        columns.append(value.alias(f.name))
    return frame.select(*columns)


def fill_datetimes(
    frame: DataFrame, fills: Sequence[Fill], partition_by: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Date-time columns forward-filled in the given order, then the fitted mode for what is left."""
    columns = [c for c in datetime_columns(frame) if c not in order_by]
    filled = ffill(frame, columns, partition_by, order_by) if columns else frame
    return apply_impute(filled, [f for f in fills if f.column in columns])


@dataclass(frozen=True)
class DateState:
    """Known date-times of fitted rows by group and order, which fill gaps of the same or other rows.

    A gap takes the last known value at or before it, of the fitted rows and of the filled frame's own. The state is a
    table that is ordered together with the frame, range by range; no task and no driver holds it whole.
    """

    partition_by: tuple[str, ...]
    order_by: tuple[str, ...]
    columns: tuple[str, ...]
    known: DataFrame

    @property
    def keys(self) -> tuple[str, ...]:
        return *self.partition_by, *self.order_by

    def apply(self, frame: DataFrame) -> DataFrame:
        """The frame with its gaps filled; those before any known value of their group stay null."""
        if not self.columns:
            return frame
        typed = self.known.select(*[F.col(f"`{c}`").cast(frame.schema[c].dataType).alias(c) for c in (*self.keys, *self.columns)])
        both = typed.withColumn("_given", F.lit(False)).unionByName(frame.withColumn("_given", F.lit(True)), allowMissingColumns=True)
        filled = ffill(both, self.columns, self.partition_by, [*self.order_by, "_given"])
        return filled.filter("_given").select(*[F.col(f"`{c}`") for c in frame.columns])


def fit_dates(frame: DataFrame, partition_by: Sequence[str], order_by: Sequence[str]) -> DateState:
    """The known values of the frame's date-time columns, other than those that set groups and order."""
    keys = [*partition_by, *order_by]
    columns = [c for c in datetime_columns(frame) if c not in keys]
    found = frame.select(*[F.col(f"`{c}`") for c in (*keys, *columns)])
    known = materialize(found.na.drop("all", subset=columns), "known_dates") if columns else found.limit(0)
    return DateState(tuple(partition_by), tuple(order_by), tuple(columns), known)


def hash_share(keys: Sequence[str], seed: int, parts: int = 100) -> Column:
    """A row's fixed place in 0 .. parts-1, set by its key and the seed alone."""
    digest = F.substring(row_digest(keys, seed), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(parts))


def hash_below(keys: Sequence[str], fraction: float, seed: int) -> Column:
    """Whether a row is in the part of the rows that its key's hash puts first."""
    return hash_share(keys, seed, 10_000) < int(fraction * 10_000)


def hash_split(frame: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash: the same rows whatever the partitioning."""
    below = hash_below(keys, fraction, seed)
    return frame.filter(below), frame.filter(~below)
