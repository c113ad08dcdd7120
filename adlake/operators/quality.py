"""Validity rules and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed import ATTRIBUTE_SUFFIXES, VALID

#: Status of rows that break a rule.
REJECTED = "Rejected"


@dataclass(frozen=True)
class Rule:
    """A reason and the SQL condition a valid row meets; null counts as not met."""

    reason: str
    condition: str

    @property
    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(False))


PERFORMANCE_RULES = (
    Rule("missing event_date", "event_date IS NOT NULL"),
    Rule("missing campaign_id", "campaign_id IS NOT NULL"),
    Rule("negative spend", "coalesce(spend, 0) >= 0"),
    Rule("negative revenue", "coalesce(revenue, 0) >= 0"),
    Rule("clicks above impressions", "coalesce(clicks <= impressions, true)"),
)


def valid_rows(frame: DataFrame, rules: Sequence[Rule] = PERFORMANCE_RULES) -> DataFrame:
    return reduce(lambda kept, rule: kept.filter(rule.condition), rules, frame)


def judged_rows(frame: DataFrame, rules: Sequence[Rule] = PERFORMANCE_RULES) -> DataFrame:
    """All rows with ``reasons``, the rules each breaks, and ``quality_status``."""
    reasons = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.reason)) for r in rules]))
    status = F.when(F.size("reasons") == 0, F.lit(VALID)).otherwise(F.lit(REJECTED))
    return frame.withColumn("reasons", reasons).withColumn("quality_status", status)


def rejected_rows(frame: DataFrame, rules: Sequence[Rule] = PERFORMANCE_RULES) -> DataFrame:
    """Rows that break a rule, with every reason in ``reasons``."""
    reasons = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.reason)) for r in rules]))
    return frame.withColumn("reasons", reasons).filter(F.size("reasons") > 0)


def split_valid(frame: DataFrame, rules: Sequence[Rule] = PERFORMANCE_RULES) -> tuple[DataFrame, DataFrame]:
    return valid_rows(frame, rules), rejected_rows(frame, rules)


def source_counts(silver: DataFrame) -> DataFrame:
    """Audit table: valid rows per source and when they were counted."""
    return silver.groupBy("source_system").count().withColumn("validated_utc", F.current_timestamp())


def incomplete_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the number of null values, and rows with any of them null; one pass."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return frame.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.count_if(any_null).alias("incomplete_rows"),
    )


def complete_rows(frame: DataFrame, suffixes: Sequence[str] = ATTRIBUTE_SUFFIXES) -> DataFrame:
    """The attribute columns (found by name suffix) of the rows that fill them all."""
    chosen = [c for c in frame.columns if c.endswith(tuple(suffixes))]
    return frame.select(*chosen).na.drop(how="any")


def distinct_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values of each column in one job.

    Rows are reduced to their distinct combinations first, within each task before the shuffle, and only those are
    expanded once per column.
    """
    return frame.select(*[F.col(c) for c in columns]).distinct().agg(*[F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in columns])


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return frame.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def key_gaps(frame: DataFrame, members: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """name, gap_keys, gap_rows: keys of the frame without a member, per named key column.

    members: name -> (key column of the frame, frame whose first column holds the members). All columns are
    counted in one pass; a key crosses the network once per task however many rows hold it.
    """
    cells = [F.struct(F.lit(n).alias("name"), F.col(key).cast("bigint").alias("key")) for n, (key, _) in members.items()]
    used = frame.select(F.inline(F.array(*cells))).groupBy("name", "key").agg(F.count("*").alias("rows"))
    known = [m.select(F.lit(n).alias("name"), F.col(m.columns[0]).cast("bigint").alias("key")) for n, (_, m) in members.items()]
    lost = used.join(reduce(DataFrame.unionAll, known), ["name", "key"], "left_anti")
    counts = lost.groupBy("name").agg(F.count("*").alias("gap_keys"), F.sum("rows").alias("gap_rows"))
    names = frame.sparkSession.createDataFrame([(n,) for n in members], "name string")
    return names.join(counts, "name", "left").na.fill(0, ["gap_keys", "gap_rows"])


def orphan_counts(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows and distinct keys without a member, per dimension."""
    gaps = key_gaps(fact, {n: (key, dim.select(key)) for n, (dim, key) in dims.items()})
    return gaps.toDF("dimension", "orphan_keys", "orphan_rows")


def check_layout(frame: DataFrame, prefix: str, max_width: int) -> list[str]:
    """Contract breaches of a feed's column names: wrong prefix, too wide."""
    wrong = [f"column {c} lacks prefix {prefix}" for c in frame.columns if not c.startswith(prefix)]
    wide = [f"{len(frame.columns)} columns, at most {max_width}"] if len(frame.columns) > max_width else []
    return wrong + wide


def load_summary(feeds: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per loaded feed: name, rows, columns and column prefix."""
    return reduce(
        DataFrame.unionByName,
        [
            frame.agg(
                F.lit(name).alias("bronze_table"),
                F.count("*").alias("row_count"),
                F.lit(len(frame.columns)).alias("column_count"),
                F.lit(prefix).alias("source_prefix"),
            )
            for name, (frame, prefix) in feeds.items()
        ],
    )


@dataclass(frozen=True)
class Check:
    """A named one-row aggregate over a frame and the value it should have.

    ``aggregate`` is SQL; ``expected`` may be None to record a value unjudged.
    """

    name: str
    frame: DataFrame
    aggregate: str
    expected: int | None = None


def dq(checks: Sequence[Check], known: Sequence[tuple[str, int | None, int]] = ()) -> DataFrame:
    """One row per check: expected, actual and whether they agree.

    Checks on the same frame share one pass over it. known: name, expected and actual of checks whose value was
    counted before, as while a table was written.
    """
    by_frame: dict[int, list[Check]] = {}
    for check in checks:
        by_frame.setdefault(id(check.frame), []).append(check)

    def run(group: list[Check]) -> DataFrame:
        totals = group[0].frame.agg(*[F.expr(c.aggregate).cast("bigint").alias(f"_{i}") for i, c in enumerate(group)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.expected).cast("bigint").alias("expected"),
                    F.col(f"_{i}").alias("actual"),
                )
                for i, c in enumerate(group)
            ]
        )
        return totals.select(F.inline(rows))

    parts = [run(group) for group in by_frame.values()]
    if known:
        spark = SparkSession.getActiveSession()
        parts.append(spark.createDataFrame(list(known), "check_name string, expected bigint, actual bigint"))
    report = reduce(DataFrame.unionByName, parts)
    agrees = F.col("expected").isNull() | F.col("actual").eqNullSafe(F.col("expected"))
    return report.withColumn("passed", agrees)


def not_valid() -> str:
    """Aggregate for :class:`Check`: rows whose status is anything but valid."""
    return f"count_if(quality_status <> '{VALID}')"
