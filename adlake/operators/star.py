"""Star schema: calendar, product dimension, fact and grouped data products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.fixed import ADDITIVE, NOT_SOURCED
from adlake.functions import date_key, positive_ratio
from adlake.operators.keys import attach_keys

CHANNEL_KEY = ["channel", "source_system"]
CAMPAIGN_KEY = ["campaign_id", "campaign_name", "campaign_objective"]
PRODUCT_KEY = ["product_id", "product_name", "brand", "category"]
LOADED = ["batch_id", "ingestion_utc"]


def calendar(frame: DataFrame, date_column: str) -> DataFrame:
    """One row per date in the data, with its calendar attributes."""
    day = F.col("date")
    return frame.select(F.col(date_column).alias("date")).distinct().select(
        day,
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    )


def product_dimension(silver: DataFrame) -> DataFrame:
    """Promoted products keyed by their own id; price, rating and stock are not sourced."""
    return silver.select(*PRODUCT_KEY).distinct().select(
        F.col("product_id").alias("product_key"),
        "product_name",
        "brand",
        "category",
        F.lit(None).cast("decimal(18,2)").alias("list_price"),
        F.lit(None).cast("decimal(9,2)").alias("rating"),
        F.lit(NOT_SOURCED).alias("availability_status"),
    )


def performance_fact(
    silver: DataFrame, channels: DataFrame, campaigns: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Silver rows with surrogate keys in place of natural ones, and row-level ratios."""
    return with_ratios(keyed_rows(silver, channels, campaigns, null_safe))


def keyed_rows(silver: DataFrame, channels: DataFrame, campaigns: DataFrame, null_safe: bool = False) -> DataFrame:
    """The fact without its ratios."""
    keyed = attach_keys(silver, channels, CHANNEL_KEY, "channel_key", null_safe)
    keyed = attach_keys(keyed, campaigns, CAMPAIGN_KEY, "campaign_key", null_safe)
    return keyed.select(
        date_key(F.col("event_date")).alias("date_key"),
        "channel_key",
        "campaign_key",
        F.col("product_id").alias("product_key"),
        "region",
        "device_category",
        *ADDITIVE,
        "video_views",
        "engagements",
        *LOADED,
    )


def with_ratios(keyed: DataFrame) -> DataFrame:
    """Keyed rows with their row-level ratios, ahead of what tells the load."""
    return keyed.select(
        *[c for c in keyed.columns if c not in LOADED],
        positive_ratio(F.col("clicks"), F.col("impressions")).alias("click_through_rate"),
        positive_ratio(F.col("spend"), F.col("clicks")).alias("cost_per_click"),
        positive_ratio(F.col("revenue"), F.col("spend")).alias("return_on_ad_spend"),
        *LOADED,
    )


def summarize(
    frame: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    ratios: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Sums per key, then ratios of those sums (null unless the denominator is positive)."""
    grouped = frame.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return grouped.withColumns(
        {name: positive_ratio(F.col(top), F.col(bottom)) for name, (top, bottom) in (ratios or {}).items()}
    )


def campaign_daily(fact: DataFrame, channels: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Daily totals per campaign and channel, with their names.

    Both keys determine their names, so the fact is summed by key first and only the
    sums are joined. That keeps the join small and indifferent to hot campaigns.
    """
    daily = summarize(
        fact, ["date_key", "campaign_key", "channel_key"], ADDITIVE, {"roas": ("revenue", "spend")}
    )
    named = daily.join(
        campaigns.select("campaign_key", "campaign_name", "campaign_objective"), "campaign_key", "inner"
    ).join(channels.select("channel_key", *CHANNEL_KEY), "channel_key", "inner")
    return named.select(
        "date_key", "campaign_key", "campaign_name", "campaign_objective",
        "channel_key", *CHANNEL_KEY, *ADDITIVE, "roas",
    )


def silver_summary(silver: DataFrame) -> DataFrame:
    """Rows, spend, revenue and conversions per source and channel."""
    return (
        silver.groupBy("source_system", "channel")
        .agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in ("spend", "revenue", "conversions")])
        .orderBy("source_system", "channel")
    )


def as_double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]
