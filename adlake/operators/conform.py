"""Feeds of differing layout brought to one canonical layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.fixed import CANONICAL_COLUMNS, GRAIN
from adlake.functions import banker_round
from adlake.session import materialize

#: Most repeated keys that are sent to every task.
FEW_KEYS = 200_000


@dataclass(frozen=True)
class SourceMap:
    """How one feed fills the canonical columns.

    ``columns`` maps a canonical column to the feed column behind it and
    ``constants`` to a fixed text. What neither names becomes a typed null.
    """

    system: str
    channel: str
    prefix: str
    columns: Mapping[str, str]
    constants: Mapping[str, str] = field(default_factory=dict)

    @property
    def feed_columns(self) -> list[str]:
        return list(dict.fromkeys(self.columns.values()))


def conform(feed: DataFrame, source: SourceMap, types: Mapping[str, str] | None = None) -> DataFrame:
    """The feed as canonical columns; ``types`` overrides single canonical types."""
    fixed = {"source_system": source.system, "channel": source.channel, **source.constants}
    columns = []
    for name, kind in {**CANONICAL_COLUMNS, **(types or {})}.items():
        if name in fixed:
            value = F.lit(fixed[name])
        elif name in source.columns:
            value = F.col(source.columns[name])
        else:
            value = F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return feed.select(*columns)


def union_feeds(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def dedupe(frame: DataFrame, keys: Sequence[str] = GRAIN, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in the given order (default: all other columns, nulls first).

    Spark turns ``row_number() = 1`` into a per-task group limit ahead of the
    shuffle, so a key that holds a third of the table still sends one row per task.
    """
    first = list(order_by or [])
    rest = [c for c in frame.columns if c not in keys and c not in first]
    order = [F.col(c).asc_nulls_first() for c in first + rest]
    ranked = frame.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_place") == 1).drop("_place")


def dedupe_stored(
    frame: DataFrame, keys: Sequence[str] = GRAIN, order_by: Sequence[str] | None = None, few_keys: int = FEW_KEYS
) -> DataFrame:
    """As :func:`dedupe`, for frames in which few keys repeat: only rows whose key may repeat are shuffled and sorted whole.

    Keys are counted by a 64-bit hash, which is all the count sends. A hash met once belongs to a row that stays as it is;
    equal hashes of different keys only add rows to those that are deduplicated. With more than ``few_keys`` repeated
    hashes all rows are. The frame is read several times: pass a written table. Keys must not be floating numbers, whose
    equal zeros may differ in hash.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in keys])
    uses = frame.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count("*").alias("uses"))
    repeated = materialize(uses.filter("uses > 1").select("_hash"), "repeated_keys")
    if repeated.limit(few_keys + 1).count() > few_keys:
        return dedupe(frame, keys, order_by)
    told, hashes = frame.withColumn("_hash", hashed), F.broadcast(repeated)
    once = told.join(hashes, "_hash", "left_anti").drop("_hash")
    return once.unionByName(dedupe(told.join(hashes, "_hash", "left_semi").drop("_hash"), keys, order_by))


def round_money(frame: DataFrame, columns: Sequence[str], scale: int = 2, precision: int = 18) -> DataFrame:
    return frame.withColumns({c: banker_round(F.col(c), scale, precision) for c in columns})


# --- fixed values: feed layouts ----------------------------------------------
GOOGLE = SourceMap(
    system="Google Ads",
    channel="Paid Search",
    prefix="gads_",
    columns={
        "event_date": "gads_date",
        "campaign_id": "gads_campaign_id",
        "campaign_name": "gads_campaign_name",
        "campaign_objective": "gads_objective",
        "product_id": "gads_product_id",
        "product_name": "gads_vehicle_model",
        "brand": "gads_vehicle_brand",
        "category": "gads_vehicle_category",
        "region": "gads_region",
        "device_category": "gads_device",
        "impressions": "gads_impressions",
        "clicks": "gads_clicks",
        "sessions": "gads_clicks",
        "spend": "gads_spend",
        "conversions": "gads_conversions",
        "leads": "gads_conversions",
        "revenue": "gads_revenue",
        "ingestion_utc": "gads_ingested_utc",
        "batch_id": "gads_batch_id",
    },
)
META = SourceMap(
    system="Meta Ads",
    channel="Paid Social",
    prefix="meta_",
    columns={
        "event_date": "meta_date",
        "campaign_id": "meta_campaign_id",
        "campaign_name": "meta_campaign_name",
        "product_id": "meta_product_id",
        "product_name": "meta_auto_model",
        "brand": "meta_auto_make",
        "category": "meta_vehicle_class",
        "region": "meta_region",
        "impressions": "meta_impressions",
        "clicks": "meta_clicks",
        "sessions": "meta_clicks",
        "spend": "meta_spend",
        "conversions": "meta_leads",
        "leads": "meta_leads",
        "revenue": "meta_revenue",
        "video_views": "meta_video_views",
        "engagements": "meta_engagements",
        "ingestion_utc": "meta_ingested_utc",
        "batch_id": "meta_batch_id",
    },
    constants={"campaign_objective": "Social Engagement"},
)
LINKEDIN = SourceMap(
    system="LinkedIn Ads",
    channel="Paid Social B2B",
    prefix="li_",
    columns={
        "event_date": "li_date",
        "campaign_id": "li_campaign_id",
        "campaign_name": "li_campaign_name",
        "campaign_objective": "li_objective",
        "product_id": "li_product_id",
        "product_name": "li_promoted_model",
        "brand": "li_manufacturer",
        "category": "li_segment",
        "region": "li_region",
        "impressions": "li_impressions",
        "clicks": "li_clicks",
        "sessions": "li_clicks",
        "spend": "li_spend",
        "conversions": "li_conversions",
        "leads": "li_leads",
        "revenue": "li_revenue",
        "ingestion_utc": "li_ingested_utc",
        "batch_id": "li_batch_id",
    },
)
FEEDS = {
    "src_google_ads_raw": GOOGLE,
    "src_meta_ads_raw": META,
    "src_linkedin_ads_raw": LINKEDIN,
}
