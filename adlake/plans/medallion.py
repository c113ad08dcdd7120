"""The load job: feeds to a conformed table to a star schema, each stage a stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed import GRAIN, MONEY, VALID
from adlake.operators.conform import FEEDS, SourceMap, conform, dedupe_stored, round_money, union_feeds
from adlake.operators.keys import dimension
from adlake.operators.layout import clustered, file_count
from adlake.operators.pick import pick_member
from adlake.operators.quality import PERFORMANCE_RULES, REJECTED, Rule, judged_rows, source_counts, split_valid, valid_rows
from adlake.operators.star import (
    CAMPAIGN_KEY,
    CHANNEL_KEY,
    calendar,
    campaign_daily,
    keyed_rows,
    product_dimension,
    with_ratios,
)
from adlake.plans.graph import Ontology, performance_ontology
from adlake.plans.performance import performance_model
from adlake.plans.semantic import Model
from adlake.session import materialize
from adlake.sources.tables import TableStore, align_to_schema

JUDGED = "conformed/judged_performance"
SILVER = "conformed/marketing_performance"
REJECTS = "conformed/rejected_performance"
AUDIT = "audit/source_row_counts"
GOLD = {
    "date": "dimensions/dim_date",
    "channel": "dimensions/dim_channel",
    "campaign": "dimensions/dim_campaign",
    "product": "dimensions/dim_product",
    "fact": "facts/fct_marketing_performance",
    "daily": "data_products/dp_campaign_daily",
}
LAYOUT = ["date_key", "campaign_key"]



def _valid(condition: str = "true") -> str:
    return f"count_if(quality_status = '{VALID}' AND ({condition}))"


#: Counted while silver and rejected rows are written.
SILVER_METRICS = {
    "valid": _valid(),
    "rejected": f"count_if(quality_status = '{REJECTED}')",
    "valid_with_reasons": _valid("size(reasons) > 0"),
    "without_attributes": _valid("product_name IS NULL OR brand IS NULL OR category IS NULL"),
    "without_keys": _valid(" OR ".join(f"{c} IS NULL" for c in [*CHANNEL_KEY, *CAMPAIGN_KEY])),
}


@dataclass(frozen=True)
class SilverPlan:
    """How feeds become silver; every part can differ from the default."""

    sources: Mapping[str, SourceMap]
    types: Mapping[str, str]
    grain: Sequence[str] = tuple(GRAIN)
    tie_order: Sequence[str] | None = None
    rules: Sequence[Rule] = PERFORMANCE_RULES
    filter_first: bool = False

    def unioned(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        return union_feeds([conform(feeds[name], source, self.types) for name, source in self.sources.items()])

    def deduped(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        rows = self.unioned(feeds)
        return dedupe_stored(valid_rows(rows, self.rules) if self.filter_first else rows, self.grain, self.tie_order)

    def silver(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        """Valid rows, one per grain, money rounded. Duplicates go before invalid rows do,
        so an invalid duplicate can displace a valid row unless ``filter_first``."""
        rows = self.deduped(feeds)
        kept = rows if self.filter_first else valid_rows(rows, self.rules)
        return round_money(kept, MONEY).withColumn("quality_status", F.lit(VALID))

    def judged(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        """Silver and rejected rows in one frame, told apart by quality_status, with reasons and the rejected rows' own money.

        Rows are deduplicated once. With ``filter_first`` the two differ in what is deduplicated, so both are computed.
        """
        def told(rows: DataFrame) -> DataFrame:
            own = {f"raw_{c}": F.when(F.col("quality_status") == REJECTED, F.col(c)) for c in MONEY}
            return round_money(judged_rows(rows, self.rules).withColumns(own), MONEY)

        if not self.filter_first:
            return told(self.deduped(feeds))
        return told(self.deduped(feeds)).unionByName(told(self.unioned(feeds)).filter(F.col("quality_status") == REJECTED))

    def rejected(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        rows = self.unioned(feeds) if self.filter_first else self.deduped(feeds)
        return split_valid(rows, self.rules)[1]


DEFAULT_PLAN = SilverPlan(FEEDS, {})


@dataclass(frozen=True)
class Medallion:
    """The load over one table store. Steps run in order; each reads what the last one wrote."""

    store: TableStore
    plan: SilverPlan = DEFAULT_PLAN
    null_safe_keys: bool = False

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def load_bronze(self, feeds: Mapping[str, DataFrame]) -> None:
        for name, frame in feeds.items():
            self.store.write(frame, name)

    def bronze(self) -> dict[str, DataFrame]:
        return {name: self.store.read(name) for name in self.plan.sources}

    def write_silver(self, feeds: Mapping[str, DataFrame]) -> DataFrame:
        """Write the conformed rows of some feeds, valid and rejected ones apart, in one pass; silver and rejects show their part of it.

        Checks are counted by that write, and a failed one leaves the table as it was.
        """
        judged = self.plan.judged(feeds)
        raw = [f"raw_{c}" for c in MONEY]
        self.store.write(judged, JUDGED, partition_by=["quality_status"], metrics=SILVER_METRICS, expected={"valid_with_reasons": 0})
        own = [c for c in judged.columns if c not in ("reasons", "quality_status", *raw)]
        rejects = [f"raw_{c} AS {c}" if c in MONEY else f"`{c}`" for c in own]
        self.store.show(REJECTS, JUDGED, [*rejects, "reasons"], f"quality_status = '{REJECTED}'")
        self.store.show(SILVER, JUDGED, [*(f"`{c}`" for c in own), "quality_status"], f"quality_status = '{VALID}'")
        return self.store.read(SILVER)

    def silver_metrics(self) -> dict[str, int]:
        """Counts of the last write of silver: valid and rejected rows, valid ones without attributes or keys."""
        return self.store.metrics(JUDGED)

    def build_silver(self, audit: bool = True) -> DataFrame:
        """Write the conformed table, then its audit counts from what was written."""
        silver = self.write_silver(self.bronze())
        if audit:
            self.store.write(source_counts(silver), AUDIT, unique=["source_system"])
        return silver

    def build_gold(self, files: int | None = None) -> dict[str, DataFrame]:
        """Write dimensions, fact and daily product; fact and product clustered by date and campaign.

        A dimension whose key names several members is refused, and so is a fact that lost rows other than those
        of silver without a key.
        Dimensions are written before the fact reads them: their file size is then known
        and decides how they are joined. Fact and product are written down once before
        their layout, which reads them twice, so the joins run once. Row ratios follow from the
        other columns and come after the layout, which needn't carry them.
        """
        silver = self.store.read(SILVER)
        self.store.write(calendar(silver, "event_date"), GOLD["date"], unique=["date_key"])
        self.store.write(dimension(silver, CHANNEL_KEY, "channel_key"), GOLD["channel"], unique=["channel_key"])
        self.store.write(dimension(silver, CAMPAIGN_KEY, "campaign_key"), GOLD["campaign"], unique=["campaign_key"])
        self.store.write(product_dimension(silver), GOLD["product"], unique=["product_key"])
        channels, campaigns = self.store.read(GOLD["channel"]), self.store.read(GOLD["campaign"])
        fact = materialize(keyed_rows(silver, channels, campaigns, self.null_safe_keys), "fact")
        laid = with_ratios(clustered(fact, LAYOUT, files or self._files(fact)))
        self.store.write(laid, GOLD["fact"], expected=self._fact_rows())
        daily = materialize(campaign_daily(self.store.read(GOLD["fact"]), channels, campaigns), "campaign_daily")
        self.store.write(clustered(daily, LAYOUT, files or self._files(daily)), GOLD["daily"])
        return self.gold()

    def _fact_rows(self) -> dict[str, int]:
        known = self.silver_metrics()
        return {"rows": known["valid"] - (0 if self.null_safe_keys else known["without_keys"])}

    def optimize(self, files: int | None = None) -> None:
        """Cluster fact and daily product anew, after appends."""
        for name in ("fact", "daily"):
            table = materialize(self.store.read(GOLD[name]), name)
            self.store.write(clustered(table, LAYOUT, files or self._files(table)), GOLD[name])

    def _files(self, table: DataFrame) -> int:
        return file_count(table.count(), self.spark.sparkContext.defaultParallelism)

    def gold(self) -> dict[str, DataFrame]:
        return {name: self.store.read(path) for name, path in GOLD.items()}

    def refresh(self) -> Model:
        """The governed model over the tables as they are now."""
        return performance_model(self.gold())

    def ontology(self) -> Ontology:
        return performance_ontology(self.gold())

    def run(self, feeds: Mapping[str, DataFrame], files: int | None = None) -> Model:
        self.load_bronze(feeds)
        self.build_silver()
        self.build_gold(files)
        return self.refresh()


def movement_row(
    gold: Mapping[str, DataFrame],
    date_key: int,
    spend: float,
    roas: float,
    batch_id: str,
    impressions: int,
    clicks: int,
    conversions: int,
    seed: int,
) -> DataFrame:
    """One what-if fact row: members picked by seed, revenue = spend x ROAS, aligned to the fact.

    The date is taken as given; a date the calendar lacks reports under the blank member.
    """
    spark = gold["fact"].sparkSession
    chosen = {
        key: pick_member(gold[name], key, seed).first()[0]
        for name, key in (("campaign", "campaign_key"), ("channel", "channel_key"), ("product", "product_key"))
    }
    values = {
        "date_key": date_key, **chosen, "batch_id": batch_id, "spend": spend, "return_on_ad_spend": roas,
        "impressions": impressions, "clicks": clicks, "conversions": conversions, "revenue": spend * roas,
    }
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return align_to_schema(row, gold["fact"].schema)


def insert_movement(job: Medallion, **movement) -> DataFrame:
    """Append one what-if row to the fact table and return it."""
    row = movement_row(job.gold(), **movement)
    job.store.append(row, GOLD["fact"])
    return row
