"""Ad feeds derived from order, part and customer tables.

Each order line becomes one ad signal of one platform, chosen by its return flag.
Duplicates on the dedupe grain, missing dates, negative revenue, clicks above
impressions and zero denominators come with the data, so every rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.conform import FEEDS, GOOGLE, LINKEDIN, META, SourceMap
from adlake.sources.scan import scan

INPUTS = ["lineitem", "orders", "part", "customer", "nation", "region"]

# --- fixed values: how the feeds are derived ---------------------------------
SYSTEM_OF_FLAG = {"A": GOOGLE.system, "N": META.system}
INGESTED = "2024-01-01 00:00:00"
BATCH = "fixture"
TIE_ORDER = ["campaign_objective", "device_category", "impressions", "clicks", "spend", "revenue"]
FEED_MONEY = {"spend": "decimal(38,4)", "revenue": "decimal(38,4)"}
CLICKS_PER_CONVERSION = {GOOGLE.system: 10, META.system: 5, LINKEDIN.system: 20}
CLICKS_PER_LEAD = {LINKEDIN.system: 5, META.system: 5}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{name}.parquet", folder)


def ad_signals(spark: SparkSession, folder: str) -> DataFrame:
    """All signals of all platforms, each column under its canonical name.

    Nation and region are joined to customers first; join strategies and the order of
    the large joins are left to the optimizer.
    """
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("region"))
    customers = _table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "region"
    )
    orders = _table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_mktsegment", "region"
    )
    lines = (
        _table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    flag = F.col("l_returnflag")
    system = F.when(flag == "A", GOOGLE.system).when(flag == "N", META.system).otherwise(LINKEDIN.system)
    price, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    sign = F.when(F.col("l_quantity") == 1, -1).otherwise(1)
    return lines.select(
        F.when((F.col("l_quantity") == 50) & (F.col("l_linenumber") == 1), None)
        .otherwise(F.col("l_shipdate").cast("date"))
        .alias("event_date"),
        system.alias("source_system"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") + 100).alias("campaign_id"),
        F.expr("substring(o_orderpriority, 3)").alias("campaign_name"),
        F.col("c_mktsegment").alias("campaign_objective"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        "region",
        F.when(F.col("l_linestatus") == "F", "Desktop").otherwise("Mobile").alias("device_category"),
        F.when(F.col("l_linenumber") == 7, F.lit(0).cast("bigint"))
        .otherwise((F.col("l_quantity") * 100).cast("bigint"))
        .alias("impressions"),
        (F.col("l_quantity").cast("bigint") * F.floor(F.col("l_discount") * 100 + 0.5)).alias("clicks"),
        (price * discount).cast("decimal(38,4)").alias("spend"),
        (sign * price * (1 + F.col("l_tax")).cast("decimal(4,2)")).cast("decimal(38,4)").alias("revenue"),
    )


def feed(signals: DataFrame, source: SourceMap) -> DataFrame:
    """One platform's signals under that platform's own column names."""
    clicks = F.col("clicks")

    def per(rates: dict[str, int]):
        return F.floor(clicks / rates[source.system]).cast("bigint") if source.system in rates else None

    derived = {
        "conversions": per(CLICKS_PER_CONVERSION),
        "leads": per(CLICKS_PER_LEAD),
        "video_views": F.floor(F.col("impressions") / 4).cast("bigint"),
        "engagements": F.floor(F.col("impressions") / 40).cast("bigint"),
        "ingestion_utc": F.to_timestamp_ntz(F.lit(INGESTED)),
        "batch_id": F.lit(BATCH),
    }
    # A feed column that fills several canonical ones carries the first one's signal.
    behind: dict[str, str] = {}
    for canonical, column in source.columns.items():
        behind.setdefault(column, canonical)
    rows = signals.filter(F.col("source_system") == source.system)
    return rows.select(
        *[(derived[c] if c in derived else F.col(c)).alias(column) for column, c in behind.items()]
    )


def feeds(signals: DataFrame) -> dict[str, DataFrame]:
    return {name: feed(signals, source) for name, source in FEEDS.items()}


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Identity of the input files: their paths, times and sizes. Reads no content."""
    files = spark.read.format("binaryFile").load([f"{folder.rstrip('/')}/{n}.parquet" for n in INPUTS])
    facts = files.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")).alias("h"),
    ).first()
    return f"{facts.n}-{facts.h}"
