"""Every operator and report as a named query over one input folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.fixed import ADDITIVE, CATALOG_TABLE, CATALOG_TYPES, GRAIN, MAX_FEED_WIDTH, MONEY, PREDICTION, TRAINING_SEED
from adlake.functions import positive_ratio
from adlake.ml import features, ridge, training
from adlake.operators import fill, keys, layout, pick, presence, quality, star
from adlake.operators.conform import FEEDS, META, conform, round_money
from adlake.plans import reports
from adlake.plans.lake import PLAN, Lake, lake
from adlake.plans.medallion import AUDIT, GOLD, REJECTS, Medallion, insert_movement
from adlake.plans.semantic import Between, Having, Members, Model
from adlake.session import OPEN_FILES, OPEN_FILES_SETTING, materialize, setting, shared_folder
from adlake.sources.records import coerce, explode_records, landed_files, parse_records, select_or_null
from adlake.sources.records import typed_catalog as records_to_catalog
from adlake.sources.scan import scan
from adlake.sources.signals import FEED_MONEY
from adlake.sources.tables import TableStore, align_to_schema, batch_stamp

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_ROWS = 10_000
NUMERIC = [*ADDITIVE, "video_views", "engagements"]
MOVEMENT = {
    "date_key": 20991231, "channel_key": 1, "campaign_key": 1, "product_key": 1, "spend": 2011.0,
    "return_on_ad_spend": 2.0, "revenue": 4022.0, "impressions": 1000, "clicks": 50, "conversions": 1,
    "batch_id": "manual", "synthetic_batch_row_id": "dropped on alignment",
}
RATIOS = ["click_through_rate", "cost_per_click", "return_on_ad_spend"]
RATIO_SCALE = 6


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as double, the form in which results are exchanged."""
    return frame.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in frame.schema
        ]
    )


def rounded(frame: DataFrame, *columns: str, scale: int = 6) -> DataFrame:
    return frame.withColumns({c: F.round(F.col(c).cast("double"), scale) for c in columns})


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{name}.parquet", folder)


# -- sources, sinks, schema operators -----------------------------------------


def scan_feed(spark: SparkSession, folder: str) -> DataFrame:
    feed = lake(spark, folder).feeds["src_google_ads_raw"]
    return plain(feed.select("gads_date", "gads_campaign_id", "gads_product_id", "gads_clicks", "gads_spend"))


def json_records(spark: SparkSession, folder: str) -> DataFrame:
    return parse_records(source(spark, folder, "events"), "props", "k bigint", keep=["event_id"])


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of the landed input files; their content stays unread."""
    files = landed_files(spark, folder, "*.parquet")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog-like text records of the events; error events carry a price no number fits."""
    events = parse_records(
        source(spark, folder, "events"), "props", "k string", keep=["event_id", "event_type", "user_id"]
    )
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("title"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("k")).alias("price"),
        F.col("user_id").cast("string").alias("stock"),
    )


def typed_catalog(spark: SparkSession, folder: str) -> DataFrame:
    typed, _ = coerce(select_or_null(_records(spark, folder), CATALOG_TYPES), CATALOG_TYPES)
    return plain(typed)


def typed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejects = coerce(_records(spark, folder), {"id": "bigint", "price": "decimal(19,4)", "stock": "bigint"})
    return rejects.select("id", "price", F.array_join("bad_columns", ",").alias("bad_columns"))


def select_fields(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"event_id": "bigint", "event_type": "string", "session_id": "string", "score": "double"}
    return select_or_null(source(spark, folder, "events"), wanted)


def stamped(spark: SparkSession, folder: str) -> DataFrame:
    return batch_stamp(source(spark, folder, "orders").select("o_orderkey", "o_custkey"), "2024-09-01 12:30:05")


def append_aligned(spark: SparkSession, folder: str) -> DataFrame:
    return fact_columns(with_movement(spark, lake(spark, folder).gold["fact"]))


def zorder_layout(spark: SparkSession, folder: str) -> DataFrame:
    """The fact laid out for skipping by date and campaign: ranges, sorted within."""
    fact = lake(spark, folder).gold["fact"]
    files = layout.file_count(fact.count(), spark.sparkContext.defaultParallelism)
    return fact_columns(layout.clustered(fact, ["date_key", "campaign_key"], files))


def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table written, appended to with other columns, reread, and overwritten with another schema."""
    store, name = _job(spark).store, "conformed/orders"
    store.write(source(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), name)
    store.append(source(spark, folder, "lineitem").select(F.col("l_orderkey").cast("string").alias("o_orderkey"), "l_partkey"), name)
    counts = store.read(name).groupBy("o_orderpriority").agg(F.count("o_orderkey").alias("rows"), F.count("o_totalprice").alias("priced"))
    store.write(materialize(counts, "priorities"), name)
    return store.read(name)


def in_documents(records: DataFrame, key: str, record: F.Column, size: int = 1000) -> DataFrame:
    """value: JSON documents of at most ``size`` records of one key, whatever the number of its rows; blocks follow the order of the scan."""
    blocks = records.select(key, record.alias("_record"), F.expr(f"monotonically_increasing_id() div {size}").alias("_block"))
    return blocks.groupBy(key, "_block").agg(F.to_json(F.struct(F.collect_list("_record").alias("products"))).alias("value")).select("value")


def catalog_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a list of records each, exploded, typed, stamped, loaded and reread. The turns of a conversation are its records."""
    record = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("id"), F.col("role").alias("title"), F.col("text").alias("description"),
        F.when(F.col("turn") == 3, "n/a").otherwise(F.length("text").cast("string")).alias("price"), F.col("turn").cast("string").alias("stock"),
    )
    documents = in_documents(source(spark, folder, "conversations"), "conv_id", record)
    path = f"{shared_folder(spark)}/documents-{uuid.uuid4().hex}"
    documents.write.text(path)
    records = explode_records(spark, path, "products", "id string, title string, description string, price string, stock string", multi_line=False)
    store = _job(spark).store
    store.write(records_to_catalog(records, "2024-09-01 12:30:05"), CATALOG_TABLE)
    return plain(store.read(CATALOG_TABLE))


def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    loaded = lake(spark, folder).feeds
    return quality.load_summary({n: (f, FEEDS[n].prefix) for n, f in loaded.items()})


# -- bronze to silver -----------------------------------------------------------


def conformed(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(conform(lake(spark, folder).feeds[name], FEEDS[name], FEED_MONEY))

    return run


def union_feeds(spark: SparkSession, folder: str) -> DataFrame:
    return plain(PLAN.unioned(lake(spark, folder).feeds))


def dedupe_grain(spark: SparkSession, folder: str) -> DataFrame:
    return plain(PLAN.deduped(lake(spark, folder).feeds))


def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.valid_rows(PLAN.unioned(lake(spark, folder).feeds)))


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = PLAN.rejected(lake(spark, folder).feeds)
    return plain(rows.withColumn("reasons", F.array_join("reasons", "; ")))


def rejected_table(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected rows as the load wrote them, next to silver."""
    at = lake(spark, folder)
    _ = at.silver
    return plain(at.job.store.read(REJECTS).withColumn("reasons", F.array_join("reasons", "; ")))


def money_round(spark: SparkSession, folder: str) -> DataFrame:
    rows = PLAN.unioned(lake(spark, folder).feeds)
    return plain(round_money(rows, MONEY).select(*GRAIN, "impressions", *MONEY))


def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    return plain(PLAN.silver(lake(spark, folder).feeds))


def silver_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(star.silver_summary(lake(spark, folder).silver))


def audit_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.source_counts(lake(spark, folder).silver).drop("validated_utc")


# -- silver to gold -------------------------------------------------------------


def fact_columns(fact: DataFrame) -> DataFrame:
    return rounded(plain(fact), *RATIOS, scale=RATIO_SCALE)


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return star.calendar(lake(spark, folder).silver, "event_date")


def dim_channel(spark: SparkSession, folder: str) -> DataFrame:
    return keys.dimension(lake(spark, folder).silver, star.CHANNEL_KEY, "channel_key")


def dim_campaign(spark: SparkSession, folder: str) -> DataFrame:
    return keys.dimension(lake(spark, folder).silver, star.CAMPAIGN_KEY, "campaign_key")


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return plain(star.product_dimension(lake(spark, folder).silver))


def surrogate_key_large(spark: SparkSession, folder: str) -> DataFrame:
    members = materialize(source(spark, folder, "orders").select("o_custkey", "o_orderkey").distinct(), "order_members")
    return keys.dense_key(members, ["o_custkey", "o_orderkey"], "order_key", small_rows=0)


def fact_build(spark: SparkSession, folder: str) -> DataFrame:
    at = lake(spark, folder)
    return fact_columns(star.performance_fact(at.silver, at.gold["channel"], at.gold["campaign"]))


def fact_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per campaign where parts of the natural key are missing: joins that match nulls keep all rows, plain ones drop some."""
    name, objective = (F.when(F.col(by) % n != 0, F.col(c)).alias(c) for c, by, n in (("campaign_name", "sessions", 11), ("campaign_objective", "clicks", 7)))
    rows = materialize(lake(spark, folder).silver.select("campaign_id", name, objective), "null_keys")
    campaigns = keys.dimension(rows, star.CAMPAIGN_KEY, "campaign_key")
    used = rows.groupBy(*star.CAMPAIGN_KEY).agg(F.count("*").alias("rows"))
    joined = [keys.attach_keys(used, campaigns, star.CAMPAIGN_KEY, "campaign_key", safe).withColumn("null_safe", F.lit(safe)) for safe in (False, True)]
    return joined[0].unionByName(joined[1]).select("null_safe", "campaign_key", *star.CAMPAIGN_KEY, "rows")


def fact_ratios(spark: SparkSession, folder: str) -> DataFrame:
    silver = lake(spark, folder).silver
    ratios = silver.select(
        *GRAIN,
        positive_ratio(F.col("clicks"), F.col("impressions")).alias("click_through_rate"),
        positive_ratio(F.col("spend"), F.col("clicks")).alias("cost_per_click"),
        positive_ratio(F.col("revenue"), F.col("spend")).alias("return_on_ad_spend"),
    )
    return rounded(ratios, *RATIOS, scale=RATIO_SCALE)


def campaign_daily(spark: SparkSession, folder: str) -> DataFrame:
    gold = lake(spark, folder).gold
    return rounded(plain(star.campaign_daily(gold["fact"], gold["channel"], gold["campaign"])), "roas", scale=RATIO_SCALE)


def campaign_daily_sorted(spark: SparkSession, folder: str) -> DataFrame:
    daily = lake(spark, folder).gold["daily"]
    ordered = daily.orderBy(F.desc("date_key"), "campaign_name", "source_system", "campaign_objective")
    return plain(ordered.select("date_key", "campaign_name", "source_system", "campaign_objective", "spend", "revenue"))


def fact_latest_100(spark: SparkSession, folder: str) -> DataFrame:
    ties = ["channel_key", "campaign_key", "product_key", "region"]
    return fact_columns(pick.latest_rows(lake(spark, folder).gold["fact"], "date_key", 100, ties))


# -- checks ---------------------------------------------------------------------


def with_movement(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """The fact with a what-if row on a day that no calendar has."""
    row = spark.createDataFrame([tuple(MOVEMENT.values())], list(MOVEMENT))
    return fact.unionByName(align_to_schema(row, fact.schema))


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    gold = lake(spark, folder).gold
    dims = {name: (gold[name], f"{name}_key") for name in ("date", "channel", "campaign", "product")}
    return quality.orphan_counts(with_movement(spark, gold["fact"]), dims)


def dq_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(PLAN.unioned(lake(spark, folder).feeds), GRAIN)


def dq_distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_counts(lake(spark, folder).silver, ["brand", "category", "source_system", "product_id"])


def distinct_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products advertised per month, per year and in all, from bitmaps of each source's load, stored and merged."""
    silver, store = lake(spark, folder).silver, _job(spark).store
    rows = silver.select("source_system", F.year("event_date").alias("year"), F.month("event_date").alias("month"), "product_id")
    for i, system in enumerate(("Google Ads", "Meta Ads", "LinkedIn Ads")):  # a load each
        bitmaps = presence.key_bitmaps(rows.filter(F.col("source_system") == system), ["year", "month"], "product_id")
        (store.append if i else store.write)(bitmaps, "audit/product_bitmaps")
    stored = store.read("audit/product_bitmaps")
    counts = [presence.distinct_keys(stored, by, "products") for by in (["year", "month"], ["year"], [])]
    none = F.lit(None).cast("int")
    years, everything = counts[1].withColumn("month", none), counts[2].withColumns({"year": none, "month": none})
    return counts[0].unionByName(years).unionByName(everything)


def dq_complete_attrs(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["product_name", "brand", "category", "device_category", "video_views"]
    return quality.incomplete_counts(lake(spark, folder).silver, columns)


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of the load. Row, null and status counts were taken by the writes; what is stored is compared with them."""
    at = lake(spark, folder)
    silver, gold = at.silver, at.gold
    written, facts = at.job.silver_metrics(), at.job.store.metrics(GOLD["fact"])
    known = [
        ("silver rows without attributes", 0, written["without_attributes"]),
        ("silver rows not valid", 0, written["valid_with_reasons"]),
        ("fact rows", written["valid"] - written["without_keys"], facts["rows"]),
    ]
    checks = [
        quality.Check("silver rows", silver, "count(*)", written["valid"]),
        quality.Check("silver sources", silver, "count(DISTINCT source_system)", 3),
        quality.Check("silver categories", silver, "count(DISTINCT category)", 6),
        quality.Check("campaign rows per key", gold["campaign"], "count(*) - count(DISTINCT campaign_key)", 0),
        quality.Check("product rows per key", gold["product"], "count(*) - count(DISTINCT product_key)", 0),
        quality.Check("channel rows", gold["channel"], "count(*)", 3),
        quality.Check("channel rows per key", gold["channel"], "count(*) - count(DISTINCT channel_key)", 0),
        quality.Check("date rows per key", gold["date"], "count(*) - count(DISTINCT date_key)", 0),
        quality.Check("daily sources", gold["daily"], "count(DISTINCT source_system)", 3),
    ]
    return quality.dq(checks, known)


def feed_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Per feed: rows, rows with every attribute filled, and breaches of the naming contract."""
    rows = []
    for name, feed in lake(spark, folder).feeds.items():
        breaches = quality.check_layout(feed, FEEDS[name].prefix, MAX_FEED_WIDTH)
        complete = quality.complete_rows(feed)
        rows.append(
            complete.agg(
                F.lit(name).alias("feed"),
                F.count("*").alias("complete_rows"),
                F.lit(len(complete.columns)).alias("attribute_columns"),
                F.lit(len(breaches)).alias("breaches"),
            )
        )
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# -- governed model ---------------------------------------------------------------


def report(build: Callable[[Model], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(lake(spark, folder).model))


def measure_query(m: Model) -> DataFrame:
    return m.query([reports.YEAR, reports.PLATFORM, reports.REGION], list(m.measures))


def sliced_query(m: Model) -> DataFrame:
    filters = [
        Members(reports.PLATFORM, ["Google Ads", "Meta Ads"]),
        Between(reports.DAY, "1996-01-01", "1997-12-31"),
        Members(reports.BRAND, ["Brand#1", "Brand#2", "Brand#3"]),
        Members(reports.REGION, ["ASIA", "EUROPE"]),
    ]
    return m.query([reports.CAMPAIGN, reports.BRAND], ["Total Spend", "Total Clicks", "Click-Through Rate"], filters)


def having_query(m: Model) -> DataFrame:
    return m.query(
        [reports.PLATFORM, reports.CAMPAIGN, reports.OBJECTIVE],
        ["Total Impressions", "Total Leads", "Cost per Lead"],
        filters=[Members(reports.PLATFORM, ["Google Ads", "LinkedIn Ads"])],
        having=[Having("Total Leads", ">", 100), Having("Return on Ad Spend", ">=", 21)],
        order_by=[("Return on Ad Spend", "desc")],
    )


def slicer_members(m: Model) -> DataFrame:
    return m.members(reports.MONTH)


def moved(m: Model) -> Model:
    return replace(m, fact=with_movement(m.fact.sparkSession, m.fact))


def blank_member(m: Model) -> DataFrame:
    """By year; the movement's day is in no calendar, so it reports under the blank year."""
    return moved(m).query([reports.YEAR], ["Total Spend", "Total Clicks", "Return on Ad Spend"])


def blank_selected(m: Model) -> DataFrame:
    """The blank member chosen in a slicer, with the facts of 1995."""
    return moved(m).query([reports.PLATFORM], ["Total Spend"], filters=[Members(reports.YEAR, [1995, None])])


def calendar_rollup(m: Model) -> DataFrame:
    return m.drill("Date.Calendar", ["Total Spend", "Total Clicks", "Click-Through Rate"])


def decomposition_drill(m: Model) -> DataFrame:
    return m.decompose("Total Spend", reports.TREE_PATH, {reports.CAMPAIGN: "LOW", reports.PLATFORM: "Google Ads"})


def formatted_scorecard(m: Model) -> DataFrame:
    return m.formatted(reports.campaign_scorecard(m))


# -- graph --------------------------------------------------------------------------


def entity(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = plain(lake(spark, folder).ontology.entity(name))
        ratios = [c for c in rows.columns if c.endswith("_Rate") or c.startswith("Cost") or c.startswith("Return")]
        return rounded(rows, *ratios, scale=RATIO_SCALE)

    return run


def edges(target: str) -> Query:
    return lambda spark, folder: lake(spark, folder).ontology.resolved_edges(f"Marketing_Performance_has_{target}")


def edges_dangling(spark: SparkSession, folder: str) -> DataFrame:
    ontology = lake(spark, folder).ontology
    return replace(ontology, tables={**ontology.tables, "fact": with_movement(spark, ontology.tables["fact"])}).dangling()


def traverse_brand_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    return lake(spark, folder).ontology.traverse_members(
        "Marketing_Performance_has_Product", "Marketing_Performance_has_Campaign", "Brand", "Campaign"
    )


def related_performance(spark: SparkSession, folder: str) -> DataFrame:
    """One hop back from a campaign's variants to their performance rows."""
    ontology = lake(spark, folder).ontology
    chosen = ontology.tables["campaign"].filter(F.col("campaign_name") == "HIGH")
    return ontology.related("Marketing_Performance_has_Campaign", chosen)


def traverse_path(spark: SparkSession, folder: str) -> DataFrame:
    """Brands that campaigns join: brand, performance, campaign, performance, brand; from brands of one size alone."""
    product, campaign = "Marketing_Performance_has_Product", "Marketing_Performance_has_Campaign"
    path = [product, campaign, campaign, product]
    return lake(spark, folder).ontology.label_pairs(path, "Brand", "Brand", only=F.col("brand").endswith("1"))


def walk_path(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which a product was advertised that also was in the first week of 1996."""
    ontology = lake(spark, folder).ontology
    date, product = "Marketing_Performance_has_Date", "Marketing_Performance_has_Product"
    return ontology.walk("Date", ontology.tables["date"].filter("date_key between 19960101 and 19960107"), [date, product, product, date])


def reachable_members(spark: SparkSession, folder: str) -> DataFrame:
    """Days and products that lead from one product to, over days and products alone, and how many performance rows lie that far."""
    ontology = lake(spark, folder).ontology
    over = ["Marketing_Performance_has_Date", "Marketing_Performance_has_Product"]
    found = ontology.reachable("Product", ontology.tables["product"].filter("product_key = 1"), over, max_hops=5)
    dims = found.filter("entity <> 'Marketing_Performance'").withColumn("members", F.lit(1).cast("bigint"))
    facts = found.filter("entity = 'Marketing_Performance'").groupBy("entity", "hops").agg(F.count("*").alias("members"))
    return dims.unionByName(facts.withColumn("entity_key", F.lit("all")))


def pick_member(spark: SparkSession, folder: str) -> DataFrame:
    return pick.pick_member(lake(spark, folder).gold["product"], "product_key", TRAINING_SEED)


# -- features, training, scoring ------------------------------------------------------


def gapped(silver: DataFrame) -> DataFrame:
    """Silver's numbers as double, with clicks missing and sessions no number on a known part of the rows."""
    numbers = {c: F.col(c).cast("double") for c in NUMERIC}
    numbers["clicks"] = F.when(F.col("impressions") != 300, numbers["clicks"])
    numbers["sessions"] = F.when(F.col("impressions") == 500, float("nan")).otherwise(numbers["sessions"])
    return silver.select(*GRAIN, *[value.alias(c) for c, value in numbers.items()])


def bounded_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = pick.bounded_sample(lake(spark, folder).silver, GRAIN, SAMPLE_ROWS)
    return plain(rows.select(*GRAIN, "spend"))


def drop_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    return plain(features.drop_null_columns(conform(lake(spark, folder).feeds["src_meta_ads_raw"], META, FEED_MONEY)))


def feature_frame(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_frame(lake(spark, folder).silver, categorical=["region"])


def skew_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.skew_profile(gapped(lake(spark, folder).silver), NUMERIC), "mean", "skewness")


def impute_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = features.impute_plan(gapped(lake(spark, folder).silver), NUMERIC)
    return plan.select("column_name", "value_count", "strategy")


def impute_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.impute_stats(gapped(lake(spark, folder).silver), NUMERIC), "mean", "median", "mode")


def impute_apply(spark: SparkSession, folder: str) -> DataFrame:
    """Filled by statistics of the rows before 1998, applied to all rows."""
    rows = gapped(lake(spark, folder).silver)
    early = rows.filter(F.col("event_date") < F.lit("1998-01-01").cast("date")).select(*NUMERIC)
    return rounded(features.apply_impute(rows, features.fit_impute(early)), *NUMERIC)


def ffill(spark: SparkSession, folder: str) -> DataFrame:
    events = source(spark, folder, "events")
    gaps = events.select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return fill.ffill(gaps, ["value"], ["user_id"], ["ts", "event_id"])


def fill_datetimes(spark: SparkSession, folder: str) -> DataFrame:
    """Event days, missing on error events: the user's last known day, else the most frequent day."""
    events = source(spark, folder, "events")
    gaps = events.select(
        "user_id", "event_id", F.when(F.col("event_type") != "error", F.col("ts").cast("date")).alias("day")
    )
    return features.fill_datetimes(gaps, features.fit_impute(gaps.select("day")), ["user_id"], ["event_id"])


def fitted_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Event days, missing on error events, of both splits: filled by what the train split knows, and the filled split itself.

    What has no known day before it takes the most frequent day of the filled train split.
    """
    events = source(spark, folder, "events")
    gaps = events.select("user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("ts").cast("date")).alias("day"))
    train, test = features.hash_split(gaps, ["event_id"], 0.8, TRAINING_SEED)
    state = features.fit_dates(train, ["user_id"], ["ts", "event_id"])
    known = materialize(state.apply(train), "filled_dates")
    fills = features.fit_impute(known.select("day"))
    splits = [f.withColumn("split", F.lit(name)) for name, f in (("train", known), ("test", state.apply(test)))]
    return features.apply_impute(splits[0].unionByName(splits[1]), fills).drop("ts")


def natural_key_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Days of signals that the calendar lacks, with their rows: the signals of rejected rows alone."""
    at = lake(spark, folder)
    return keys.unkeyed_rows(PLAN.unioned(at.feeds), at.gold["date"].withColumnRenamed("date", "event_date"), ["event_date"])


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = features.hash_split(lake(spark, folder).silver, GRAIN, 0.8, TRAINING_SEED)
    counted = [f.agg(F.lit(n).alias("split"), F.count("*").alias("rows")) for n, f in (("train", train), ("test", test))]
    return counted[0].unionByName(counted[1])


_TRAINED: dict[Lake, training.Trained] = {}
_SPLIT: dict[Lake, tuple[DataFrame, DataFrame]] = {}
CATEGORICAL = ["source_system", "region"]


def split_rows(at: Lake) -> tuple[DataFrame, DataFrame]:
    """Train and test features: silver split by its grain, written once, in a folder each."""
    if at not in _SPLIT:
        marked = at.silver.withColumn("_train", features.hash_below(GRAIN, 0.8, TRAINING_SEED))
        wanted = features.feature_columns(at.silver, CATEGORICAL)
        with setting(at.spark, OPEN_FILES_SETTING, OPEN_FILES):
            rows = materialize(marked.select(*wanted, "_train"), "split", ["_train"])
        _SPLIT[at] = tuple(features.drop_null_columns(rows.filter(part).drop("_train")) for part in ("_train", "NOT _train"))
    return _SPLIT[at]


def trained(at: Lake) -> training.Trained:
    """Fitted on the whole train split."""
    if at not in _TRAINED:
        _TRAINED[at] = training.train(split_rows(at)[0], "spend", categorical=CATEGORICAL)
    return _TRAINED[at]


def scored(at: Lake, rows: DataFrame) -> DataFrame:
    fitted = trained(at)
    return training.score(rows, fitted.model, fitted.signature, keep=["spend"])


def train_eval(spark: SparkSession, folder: str) -> DataFrame:
    return trained(lake(spark, folder)).metrics


def batch_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of silver scored, as a deployed model would."""
    at = lake(spark, folder)
    return scored(at, features.feature_frame(at.silver, categorical=CATEGORICAL))


def score_error(spark: SparkSession, folder: str) -> DataFrame:
    """Error of the model's predictions over the test rows, which it has not seen."""
    at = lake(spark, folder)
    return training.evaluate(scored(at, split_rows(at)[1]), "spend")


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of either split that get a prediction."""
    at = lake(spark, folder)
    parts = [
        scored(at, rows).agg(F.lit(name).alias("split"), F.count("*").alias("rows"), F.count(PREDICTION).alias("predicted"))
        for name, rows in zip(("train", "test"), split_rows(at), strict=True)
    ]
    return parts[0].unionByName(parts[1])


def least_squares(spark: SparkSession, folder: str) -> DataFrame:
    """Spend as a line over clicks, fitted on the train rows; its error on the test rows."""
    train, test = split_rows(lake(spark, folder))
    line, error = training.fit_line(train, test, "clicks", "spend")
    return rounded(error.select("rows", F.lit(line[0]).alias("slope"), F.lit(line[1]).alias("intercept"), "rmse"), "slope", "intercept", "rmse", scale=4)


def ridge_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Error of every fold under lines and planes fitted to the other folds, at several strengths, from one pass of sums each."""
    silver = lake(spark, folder).silver
    rows = silver.select("clicks", "impressions", F.col("spend").cast("double").alias("spend"), features.hash_share(GRAIN, TRAINING_SEED, 3).cast("int").alias("fold"))
    out = []
    for inputs, strengths in ((["clicks"], [0.0, 10.0, 1000.0]), (["clicks", "impressions"], [0.0])):
        design = ridge.Design(inputs, {})
        moments = ridge.fold_moments(rows, design, "spend", "fold")
        out += [(" ".join(inputs), s, fold, n, error) for s, fold, n, error in ridge.fold_errors(moments, design, strengths)]
    found = spark.createDataFrame(out, "inputs string, strength double, fold int, rows bigint, rmse double")
    return rounded(found, "rmse", scale=4)


# -- the load job ---------------------------------------------------------------------


def _job(spark: SparkSession) -> Medallion:
    """The load over a place of its own."""
    return Medallion(TableStore(spark, f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"), PLAN)


def load_job(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze to gold in one run: rows of each table it wrote, and the audit's rows per source."""
    job = _job(spark)
    job.run(lake(spark, folder).feeds)
    written = {name: job.store.metrics(path)["rows"] for name, path in {**{n: n for n in FEEDS}, **GOLD}.items()}
    judged = job.silver_metrics()
    written |= {"silver": judged["valid"], "rejected": judged["rejected"]}
    counts = spark.createDataFrame(list(written.items()), "table_name string, rows bigint")
    audit = job.store.read(AUDIT).select(F.concat(F.lit("audit "), "source_system").alias("table_name"), F.col("count").alias("rows"))
    return counts.unionByName(audit)


def movement_insert(spark: SparkSession, folder: str) -> DataFrame:
    """A what-if row whose members are picked by seed, appended to the fact; revenue is spend times return. By year."""
    job = _job(spark)
    at = lake(spark, folder)
    for name, path in GOLD.items():
        job.store.write(at.gold[name], path)
    insert_movement(job, date_key=20991231, spend=2011.0, roas=2.0, batch_id="manual", impressions=1000, clicks=50, conversions=1, seed=TRAINING_SEED)
    return plain(job.refresh().query([reports.YEAR], ["Total Spend", "Total Revenue", "Total Impressions", "Total Conversions"]))


QUERIES: dict[str, Query] = {
    "scan_feed": scan_feed,
    "json_records": json_records,
    "landed_files": landed,
    "typed_catalog": typed_catalog,
    "typed_rejects": typed_rejects,
    "select_or_null": select_fields,
    "batch_stamp": stamped,
    "append_aligned": append_aligned,
    "zorder_layout": zorder_layout,
    "table_roundtrip": table_roundtrip,
    "catalog_ingest": catalog_ingest,
    "load_summary": load_summary,
    "conform_google": conformed("src_google_ads_raw"),
    "conform_meta": conformed("src_meta_ads_raw"),
    "conform_linkedin": conformed("src_linkedin_ads_raw"),
    "union_feeds": union_feeds,
    "dedupe_grain": dedupe_grain,
    "valid_rows": valid_rows,
    "rejected_rows": rejected_rows,
    "rejected_table": rejected_table,
    "money_round": money_round,
    "silver_table": silver_table,
    "silver_summary": silver_summary,
    "audit_source_counts": audit_source_counts,
    "dim_date": dim_date,
    "dim_channel": dim_channel,
    "dim_campaign": dim_campaign,
    "dim_product": dim_product,
    "surrogate_key_large": surrogate_key_large,
    "fact_build": fact_build,
    "fact_null_keys": fact_null_keys,
    "fact_ratios": fact_ratios,
    "campaign_daily": campaign_daily,
    "campaign_daily_sorted": campaign_daily_sorted,
    "fact_latest_100": fact_latest_100,
    "fk_orphans": fk_orphans,
    "natural_key_gaps": natural_key_gaps,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_distinct_counts": dq_distinct_counts,
    "distinct_products": distinct_products,
    "dq_complete_attrs": dq_complete_attrs,
    "dq_report": dq_report,
    "feed_contract": feed_contract,
    "measure_query": report(measure_query),
    "sliced_query": report(sliced_query),
    "having_query": report(having_query),
    "slicer_members": report(slicer_members),
    "blank_member": report(blank_member),
    "blank_selected": report(blank_selected),
    "calendar_rollup": report(calendar_rollup),
    **{name: report(build) for name, build in reports.REPORTS.items()},
    "brand_roas_share": report(lambda m: rounded(reports.brand_roas_share(m), "share", scale=9)),
    "decomposition_drill": report(decomposition_drill),
    "formatted_scorecard": report(formatted_scorecard),
    "entity_product": entity("Product"),
    "entity_date": entity("Date"),
    "entity_channel": entity("Channel"),
    "entity_campaign": entity("Campaign"),
    "entity_performance": entity("Marketing_Performance"),
    "edges_date": edges("Date"),
    "edges_channel": edges("Channel"),
    "edges_campaign": edges("Campaign"),
    "edges_product": edges("Product"),
    "edges_dangling": edges_dangling,
    "related_performance": related_performance,
    "traverse_brand_campaigns": traverse_brand_campaigns,
    "traverse_path": traverse_path,
    "walk_path": walk_path,
    "reachable_members": reachable_members,
    "pick_member": pick_member,
    "bounded_sample": bounded_sample,
    "drop_null_columns": drop_null_columns,
    "feature_frame": feature_frame,
    "skew_profile": skew_profile,
    "impute_plan": impute_plan,
    "impute_stats": impute_stats,
    "impute_apply": impute_apply,
    "ffill": ffill,
    "fill_datetimes": fill_datetimes,
    "fitted_dates": fitted_dates,
    "train_test_split": train_test_split,
    "scored_rows": scored_rows,
    "least_squares": least_squares,
    "ridge_folds": ridge_folds,
    "load_job": load_job,
    "movement_insert": movement_insert,
    "train_eval": train_eval,
    "batch_score": batch_score,
    "score_error": score_error,
}
