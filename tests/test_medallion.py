from datetime import date

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from adlake.fixed import ATTRIBUTE_SUFFIXES, MAX_FEED_WIDTH, RETIRED_BRONZE, SILVER_SCHEMAS
from adlake.operators import quality
from adlake.operators.conform import FEEDS
from adlake.operators.star import CAMPAIGN_KEY, CHANNEL_KEY
from adlake.plans.medallion import AUDIT, GOLD, SILVER, Medallion, SilverPlan, insert_movement, movement_row
from adlake.sources.tables import TableStore, ensure_schemas, missing_tables, retire_tables


def test_bronze_contract(loaded):
    bronze = loaded.bronze()
    summary = quality.load_summary({n: (f, FEEDS[n].prefix) for n, f in bronze.items()})
    assert sorted((r.row_count, r.column_count) for r in summary.collect()) == [(720, 17)] * 3
    for name, feed in bronze.items():
        assert quality.check_layout(feed, FEEDS[name].prefix, MAX_FEED_WIDTH) == []
        assert quality.complete_rows(feed, ATTRIBUTE_SUFFIXES).count() == 720
    assert quality.check_layout(feed, "x_", 3)[-1] == "17 columns, at most 3"


def test_silver_contract(loaded):
    silver = loaded.store.read(SILVER)
    report = quality.dq(
        [
            quality.Check("rows", silver, "count(*)", 2160),
            quality.Check("sources", silver, "count(DISTINCT source_system)", 3),
            quality.Check("brands", silver, "count(DISTINCT brand)", 6),
            quality.Check("categories", silver, "count(DISTINCT category)", 5),
            quality.Check("incomplete", silver, "count_if(product_name IS NULL OR brand IS NULL OR category IS NULL)", 0),
            quality.Check("not valid", silver, quality.not_valid(), 0),
        ]
    )
    assert report.filter("passed").count() == 6 and report.count() == 6
    assert {r.source_system: r["count"] for r in loaded.store.read(AUDIT).collect()} == {
        "Google Ads": 720, "Meta Ads": 720, "LinkedIn Ads": 720
    }


def test_gold_contract(loaded):
    gold = loaded.gold()
    assert {n: f.count() for n, f in gold.items()} == {
        "date": 180, "channel": 3, "campaign": 8, "product": 30, "fact": 2160, "daily": 2160
    }
    dims = {n: (gold[n], k) for n, k in [("date", "date_key"), ("channel", "channel_key"),
                                         ("campaign", "campaign_key"), ("product", "product_key")]}
    assert quality.orphan_counts(gold["fact"], dims).agg(F.sum("orphan_rows")).first()[0] == 0
    for dim, key in dims.values():
        assert quality.duplicate_keys(dim, [key]).count() == 0
    assert gold["product"].filter("brand IS NULL OR category IS NULL").count() == 0


def test_gold_types(loaded):
    types = {f.name: f.dataType.simpleString() for f in loaded.gold()["fact"].schema}
    assert types["spend"] == "decimal(18,2)" and types["date_key"] == "int" and types["channel_key"] == "int"
    assert types["click_through_rate"] == "double" and types["cost_per_click"].startswith("decimal(38")
    assert len(types) == 20


def test_checks_report_what_is_wrong(spark):
    frame = spark.createDataFrame([(1, None), (1, "a")], "k int, v string")
    found = {r.check_name: r for r in quality.dq([
        quality.Check("unique", frame, "count(*) - count(DISTINCT k)", 0), quality.Check("rows", frame, "count(*)"),
    ]).collect()}
    assert (found["unique"].actual, found["unique"].passed) == (1, False)
    assert (found["rows"].actual, found["rows"].passed) == (2, True)
    assert rows(quality.duplicate_keys(frame, ["k"])) == [(1, 2)]
    assert tuple(quality.incomplete_counts(frame, ["k", "v"]).first()) == (0, 1, 1)
    assert tuple(quality.distinct_counts(frame, ["k", "v"]).first()) == (1, 1)
    lost = quality.orphan_counts(frame, {"d": (spark.createDataFrame([(2,)], "k int"), "k")})
    assert rows(lost) == [("d", 1, 2)]


def test_a_duplicate_can_displace_unless_filtered_first(spark, literal_feeds, tmp_path):
    name = "src_google_ads_raw"
    feed = literal_feeds[name].limit(1)
    invalid = feed.withColumn("gads_clicks", F.lit(10**9)).withColumn("gads_device", F.lit("A"))
    feeds = {name: feed.unionByName(invalid)}
    first = SilverPlan({name: FEEDS[name]}, {}, tie_order=["device_category"])
    assert first.silver(feeds).count() == 0 and first.rejected(feeds).count() == 1
    kept = SilverPlan({name: FEEDS[name]}, {}, tie_order=["device_category"], filter_first=True)
    assert kept.silver(feeds).count() == 1 and kept.rejected(feeds).count() == 1


def test_small_dimensions_are_broadcast_by_their_size(loaded):
    from adlake.operators.star import performance_fact

    gold = loaded.gold()
    plan = plan_of(performance_fact(loaded.store.read(SILVER), gold["channel"], gold["campaign"]))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_movement_lands_under_the_blank_member(spark, literal_feeds, tmp_path):
    job = Medallion(TableStore(spark, str(tmp_path)))
    job.run(literal_feeds)
    values = dict(date_key=20991231, spend=2011.0, roas=2.0, batch_id="manual", impressions=1000, clicks=50,
                  conversions=1, seed=7)
    row = insert_movement(job, **values).first()
    assert (float(row.spend), float(row.revenue), row.region, row.leads) == (2011.0, 4022.0, None, None)
    assert "synthetic_batch_row_id" not in row.asDict()
    model = job.refresh()
    blank = model.query(["Date.Year"], ["Total Spend"]).filter("year IS NULL").first()
    assert float(blank.total_spend) == 2011.0
    assert movement_row(job.gold(), **values).first()[:4] == row[:4]
    before = job.gold()["fact"].count()
    job.optimize()
    assert job.gold()["fact"].count() == before == 2161


def test_reload_replaces(spark, literal_feeds, tmp_path):
    job = Medallion(TableStore(spark, str(tmp_path)))
    job.load_bronze(literal_feeds)
    assert job.build_silver(audit=False).count() == 2160
    half = {n: f.filter(F.col(f.columns[0]) < F.lit(date(2024, 3, 1))) for n, f in literal_feeds.items()}
    job.load_bronze(half)
    job.build_silver(audit=False)
    assert job.store.read(SILVER).count() == 720


def test_a_table_is_replaced_with_its_schema(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(KeyError):
        store.read("t")
    store.write(spark.range(3), "t")
    store.write(spark.range(4).withColumn("x", F.lit(1)), "t")
    assert store.read("t").columns == ["id", "x"] and store.read("t").count() == 4
    with pytest.raises(ValueError):
        store.write(spark.range(3), "t", keep_schema=True)
    store.write(spark.range(2).withColumn("x", F.lit(1)), "t", keep_schema=True)
    assert store.read("t").count() == 2 and not TableStore(spark, f"{tmp_path}/other").exists("t")


def test_a_failed_append_shows_no_row(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "t")
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        store.append(broken, "t")
    assert store.read("t").count() == 3
    store.append(spark.range(2), "t")
    assert store.read("t").count() == 5


def test_the_joins_of_the_fact_run_once(spark, literal_feeds, tmp_path, monkeypatch):
    from adlake.plans import medallion

    plans = []
    monkeypatch.setattr(medallion, "clustered", lambda frame, *a: plans.append(plan_of(frame)) or frame)
    Medallion(TableStore(spark, str(tmp_path))).run(literal_feeds)
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)


def test_the_layout_carries_no_ratios(spark, literal_feeds, tmp_path, monkeypatch):
    """They are computed from the laid rows, and equal those of the fact in one piece."""
    from adlake.operators.star import performance_fact
    from adlake.plans import medallion

    laid, own = [], medallion.clustered
    monkeypatch.setattr(medallion, "clustered", lambda frame, *a: laid.append(frame.columns) or own(frame, *a))
    job = Medallion(TableStore(spark, str(tmp_path)))
    job.run(literal_feeds)
    assert not {"click_through_rate", "cost_per_click", "return_on_ad_spend"} & set(laid[0])
    gold = job.gold()
    whole = performance_fact(job.store.read(SILVER), gold["channel"], gold["campaign"])
    assert gold["fact"].schema == whole.schema and rows(gold["fact"]) == rows(whole)


def test_the_load_shuffles_few_rows_whole(spark, literal_feeds, tmp_path):
    job = Medallion(TableStore(spark, str(tmp_path)))
    job.load_bronze(literal_feeds)
    assert "LeftAnti" in plan_of(job.plan.judged(job.bronze()))


def test_append_aligns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.createDataFrame([(1, "a", 1.5)], "n int, s string, d double"), "t")
    store.append(spark.createDataFrame([("7", "gone")], "n string, extra string"), "t")
    assert rows(store.read("t")) == [(1, "a", 1.5), (7, None, None)]


def test_catalog_housekeeping(spark, tmp_path):
    ensure_schemas(spark, [*SILVER_SCHEMAS, *SILVER_SCHEMAS])
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(4), "audit/numbers")
    name = store.table("audit/numbers")
    assert spark.table(name).count() == 4 and missing_tables(spark, [name]) == []
    store.write(spark.range(5), "audit/numbers")
    assert spark.table(name).count() == 5
    retire_tables(spark, [name, *RETIRED_BRONZE])
    assert missing_tables(spark, [name, *RETIRED_BRONZE]) == [name, *RETIRED_BRONZE] and not store.exists("audit/numbers")


def test_campaign_variants(loaded):
    campaigns = loaded.gold()["campaign"]
    assert campaigns.filter("campaign_id = 101").count() == 2
    ordered = campaigns.orderBy(*CAMPAIGN_KEY).select("campaign_key").collect()
    assert [r[0] for r in ordered] == list(range(1, 9))
    assert loaded.gold()["channel"].columns == [*CHANNEL_KEY, "channel_key"]


def broken_rows(spark, n=1000):
    return spark.range(0, n, 1, 8).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def folders(tmp_path, table):
    return sorted(p.name for p in (tmp_path / "bronze").iterdir() if p.name.startswith(f"{table}__"))


def test_a_failed_overwrite_keeps_the_old_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "t")
    store.write(spark.range(7), "t__a")  # a table whose name begins like a version's
    with pytest.raises(Exception):
        store.write(broken_rows(spark).withColumn("x", F.lit(1)), "t")
    assert rows(store.read("t")) == [(0,), (1,), (2,)] and store.read("t").columns == ["id"]
    store.write(store.read("t").selectExpr("id + 10 AS id"), "t")  # from the table itself
    assert rows(store.read("t")) == [(10,), (11,), (12,)] and store.read("t__a").count() == 7
    assert len([f for f in folders(tmp_path, "t") if not f.startswith("t__a")]) == 1


def test_a_restart_clears_a_half_done_write(spark, tmp_path):
    """A job that ended between the new version and the turn of the view: the old rows are read, and the version goes."""
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "t")
    schema = store.table("t").partition(".")[0]
    spark.range(99).write.saveAsTable(f"{schema}.t__0123456789ab")
    (tmp_path / "bronze" / "t__ba9876543210").mkdir()
    again = TableStore(spark, str(tmp_path))
    assert again.read("t").count() == 3 and len(folders(tmp_path, "t")) == 3
    again.write(spark.range(4), "t")
    assert again.read("t").count() == 4 and len(folders(tmp_path, "t")) == 1
    assert missing_tables(spark, [f"{schema}.t__0123456789ab"])


def test_counts_come_with_the_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    frame = spark.range(0, 100, 1, 8).withColumn("v", F.when(F.col("id") % 4 > 0, F.col("id")))
    found = store.write(frame, "t", partition_by=["v"], metrics={"null_v": "count_if(v IS NULL)"}, expected={"null_v": 25, "rows": 100})
    assert found == store.metrics("t") == {"rows": 100, "null_v": 25}
    store.append(spark.range(5), "t")
    assert store.metrics("t") == {"rows": 105} and store.read("t").count() == 105
    assert store.write(spark.range(0), "t") == {"rows": 0} == store.metrics("t")
    with pytest.raises(KeyError):
        store.metrics("other")


def test_a_partitioned_write_needs_no_sort(spark, tmp_path, monkeypatch):
    """Files of several partitions are open at once, for that write alone; more partitions than that are written too."""
    from pyspark.sql import DataFrameWriter

    name, store, seen, save = "spark.sql.maxConcurrentOutputFileWriters", TableStore(spark, str(tmp_path)), [], DataFrameWriter.saveAsTable
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, *a, **k: seen.append(int(spark.conf.get(name))) or save(self, *a, **k))
    frame = spark.range(0, 900, 1, 3).select("id", (F.col("id") % 60).alias("part"))
    store.write(frame, "t", partition_by=["part"])
    store.write(frame, "u")
    assert seen == [16, 0] and spark.conf.get(name) == before
    assert rows(store.read("t")) == rows(frame) == rows(store.read("u"))
    with pytest.raises(Exception):
        store.write(frame.withColumn("bad", F.raise_error(F.lit("bad")).cast("int")), "t", partition_by=["part"])
    assert spark.conf.get(name) == before and store.read("t").count() == 900


def test_a_failed_check_names_its_table(spark, tmp_path):
    from adlake.sources.tables import CheckFailed

    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "dims/t", unique=["id"])
    with pytest.raises(CheckFailed, match="dims/t: odd is 2, not 0"):
        store.write(spark.range(5), "dims/t", metrics={"odd": "count_if(id % 2 = 1)"}, expected={"odd": 0})
    with pytest.raises(CheckFailed, match="dims/t: 1 values of id"):
        store.write(spark.range(5).unionAll(spark.range(1)), "dims/t", unique=["id"])
    assert store.read("dims/t").count() == 3 == store.metrics("dims/t")["rows"]


def test_the_load_refuses_two_products_of_one_key(spark, literal_feeds, tmp_path):
    from adlake.sources.tables import CheckFailed

    job = Medallion(TableStore(spark, str(tmp_path)))
    job.load_bronze(literal_feeds)
    job.build_silver(audit=False)
    silver = job.store.read(SILVER)
    job.store.write(silver.withColumn("brand", F.when(F.col("region") == silver.first().region, "other").otherwise(F.col("brand"))), SILVER)
    with pytest.raises(CheckFailed, match="dim_product"):
        job.build_gold()


def test_checks_read_no_feed(lake):
    from adlake.queries import dq_report

    assert "staging" not in plan_of(dq_report(lake.spark, lake.folder)) and dq_report(lake.spark, lake.folder).filter("not passed").count() == 0


def test_one_write_tells_valid_from_rejected(spark, literal_feeds, tmp_path):
    """Both parts of the one table equal what is computed apart; rows are deduplicated once, and each part reads its own files."""
    from adlake.plans.medallion import REJECTS

    name = "src_google_ads_raw"
    feed = literal_feeds[name]
    bad = feed.limit(40).withColumn("gads_clicks", F.lit(10**9)).withColumn("gads_device", F.lit("A"))
    feeds = {**literal_feeds, name: feed.unionByName(bad)}
    for first in (False, True):
        plan = SilverPlan(dict(FEEDS), {}, tie_order=["device_category"], filter_first=first)
        job = Medallion(TableStore(spark, f"{tmp_path}/{first}"), plan)
        job.load_bronze(feeds)
        silver, rejects = job.build_silver(), job.store.read(REJECTS)
        assert rows(silver) == rows(plan.silver(feeds)) and silver.columns == plan.silver(feeds).columns
        assert rows(rejects) == rows(plan.rejected(feeds)) and rejects.count() == 40
        assert (job.silver_metrics()["valid"], job.silver_metrics()["rejected"]) == (silver.count(), 40)
        assert "quality_status=Rejected" not in plan_of(silver.filter("clicks > 0")) and "PartitionFilters: [isnotnull(quality_status" in plan_of(silver)
        if not first:
            assert plan_of(plan.judged(feeds)).split("== Physical Plan ==")[1].count("row_number") == plan_of(plan.deduped(feeds)).split("== Physical Plan ==")[1].count("row_number")
