from datetime import date

from conftest import plan_of, rows
from pyspark.sql import functions as F

from adlake.fixed import CANONICAL_COLUMNS, GRAIN
from adlake.operators.conform import FEEDS, GOOGLE, LINKEDIN, META, SourceMap, conform, dedupe, round_money, union_feeds
from adlake.operators.quality import Rule, rejected_rows, split_valid, valid_rows


def test_every_feed_gets_the_canonical_columns(literal_feeds):
    for name, source in FEEDS.items():
        frame = conform(literal_feeds[name], source)
        assert {f.name: f.dataType.simpleString() for f in frame.schema} == CANONICAL_COLUMNS
        assert frame.count() == 720


def test_what_a_platform_does_not_report(literal_feeds):
    google = conform(literal_feeds["src_google_ads_raw"], GOOGLE)
    meta = conform(literal_feeds["src_meta_ads_raw"], META)
    linkedin = conform(literal_feeds["src_linkedin_ads_raw"], LINKEDIN)
    assert google.filter("leads <> conversions OR sessions <> clicks OR video_views IS NOT NULL").count() == 0
    assert meta.filter("device_category IS NOT NULL OR conversions <> leads").count() == 0
    assert meta.select("campaign_objective").distinct().first()[0] == "Social Engagement"
    assert linkedin.filter("device_category IS NOT NULL OR engagements IS NOT NULL").count() == 0
    assert linkedin.filter("conversions <> leads").count() > 0


def test_a_new_feed_needs_only_a_map(spark):
    source = SourceMap("Radio", "Audio", "r_", {"event_date": "r_day", "spend": "r_cost"}, {"region": "Europe"})
    frame = spark.createDataFrame([(date(2024, 1, 1), 2)], "r_day date, r_cost int")
    row = conform(frame, source).first()
    assert (row.source_system, row.channel, row.region, row.spend, row.clicks) == ("Radio", "Audio", "Europe", 2.0, None)


def test_union_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(union_feeds([a, b])) == [(1, "x"), (2, "y")]


def test_dedupe_keeps_the_first_in_order_whatever_the_layout(spark):
    data = [(1, None, 5), (1, 2, 4), (1, None, 3), (2, 1, 1), (None, 1, 1), (None, 0, 9)]
    frame = spark.createDataFrame(data, "k int, a int, b int")
    expected = [(1, None, 3), (2, 1, 1), (None, 0, 9)]
    for parts in (1, 3, 6):
        for order in ("a", "b"):
            assert rows(dedupe(frame.orderBy(order).repartition(parts), ["k"])) == sorted(expected, key=repr)
    assert (1, 2, 4) not in rows(dedupe(frame, ["k"], ["b"]))


def test_dedupe_limits_groups_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "WindowGroupLimit" in plan_of(dedupe(frame, ["k"])) and "Partial" in plan_of(dedupe(frame, ["k"]))


def test_only_rows_whose_key_may_repeat_are_shuffled_whole(spark, tmp_path):
    from adlake.operators.conform import dedupe_stored
    from adlake.session import materialize

    n = F.col("id")
    frame = spark.range(4000).select(
        F.when(n % 50 == 0, n % 100).otherwise(n).alias("k"), F.when(n % 3 > 0, F.concat(F.lit("p"), n % 7)).alias("p"), (n * 31 % 1009).alias("a"), n.alias("b")
    )
    frame = materialize(frame.unionAll(spark.sql("SELECT null, null, 5L, id FROM range(9)")).repartition(5), "test_repeats")
    for keys, order in ((["k", "p"], ["a"]), (["k"], None), (["b"], None), (["p"], ["a"])):
        expected = rows(dedupe(frame, keys, order))
        assert rows(dedupe_stored(frame, keys, order)) == expected == rows(dedupe_stored(frame, keys, order, few_keys=1))
    plan = plan_of(dedupe_stored(frame, ["k"], ["a"])).split("== Physical Plan ==")[1]
    once = plan[: plan.index("Window")]
    assert "LeftAnti" in once and "hashpartitioning" not in once
    assert "Join" not in plan_of(dedupe_stored(frame, ["k"], ["a"], few_keys=0))


def test_valid_and_rejected_split_all_rows(spark):
    data = [
        (date(2024, 1, 1), 1, 1.0, 1.0, 5, 9), (None, 1, 1.0, 1.0, 5, 9), (date(2024, 1, 1), None, -1.0, 1.0, 5, 9),
        (date(2024, 1, 1), 1, None, None, None, 9), (date(2024, 1, 1), 1, 1.0, -1.0, 10, 9),
        (date(2024, 1, 1), 1, 1.0, 1.0, 5, None),
    ]
    frame = spark.createDataFrame(
        data, "event_date date, campaign_id int, spend double, revenue double, clicks int, impressions int"
    )
    valid, rejected = split_valid(frame)
    assert (valid.count(), rejected.count()) == (3, 3)
    reasons = sorted(r.reasons for r in rejected.collect())
    assert reasons == [
        ["missing campaign_id", "negative spend"], ["missing event_date"], ["negative revenue", "clicks above impressions"]
    ]


def test_a_null_condition_rejects(spark):
    frame = spark.createDataFrame([(None,), (1,)], "n int")
    rule = [Rule("small", "n > 0")]
    assert (valid_rows(frame, rule).count(), rejected_rows(frame, rule).count()) == (1, 1)


def test_round_money_type(spark):
    frame = round_money(spark.createDataFrame([(1.005,)], "spend double"), ["spend"])
    assert frame.schema["spend"].dataType.simpleString() == "decimal(18,2)"


def test_grain_is_declared_over_canonical_columns():
    assert set(GRAIN) <= set(CANONICAL_COLUMNS)
