from dataclasses import replace
from datetime import date

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from adlake.plans import reports
from adlake.plans import semantic
from adlake.plans.semantic import Between, Dimension, Having, Measure, Members, Model, share_of_total, slug


@pytest.fixture(scope="module")
def model(spark):
    """Four shops in two towns, sales on known and unknown days; one shop never priced."""
    fact = spark.createDataFrame(
        [
            (1, 1, "web", 10, 2), (1, 2, "web", 20, 0), (2, 1, "app", 5, 1), (2, 3, "app", 10, 5),
            (9, 1, "web", 100, 10), (1, 8, "app", 7, 7), (2, 4, "web", None, None),
        ],
        "day int, shop int, via string, sales int, cost int",
    )
    days = spark.createDataFrame(
        [(1, date(2024, 1, 31), "January", 1), (2, date(2024, 2, 1), "February", 2), (3, date(2024, 3, 1), "March", 3)],
        "day int, date date, month string, number int",
    )
    shops = spark.createDataFrame(
        [(1, "North", "a"), (2, "North", "b"), (3, "South", "c"), (4, "Far", "d")], "shop int, town string, name string"
    )
    return Model(
        "Sales", fact, {"Via": "via"},
        {
            "Day": Dimension(
                "Day", days, "day", "day", {"Date": "date", "Month": "month", "Number": "number"},
                {"Month": "Number"}, "Date", {"Calendar": ["Month", "Date"]},
            ),
            "Shop": Dimension("Shop", shops, "shop", "shop", {"Town": "town", "Name": "name"}),
        },
        {
            m.name: m
            for m in [Measure("Sales", "sales"), Measure("Cost", "cost"), Measure("Margin Ratio", ratio=("Sales", "Cost"))]
        },
    )


def test_slug():
    assert slug("Sales.Click-Through Rate") == "click_through_rate" and slug("Total Spend") == "total_spend"


def test_ratio_is_of_sums_and_blank_over_zero(model):
    found = rows(model.query(["Shop.Name"], ["Sales", "Margin Ratio"], [Members("Day.Month", ["January"])]))
    assert found == [("a", 10, 5.0), ("b", 20, None), (None, 7, 1.0)]


def test_blank_member_keeps_unmatched_facts(model):
    assert rows(model.query(["Shop.Town"], ["Sales"])) == sorted([("North", 135), ("South", 10), (None, 7)], key=repr)
    assert rows(model.query(["Day.Month"], ["Sales"])) == sorted(
        [("January", 37), ("February", 15), (None, 100)], key=repr
    )


def test_groups_without_any_measure_are_left_out(model):
    assert "Far" not in [r.town for r in model.query(["Shop.Town"], ["Sales", "Cost"]).collect()]
    assert "March" not in [r.month for r in model.query(["Day.Month"], ["Sales"]).collect()]


def test_a_filtered_dimension_drops_unmatched_facts(model):
    everything = Between("Day.Date", date(2000, 1, 1))
    assert model.query([], ["Sales"], [everything]).first().sales == 52
    assert model.query([], ["Sales"]).first().sales == 152


def test_the_blank_member_can_be_selected(model):
    assert model.query([], ["Sales"], [Members("Day.Month", [None])]).first().sales == 100
    assert model.query([], ["Sales"], [Members("Day.Month", [None, "February"])]).first().sales == 115
    assert rows(model.query(["Shop.Town"], ["Sales"], [Members("Day.Month", [None])])) == [("North", 100)]


def test_filters_combine(model):
    filters = [Members("Sales.Via", ["web"]), Members("Shop.Town", ["North"]), Between("Day.Date", None, date(2024, 1, 31))]
    assert rows(model.query(["Shop.Name"], ["Sales"], filters)) == [("a", 10), ("b", 20)]
    assert model.query(["Shop.Name"], ["Sales"], [Members("Shop.Town", [])]).count() == 0


@pytest.mark.parametrize("key_list, key_table", [(256, 200_000), (0, 200_000), (0, 0), (1, 0)])
def test_every_way_to_filter_agrees(model, monkeypatch, key_list, key_table):
    monkeypatch.setattr(semantic, "KEY_LIST", key_list)
    monkeypatch.setattr(semantic, "KEY_TABLE", key_table)
    filters = [Between("Day.Date", date(2024, 1, 1), date(2024, 2, 28)), Members("Shop.Town", ["North", "South"])]
    assert rows(model.query(["Day.Month", "Shop.Town"], ["Sales", "Cost"], filters)) == [
        ("February", "North", 5, 1), ("February", "South", 10, 5), ("January", "North", 30, 2)
    ]
    assert rows(model.query(["Sales.Via"], ["Sales"], filters)) == [("app", 15), ("web", 30)]


def test_having_and_hidden_order(model):
    result = model.query(["Shop.Name"], ["Sales"], having=[Having("Cost", ">", 0)], order_by=[("Cost", "desc")])
    assert [tuple(r) for r in result.collect()] == [("a", 115), (None, 7), ("c", 10)]


def test_a_label_is_ordered_by_its_sort_column(model):
    result = model.query(["Day.Month"], ["Sales"], order_by=[("Day.Month", "desc")])
    assert [r.month for r in result.collect()] == ["February", "January", None]
    assert [r.month for r in model.members("Day.Month").collect()] == ["January", "February", "March"]


def test_members_accept_filters_on_their_own_dimension_only(model):
    assert rows(model.members("Shop.Name", [Members("Shop.Town", ["North"])])) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        model.members("Shop.Name", [Members("Day.Month", ["January"])])


def test_top_keeps_ties(model, spark):
    fact = spark.createDataFrame([(1, 1, "x", 5, 1), (1, 2, "x", 5, 1), (1, 3, "x", 1, 1)], model.fact.schema)
    assert replace(model, fact=fact).query(["Shop.Name"], ["Sales"], top=(1, "Sales")).count() == 2


def test_drill_holds_every_level(model):
    found = {(r.month, r.date, r.grouping_id): r.sales for r in model.drill("Day.Calendar", ["Sales"]).collect()}
    assert found[(None, None, 3)] == 152
    assert found[("January", None, 1)] == 37 and found[("January", date(2024, 1, 31), 0)] == 37
    assert found[(None, None, 1)] == 100 and found[(None, None, 0)] == 100


def test_decompose_opens_shown_or_selected_members(model):
    path = ["Shop.Town", "Shop.Name"]
    tree = rows(model.decompose("Sales", path, bars=1))
    assert tree == sorted([(1, "North", None, 1, 135, 135 / 152), (2, "North", "a", 1, 115, 115 / 135)], key=repr)
    drill = rows(model.decompose("Sales", path, {"Shop.Town": "South"}, bars=1))
    assert (2, "South", "c", 1, 10, 1.0) in drill and len(drill) == 2
    blank = rows(model.decompose("Sales", path, {"Shop.Town": None}, bars=1))
    assert (2, None, None, 1, 7, 1.0) in blank


def test_share_and_format(model):
    shares = share_of_total(model.query(["Shop.Town"], ["Sales"]), "Sales")
    assert abs(sum(r.share for r in shares.collect()) - 1) < 1e-12
    text = model.formatted(model.query([], ["Sales"])).first().sales
    assert text == "152"


def test_unknown_names_are_refused(model):
    for call in (lambda: model.query(["Shop.Nothing"], ["Sales"]), lambda: model.query([], ["Nothing"])):
        with pytest.raises(KeyError):
            call()


def test_measures_add_up_over_any_split(lake):
    m = lake.model
    whole = m.query([], ["Total Spend", "Total Clicks"]).first()
    for split in ("Campaign.Campaign", "Channel.Platform", "Product.Brand", "Date.Month Name"):
        parts = m.query([split], ["Total Spend", "Total Clicks"]).agg(F.sum("total_spend"), F.sum("total_clicks")).first()
        assert tuple(parts) == tuple(whole)


def test_pre_aggregation_changes_nothing(lake):
    gold = lake.gold
    joined = gold["fact"].join(gold["channel"], "channel_key").join(gold["product"], "product_key")
    direct = joined.groupBy(F.col("source_system").alias("platform"), "brand").agg(F.sum("spend").alias("total_spend"))
    governed = lake.model.query(["Channel.Platform", "Product.Brand"], ["Total Spend"])
    assert rows(governed) == rows(direct)


def test_a_report_reads_only_what_it_names(lake):
    plan = plan_of(reports.platform_revenue(lake.model))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "ReadSchema: struct<channel_key:int,revenue:decimal(18,2)>" in physical
    assert "dim_product" not in physical and "BroadcastHashJoin" in physical
    assert physical.index("HashAggregate") < physical.rindex("HashAggregate")


def test_a_dimension_filter_reaches_the_fact_scan(lake):
    plan = plan_of(lake.model.query([], ["Total Spend"], [Members("Channel.Platform", ["Meta Ads"])]))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Join" not in physical and "channel_key" in physical[physical.index("PushedFilters") :]
    days = [Between("Date.Date", date(1996, 1, 1), date(1997, 12, 31))]
    physical = plan_of(lake.model.query([], ["Total Spend"], days))
    assert "GreaterThanOrEqual(date_key,19960101)" in physical and "LeftSemi" in physical


def test_the_largest_of_many_with_ties(spark):
    """A hundred thousand members of one parent: places as one ranking gives them, which no task makes alone."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from adlake.plans.semantic import largest

    many = spark.range(100_000).select(F.lit(None).cast("string").alias("p"), F.col("id").alias("member"), (F.col("id") * 7919 % 9973).cast("double").alias("value"))
    few = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, 1.0), ("b", 1, -1.0), (None, 7, 1e9)], "p string, member long, value double")
    frame = many.unionAll(few)
    place = F.rank().over(Window.partitionBy("p").orderBy(F.desc("value")))
    wanted = frame.withColumn("place", place).filter("place <= 3")
    assert rows(largest(frame, ["p"], ["p", "member"], 3)) == rows(wanted)
    alone = many.drop("p")
    wanted = alone.withColumn("place", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("value")))).filter("place <= 3")
    found = largest(alone, [], ["member"], 3)
    assert rows(found) == rows(wanted) and found.count() == 10
