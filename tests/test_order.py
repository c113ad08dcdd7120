"""Operators that follow an order: dense keys, forward fill, layout, top rows, quantiles."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlake.ml.quantiles import medians, rank_values
from adlake.operators import pick
from adlake.operators.fill import ffill
from adlake.operators.keys import attach_keys, dense_key, dimension, unkeyed_rows
from adlake.operators.layout import clustered, file_count, file_ranges
from adlake.operators.ranges import ranged
from adlake.session import materialize


@pytest.fixture(scope="module")
def members(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("n'\"\\"), (F.col("id") % 40).cast("string"))).alias("name"),
        (F.col("id") * 7919 % 3001).alias("code"),
        F.timestamp_micros(F.col("id") * 1_234_567).cast("timestamp_ntz").alias("at"),
    )
    return materialize(frame, "test_members")


@pytest.mark.parametrize("order", [["name", "code"], ["code"], ["at"], ["name", "at", "code"]])
def test_ranged_keys_equal_a_global_row_number(members, order):
    ranged = dense_key(members, order, "key", small_rows=0, buckets=16)
    sort = [F.col(c).asc_nulls_first() for c in order]
    whole = members.withColumn("key", F.row_number().over(Window.orderBy(*sort)))
    assert ranged.exceptAll(whole).count() == 0
    assert ranged.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first() == (1, 3000, 3000)


def test_ranges_follow_the_order(members):
    order = ["name", "code"]
    placed = ranged(members, order, 16)
    ranked = placed.withColumn("before", F.lag("_bucket").over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    assert ranked.filter("before > _bucket").count() == 0 and placed.count() == 3000
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1000


def test_dimension_is_distinct_and_numbered(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 3)], "x string, y int")
    assert rows(dimension(frame, ["x", "y"], "k")) == [("a", 2, 2), ("b", 1, 3), (None, 3, 1)]


def test_null_keys_drop_unless_null_safe(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2)], "x string, v int")
    dim = dimension(fact, ["x"], "k")
    assert attach_keys(fact, dim, ["x"], "k").count() == 1
    safe = attach_keys(fact, dim, ["x"], "k", null_safe=True)
    assert safe.columns == ["x", "v", "k"] and safe.count() == 2
    assert rows(unkeyed_rows(fact, dim, ["x"])) == [(None, 1)]


@pytest.fixture(scope="module")
def gaps():
    generator = random.Random(3)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(2000):
        user = 7 if i % 3 == 0 else generator.randrange(40)
        user = None if user == 39 else user
        a = generator.choice([None, None, None, float(i)])
        b = generator.choice([None, f"t{i}"]) if user != 7 or i > 900 else None
        data.append((user, start + timedelta(microseconds=generator.randrange(10**9)), i, a, b))
    return data


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_ffill_equals_brute_force_with_a_hot_group(spark, gaps, buckets):
    frame = spark.createDataFrame(gaps, "u bigint, ts timestamp_ntz, id int, a double, b string").repartition(5)
    filled = ffill(frame, ["a", "b"], ["u"], ["ts", "id"], buckets=buckets)
    assert filled.columns == frame.columns
    expected, last = [], {}
    for u, ts, i, a, b in sorted(gaps, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        before = last.get(u, (None, None))
        last[u] = (a if a is not None else before[0], b if b is not None else before[1])
        expected.append((u, ts, i, *last[u]))
    assert rows(filled) == sorted(expected, key=repr)


def test_ffill_splits_the_hot_group(spark, gaps):
    frame = spark.createDataFrame(gaps, "u bigint, ts timestamp_ntz, id int, a double, b string")
    assert ranged(frame, ["u", "ts", "id"], 32).filter("u = 7").select("_bucket").distinct().count() > 5


@pytest.fixture(scope="module")
def grid(spark):
    frame = spark.range(20000).select(
        (F.lit(20240101) + F.col("id") * 17 % 365).cast("int").alias("day"),
        F.when(F.col("id") % 997 != 0, F.col("id") * 31 % 5).cast("bigint").alias("campaign"),
        F.col("id").alias("id"),
    )
    return materialize(frame, "test_grid")


def test_clustering_keeps_every_row_and_narrows_files(spark, grid, tmp_path):
    clustered(grid, ["day", "campaign"], files=16).write.parquet(f"{tmp_path}/c")
    laid = spark.read.parquet(f"{tmp_path}/c")
    assert laid.exceptAll(grid).count() == 0 and laid.count() == 20000
    ranges = file_ranges(laid, ["day", "campaign"]).collect()
    assert len(ranges) == 16 and sum(r.max_day - r.min_day for r in ranges) / 16 < 40  # of 364


def test_clustering_spreads_a_hot_value(spark, tmp_path):
    frame = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    clustered(frame, ["k"], files=9).write.parquet(f"{tmp_path}/c")
    sizes = [r.rows for r in file_ranges(spark.read.parquet(f"{tmp_path}/c"), ["k"]).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2000


def test_clustering_by_a_column_without_values(spark):
    frame = spark.range(10).select(F.lit(None).cast("int").alias("k"), "id")
    assert clustered(frame, ["k", "id"], files=2).count() == 10


def test_file_count():
    assert file_count(10, 8) == 1
    assert file_count(500_000, 8) == 8
    assert file_count(600_000_000_000, 8) == 600_000


def test_top_with_ties(spark):
    frame = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1), ("e", None)], "k string, v int")
    assert [r[0] for r in rows(pick.top_with_ties(frame, "v", 2))] == ["a", "b", "c"]
    assert pick.top_with_ties(frame, "v", 5).count() == 5
    assert [r[0] for r in rows(pick.top_with_ties(frame, "v", 1))] == ["a"]
    assert "Window" not in plan_of(pick.top_with_ties(frame, "v", 2))


def test_bounded_sample_is_the_smallest_digests(spark):
    frame = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    expected = sorted(
        r.k for r in frame.select("k", pick.row_digest(["k"]).alias("d")).orderBy("d").limit(500).collect()
    )
    for parts in (1, 7):
        assert sorted(r.k for r in pick.bounded_sample(frame.repartition(parts), ["k"], 500).collect()) == expected
    assert pick.bounded_sample(frame, ["k"], 30000).count() == 20000


def test_pick_member_is_fixed_by_the_seed(spark):
    dim = spark.range(100).select(F.col("id").alias("k"))
    picks = [pick.pick_member(dim.repartition(p), "k", 5).first()[0] for p in (1, 4)]
    assert picks[0] == picks[1]
    assert len({pick.pick_member(dim, "k", s).first()[0] for s in range(6)}) > 1


def test_latest_rows_break_ties(spark):
    frame = spark.createDataFrame([(1, 9), (2, 5), (2, 3), (2, 4)], "d int, x int")
    assert [tuple(r) for r in pick.latest_rows(frame, "d", 2).collect()] == [(2, 3), (2, 4)]


@pytest.mark.parametrize("small_rows, accuracy", [(10, 50), (100, 1000), (100_000, 10_000)])
def test_medians_are_exact(spark, small_rows, accuracy):
    generator = random.Random(11)
    columns = {
        "spread": [generator.gauss(0, 1000) for _ in range(4001)],
        "hot": [7.0 if i % 3 else generator.uniform(0, 14) for i in range(4001)],
        "two": [float(i % 2) for i in range(4001)],
        "sparse": [generator.random() if i % 4 == 0 else None for i in range(4001)],
        "ends": [0.0 if i < 2000 else 9.0 for i in range(4000)] + [None],
    }
    frame = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    counts = {c: sum(v is not None for v in values) for c, values in columns.items()}
    expected = {c: statistics.median([v for v in values if v is not None]) for c, values in columns.items()}
    assert medians(frame, counts, small_rows, accuracy) == expected


def test_rank_values_at_both_ends(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert rank_values(frame, [("v", 0, 1000), ("v", 999, 1000), ("v", 500, 1000)], 5, 20) == [0, 999, 500]


def test_median_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert medians(frame, {"v": 0}) == {"v": None}


def test_bitmaps_count_and_add_up(spark):
    """Hot, negative, far and null keys; months merge into years and loads into one."""
    from adlake.operators import presence

    data = [(k % 3, k % 2, key) for k, key in enumerate([0, 0, 0, 1, 32767, 32768, 32769, 10**12, -1, -32768, None, 5] * 40)]
    frame = spark.createDataFrame(data, "month int, load int, key long")
    found = {r.month: r.n for r in presence.distinct_keys(presence.key_bitmaps(frame, ["month"], "key"), ["month"], "n").collect()}
    assert found == {m: len({k for a, _, k in data if a == m and k is not None}) for m in range(3)}
    loads = [presence.key_bitmaps(frame.filter(f"load = {n}"), ["month"], "key") for n in (0, 1)]
    both = loads[0].unionAll(loads[1])
    assert presence.distinct_keys(both, [], "n").first().n == len({k for *_, k in data} - {None})
    assert presence.merged(both, ["month"]).count() == presence.key_bitmaps(frame, ["month"], "key").count()
    assert presence.distinct_keys(presence.key_bitmaps(frame.limit(0), ["month"], "key"), ["month"], "n").collect() == []
