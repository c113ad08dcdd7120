import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.fixed import CATALOG_TABLE, CATALOG_TYPES
from adlake.sources import (
    TableStore, batch_stamp, coerce, explode_records, landed_files, literal_rows, parse_records, scan, select_or_null,
    typed_catalog,
)
from adlake.sources.signals import feeds, fingerprint

RECORD = (
    "id string, title string, category string, brand string, price string, rating double, stock int, sku string, "
    "tags array<string>, dimensions struct<width:double,height:double>, "
    "reviews array<struct<rating:int,comment:string>>, meta struct<barcode:string>"
)
DOCUMENT = {
    "products": [
        {"id": 1, "title": "One", "category": "c", "brand": "b", "price": 9.99999, "rating": 4.5, "stock": 3, "sku": "s",
         "tags": ["x", "y"], "dimensions": {"width": 1.5, "height": 2.0}, "reviews": [{"rating": 5, "comment": "good"}],
         "meta": {"barcode": "123"}},
        {"id": 2, "title": "Two", "category": "c", "price": 5, "rating": 3.5, "stock": 1, "sku": "t"},
        {"id": 3, "title": "Three", "category": "d", "brand": "b", "price": "n/a", "stock": 0, "sku": "u"},
    ],
    "total": 3,
}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    (folder / "products.json").write_text(json.dumps(DOCUMENT, indent=1))
    (folder / "lines.jsonl").write_text(json.dumps(DOCUMENT) + "\n" + json.dumps(DOCUMENT) + "\n")
    return folder


def test_document_to_rows(spark, landing):
    records = explode_records(spark, f"{landing}/products.json", "products", RECORD)
    assert records.count() == 3
    first = records.filter("id = '1'").select("dimensions.height", "reviews.comment", "meta.barcode", "tags").first()
    assert tuple(first) == (2.0, ["good"], "123", ["x", "y"])
    assert explode_records(spark, f"{landing}/lines.jsonl", "products", RECORD, multi_line=False).count() == 6


def test_typed_catalog_is_stamped_and_stored(spark, landing, tmp_path):
    records = explode_records(spark, f"{landing}/products.json", "products", RECORD)
    catalog = typed_catalog(records, "2024-09-01 12:30:05")
    found = {r.id: r for r in catalog.collect()}
    assert float(found[1].price) == 10.0 and found[3].price is None and found[2].brand is None
    assert found[1].discountPercentage is None and found[1].batch_id == "20240901123005"
    assert catalog.schema["price"].dataType.simpleString() == "decimal(19,4)"
    store = TableStore(spark, str(tmp_path))
    store.write(catalog, CATALOG_TABLE)
    assert store.read(CATALOG_TABLE).count() == 3


def test_coerce_reports_what_it_lost(spark):
    frame = spark.createDataFrame([("1", "2024-01-01"), ("x", "never"), (None, None)], "n string, d string")
    typed, rejects = coerce(frame, {"n": "bigint", "d": "date"})
    assert typed.filter("n IS NULL").count() == 2
    assert [(r.n, r.bad_columns) for r in rejects.collect()] == [("x", ["n", "d"])]


def test_select_or_null_types_the_missing(spark):
    frame = select_or_null(spark.range(1), CATALOG_TYPES)
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint", *list(CATALOG_TYPES.values())[1:]]


def test_landed_files(spark, landing):
    found = landed_files(spark, str(landing), "*.json").select("length").collect()
    assert len(found) == 1 and found[0].length > 100


def test_parse_records(spark):
    frame = spark.createDataFrame([(1, '{"k": 5}'), (2, "junk")], "i int, props string")
    assert rows(parse_records(frame, "props", "k bigint", keep=["i"])) == [(1, 5), (2, None)]


def test_scan_by_path_and_by_name(spark, tmp_path):
    spark.range(3).selectExpr("id", "id * 2 AS double_id").write.parquet(f"{tmp_path}/numbers")
    frame = scan(spark, "numbers", str(tmp_path), ["double_id"])
    assert frame.columns == ["double_id"]
    frame.createOrReplaceTempView("test_numbers")
    assert scan(spark, "test_numbers").count() == 3


def test_literal_rows_verify(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False)])
    assert literal_rows(spark, [(1,)], schema).count() == 1
    assert literal_rows(spark, [(1, "a")], ["n", "s"]).columns == ["n", "s"]
    for bad in [(None,), ("x",)]:
        with pytest.raises(Exception):
            literal_rows(spark, [bad], schema)


def test_batch_stamp_is_one_value(spark):
    frame = batch_stamp(spark.range(5), "2024-09-01 12:30:05")
    assert rows(frame.select("ingestion_utc", "batch_id").distinct()) == [(datetime(2024, 9, 1, 12, 30, 5), "20240901123005")]


def test_feed_columns_are_the_platforms_own(lake):
    from adlake.operators.conform import FEEDS

    for name, feed in lake.feeds.items():
        assert feed.columns == FEEDS[name].feed_columns


def test_a_feed_reads_only_its_platforms_files(lake):
    from conftest import plan_of

    plan = plan_of(lake.feeds["src_meta_ads_raw"])
    assert "PartitionFilters: [isnotnull(source_system" in plan


def test_fingerprint_follows_the_files(spark, tmp_path):
    from adlake.sources.signals import INPUTS

    for name in INPUTS:
        spark.range(1).write.parquet(f"{tmp_path}/{name}.parquet")
    before = fingerprint(spark, str(tmp_path))
    assert fingerprint(spark, str(tmp_path)) == before
    spark.range(1).write.mode("append").parquet(f"{tmp_path}/part.parquet")
    assert fingerprint(spark, str(tmp_path)) != before


def test_feeds_cover_all_signals(lake):
    total = sum(f.count() for f in lake.feeds.values())
    assert total == 6000 and feeds.__name__ == "feeds"


def test_nothing_is_left_when_the_application_ends(tmp_path):
    import subprocess
    import sys
    import time

    job = (
        "from pyspark.sql import SparkSession; from adlake.session import materialize, shared_folder; import os;"
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', '{tmp_path}').getOrCreate();"
        "f = materialize(s.range(3), 'a'); assert f.count() == 3 and os.path.isdir(shared_folder(s)); s.stop()"
    )
    subprocess.run([sys.executable, "-c", job], check=True, timeout=120)
    until = time.time() + 30  # the JVM ends after Python
    while list((tmp_path / "adlake").iterdir()) and time.time() < until:
        time.sleep(0.5)
    assert list((tmp_path / "adlake").iterdir()) == []


def test_documents_of_a_hot_key_are_bounded(spark):
    """One conversation holds nearly all turns: no document has more than its number of records, and none is lost."""
    from adlake.queries import in_documents

    rows = spark.range(5000).select(F.when(F.col("id") < 4900, 1).otherwise(F.col("id")).alias("conv_id"), "id")
    found = in_documents(rows, "conv_id", F.struct(F.col("id")), 100).select(F.from_json("value", "products array<struct<id: long>>").alias("v")).collect()
    assert max(len(r.v.products) for r in found) <= 100
    assert sorted(x.id for r in found for x in r.v.products) == list(range(5000))
