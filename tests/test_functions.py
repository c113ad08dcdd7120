from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from adlake import functions as fn
from adlake.functions.columns import DOLLARS, MULTIPLE, PERCENT, SHORT_DATE, WHOLE


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_date_key(spark):
    assert one(spark, fn.date_key(F.lit(date(2024, 2, 9)))) == 20240209
    assert one(spark, fn.date_key(F.lit(None).cast("date"))) is None


def test_banker_round_takes_the_even_neighbour(spark):
    for text, expected in [("2.345", "2.34"), ("2.355", "2.36"), ("-2.345", "-2.34"), ("7", "7.00")]:
        assert one(spark, fn.banker_round(F.lit(Decimal(text)))) == Decimal(expected)
    assert one(spark, fn.banker_round(F.lit(2.345))) == Decimal("2.34")


def test_positive_ratio_needs_a_positive_denominator(spark):
    for bottom, expected in [(4, 0.5), (0, None), (-4, None), (None, None)]:
        assert one(spark, fn.positive_ratio(F.lit(2), F.lit(bottom).cast("bigint"))) == expected


def test_divide_only_refuses_zero_and_null(spark):
    for bottom, expected in [(4, 0.5), (-4, -0.5), (0, None), (None, None)]:
        assert one(spark, fn.divide(F.lit(2), F.lit(bottom).cast("bigint"))) == expected


def test_text_key_tells_null_from_empty(spark):
    frame = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert frame.select(fn.text_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 3


def test_display(spark):
    assert one(spark, fn.display(F.lit(1234567), WHOLE)) == "1,234,567"
    assert one(spark, fn.display(F.lit(Decimal("1234.5")), DOLLARS)) == "$1,234.50"
    assert one(spark, fn.display(F.lit(Decimal("-1234.5")), DOLLARS)) == "-$1,234.50"
    assert one(spark, fn.display(F.lit(0.0756), PERCENT)) == "7.56%"
    assert one(spark, fn.display(F.lit(21.0), MULTIPLE)) == "21.00x"
    assert one(spark, fn.display(F.lit(date(2024, 2, 9)), SHORT_DATE)) == "2/9/2024"
    for pattern in (WHOLE, DOLLARS, PERCENT, MULTIPLE):
        assert one(spark, fn.display(F.lit(None).cast("double"), pattern)) is None
