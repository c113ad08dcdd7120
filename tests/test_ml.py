import math
import statistics
from datetime import date, datetime

import pytest
from conftest import plan_of, rows
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from adlake.fixed import PREDICTION, SCORING_SIGNATURE
from adlake.ml import features, training
from adlake.sources.tables import TableStore


def test_clean_names(spark):
    frame = spark.range(1).select(F.col("id").alias("a b--c"), F.col("id").alias("ok_1"))
    assert features.clean_names(frame).columns == ["a_b_c", "ok_1"]


def test_drop_null_columns_and_selection(spark):
    frame = spark.createDataFrame(
        [(1, None, "x", date(2024, 1, 1), None), (None, None, "y", None, None)],
        "n int, gone double, s string, d date, also string",
    ).withColumn("m", F.lit("2.50").cast("decimal(18,2)"))
    assert features.drop_null_columns(frame).columns == ["n", "s", "d", "m"]
    chosen = features.feature_frame(frame)
    assert chosen.columns == ["n", "d", "m"] and chosen.schema["m"].dataType.simpleString() == "double"
    assert features.feature_frame(frame, ["s"]).columns == ["n", "s", "d", "m"]


def adjusted(values):
    n, mean = len(values), statistics.fmean(values)
    m2 = sum((v - mean) ** 2 for v in values) / n
    m3 = sum((v - mean) ** 3 for v in values) / n
    return m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2)


def test_skewness_and_strategy(spark):
    data = [(float(i), float(2**i), 5.0, None if i > 1 else 1.0, i % 2) for i in range(12)]
    frame = spark.createDataFrame(data, "flat double, steep double, same double, few double, bit int")
    found = {r.column_name: r for r in features.impute_plan(frame).collect()}
    assert abs(found["steep"].skewness - adjusted([r[1] for r in data])) < 1e-9
    assert {c: r.strategy for c, r in found.items()} == {
        "flat": "mean", "steep": "median", "same": "mean", "few": "most_frequent", "bit": "mean"
    }
    assert found["few"].value_count == 2


def test_modes_take_the_lowest_on_ties(spark):
    frame = spark.createDataFrame(
        [("b", 2, date(2024, 1, 2)), ("a", 1, None), ("a", 2, None), ("b", 1, None), (None, None, None)],
        "s string, n int, d date",
    ).withColumn("none", F.lit(None).cast("string"))
    assert features.modes(frame, ["s", "n", "d", "none"]) == {"s": "a", "n": 1, "d": date(2024, 1, 2), "none": None}


def test_fills_are_learnt_on_train_alone(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b")], "x double, s string")
    test = spark.createDataFrame([(None, None), (float("nan"), "c"), (100.0, "d")], "x double, s string")
    fills = features.fit_impute(train)
    filled = features.apply_impute(test, fills)
    assert [f.strategy for f in fills] == ["most_frequent", "most_frequent"]
    assert sorted(r.x for r in filled.collect()) == [1.0, 1.0, 100.0] and filled.filter("s IS NULL").count() == 0


def test_whole_numbers_filled_by_mean_become_double(spark):
    frame = spark.createDataFrame([(1,), (2,), (4,), (None,)], "x int")
    filled = features.apply_impute(frame, features.fit_impute(frame))
    assert filled.schema["x"].dataType.simpleString() == "double" and filled.agg(F.sum("x")).first()[0] == 7 + 7 / 3


def test_dates_fill_forward_then_by_mode(spark):
    day = date(2024, 1, 5)
    frame = spark.createDataFrame([(1, None), (2, day), (3, None), (4, None)], "k int, d date")
    fills = [features.Fill("d", "most_frequent", date(2024, 1, 1))]
    filled = features.fill_datetimes(frame.withColumn("g", F.lit(1)), fills, ["g"], ["k"])
    assert [r.d for r in filled.orderBy("k").collect()] == [date(2024, 1, 1), day, day, day]


def test_known_dates_fill_other_rows(spark):
    """Gaps take the last date at or before them, of the fitted rows or their own; other groups and columns don't matter."""
    def of(*found):
        return spark.createDataFrame([(g, k, d and date(2024, 1, d), "x") for g, k, d in found], "g string, k int, d date, other string")

    state = features.fit_dates(of(("a", 1, 3), ("a", 5, None), ("a", 9, 7), (None, 2, 8), ("b", 4, 9)), ["g"], ["k"])
    assert state.columns == ("d",) and state.known.count() == 4
    frame = of(("a", 0, None), ("a", 2, None), ("a", 6, 5), ("a", 8, None), ("a", 9, None), ("b", 3, None), (None, 3, None), ("c", 1, None))
    filled = state.apply(frame.withColumn("k", F.col("k").cast("bigint")))
    assert filled.columns == frame.columns and filled.schema["k"].dataType.simpleString() == "bigint"
    days = {(r.g, r.k): r.d and r.d.day for r in filled.collect()}
    assert days == {("a", 0): None, ("a", 2): 3, ("a", 6): 5, ("a", 8): 5, ("a", 9): 7, ("b", 3): None, (None, 3): 8, ("c", 1): None}
    assert state.apply(frame.limit(0)).count() == 0
    none = features.fit_dates(frame.limit(0), ["g"], ["k"])
    assert rows(none.apply(frame)) == rows(features.ffill(frame, ["d"], ["g"], ["k"]))
    assert features.fit_dates(frame.drop("d"), ["g"], ["k"]).apply(frame).columns == frame.columns


def test_a_model_fills_dates_as_it_was_trained(spark, tmp_path):
    """Spend follows the day, which is missing on a third of the rows and is that of the row before."""
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.floor(F.col("id") / 4)).cast("int"))
    frame = spark.range(400).select(
        F.col("id").alias("k"), F.lit("a").alias("g"), F.when(F.col("id") % 4 != 3, day).alias("day"),
        (F.floor(F.col("id") / 4) * 2.0).alias("spend"),
    )
    train, test = frame.filter("k % 7 != 3"), frame.filter("k % 7 = 3")
    plain = training.train(train.drop("k", "g"), "spend", folds=2, trials=2, grid=small_grid)
    result = training.train(train, "spend", folds=2, trials=2, grid=small_grid, dates_along=(["g"], ["k"]))
    assert result.signature == [("day", "date")] and result.dates.columns == ("day",) and plain.dates is None
    models = training.ModelStore(TableStore(spark, str(tmp_path)))
    models.save("spend", plain)
    models.save("spend", result)
    assert models.dates("spend", 1) is None
    model, signature = models.load("spend")
    scored = training.score(test, model, signature, keep=["k", "spend"], dates=models.dates("spend"))
    assert training.evaluate(scored, "spend").first().rmse < 0.5
    assert training.evaluate(training.score(test, plain.model, plain.signature, keep=["spend"]), "spend").first().rmse > 5
    again = training.score(test, result.model, result.signature, keep=["k", "spend"], dates=result.dates)
    assert rows(scored) == rows(again) and scored.filter("day is null").count() == 0


def test_hash_split_ignores_partitioning(spark):
    frame = spark.range(10000)
    train, test = features.hash_split(frame, ["id"], 0.8, 41)
    again, _ = features.hash_split(frame.repartition(7), ["id"], 0.8, 41)
    assert train.exceptAll(again).count() == 0 and train.count() + test.count() == 10000
    assert abs(train.count() - 8000) < 200
    assert features.hash_split(frame, ["id"], 0.8, 42)[0].exceptAll(train).count() > 0


def small_grid(pipeline, seed, bins):
    linear = LinearRegression(featuresCol="_features", labelCol=training.LABEL, predictionCol=PREDICTION)
    return ParamGridBuilder().baseOn({pipeline.stages: [linear]}).addGrid(linear.regParam, [0.0, 10.0]).build()


@pytest.fixture(scope="module")
def trained(spark):
    frame = spark.range(600).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 37).cast("double").alias("x"),
        F.timestamp_micros(F.col("id") * 86_400_000_000).cast("timestamp_ntz").alias("t"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
        F.when(F.col("id") % 40 != 1, 5.0 * (F.col("id") % 37) + F.col("id")).cast("decimal(18,2)").alias("spend"),
    )
    return frame, training.train(frame, "spend", ["kind"], trials=2, grid=small_grid)


def test_nan_is_missing_wherever_statistics_are_taken(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (3.0,)], "x double").withColumn("gone", F.lit(float("nan")))
    profile = {r.column_name: r for r in features.impute_plan(frame).collect()}
    assert (profile["x"].value_count, profile["x"].mean, profile["x"].skewness, profile["x"].strategy) == (3, 2.0, 0.0, "mean")
    assert profile["gone"].value_count == 0 and profile["gone"].strategy == "most_frequent"
    assert tuple(features.impute_stats(frame, ["x"]).first()) == ("x", 2.0, 2.0, 1.0)
    assert [f.value for f in features.fit_impute(frame)] == [2.0, None]
    assert sorted(r.x for r in features.apply_impute(frame, features.fit_impute(frame)).collect()) == [1.0, 2.0, 2.0, 2.0, 3.0]
    assert features.drop_null_columns(frame).columns == ["x"]
    assert spark.range(1).select(features.strategy(F.lit(float("nan"))).alias("s")).first().s == "most_frequent"


def test_many_categories_and_missing_dates_train(spark):
    frame = spark.range(400).select(
        F.concat(F.lit("brand"), F.col("id") % 40).alias("brand"),
        F.when(F.col("id") % 5 != 0, F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int"))).alias("day"),
        (F.col("id") % 40 * 3.0).alias("spend"),
    )
    result = training.train(frame, "spend", ["brand"], folds=2)
    error = training.evaluate(training.score(frame, result.model, result.signature, keep=["spend"]), "spend").first()
    assert len(result.metrics.collect()) == 5 and error["rows"] == 400 and error.rmse < 1.0
    rows_in = result.model.transform(frame).filter("day is null").select(F.col("_f_day")).distinct().collect()
    assert [r[0] for r in rows_in] == [(date(2024, 1, 1) - date(1970, 1, 1)).days]


def test_a_grid_beyond_the_trials_is_refused(trained):
    frame, _ = trained
    with pytest.raises(ValueError):
        training.train(frame, "spend", ["kind"], trials=1, grid=small_grid)


def test_training_compares_the_candidates(trained):
    _, result = trained
    metrics = result.metrics.collect()
    assert len(metrics) == 2 and sum(r.best for r in metrics) == 1
    assert min(metrics, key=lambda r: r.rmse).best
    assert result.signature == [("x", "double"), ("t", "timestamp_ntz"), ("kind", "string")]


def test_model_is_saved_with_versions_and_signature(spark, trained, tmp_path):
    frame, result = trained
    models = training.ModelStore(TableStore(spark, str(tmp_path)))
    assert models.save("spend", result) == 1 and models.save("spend", result) == 2
    model, signature = models.load("spend")
    assert signature == result.signature
    a = training.score(frame, model, signature, keep=["spend"])
    b = training.score(frame, result.model, result.signature, keep=["spend"])
    assert rows(a) == rows(b) and a.columns == ["x", "t", "kind", "spend", PREDICTION]
    assert a.filter(F.col(PREDICTION).isNull()).count() == 0
    error = training.evaluate(a, "spend").first()
    assert error["rows"] == 585 and error.r2 > 0.5
    store = TableStore(spark, str(tmp_path))
    store.write(a, "ml_demo/batch_score")
    store.write(b, "ml_demo/batch_score", keep_schema=True)
    assert store.read("ml_demo/batch_score").count() == 600
    with pytest.raises(KeyError):
        models.load("other")


def test_unseen_categories_and_wide_numbers_score(spark, trained):
    _, result = trained
    frame = spark.createDataFrame([(7, datetime(2024, 1, 1), "never seen")], "x int, t timestamp_ntz, kind string")
    assert training.score(frame, result.model, result.signature, "p").first().p is not None
    with pytest.raises(ValueError):
        training.score(frame.withColumn("x", F.lit("seven")), result.model, result.signature)
    with pytest.raises(ValueError):
        training.score(frame.drop("t"), result.model, result.signature)


def test_signature_differences():
    from pyspark.sql import SparkSession

    frame = SparkSession.active().createDataFrame([(1, "a")], "n int, s string")
    assert training.check_signature(frame, [("n", "int"), ("s", "string")]) == []
    assert training.check_signature(frame, [("s", "string"), ("n", "int")]) == ["columns are out of order"]
    found = training.check_signature(frame, [("n", "double"), ("z", "int")])
    assert found == ["missing z", "unexpected s", "n is int, expected double"]


MANUAL = (
    date(2024, 9, 1), datetime(2024, 9, 1, 12), 123.0, 1.0, 100000.0, 5000.0, 4000.0, 2000.0, 3000.0, 400.0, 50.0,
    100000.0, "Google Ads", "Search", "Back to School", "Awareness", "Laptop", "BrandX", "Electronics", "US", "Mobile",
    "batch_1", "Approved",
)


def test_manual_row_is_verified_and_scored(spark, lake):
    rows_in = training.manual_rows(spark, [MANUAL], SCORING_SIGNATURE)
    assert training.check_signature(rows_in, SCORING_SIGNATURE) == [] and not any(f.nullable for f in rows_in.schema)
    with pytest.raises(Exception):
        training.manual_rows(spark, [(None, *MANUAL[1:])], SCORING_SIGNATURE)
    names = [n for n, _ in SCORING_SIGNATURE]
    silver = lake.silver.select(
        *[F.col(n).cast(t).alias(n) for n, t in SCORING_SIGNATURE], "spend"
    )
    categorical = ["source_system", "channel", "region", "device_category"]
    used = [n for n, t in SCORING_SIGNATURE if t != "string" or n in categorical]
    result = training.train(silver.select(*used, "spend"), "spend", categorical, trials=2, grid=small_grid)
    scored = training.score(rows_in, result.model, result.signature, keep=names)
    assert scored.first()[PREDICTION] is not None and scored.count() == 1


def test_no_python_runs_over_the_data(lake):
    filled = features.apply_impute(lake.silver, [features.Fill("clicks", "mean", 1.0)])
    assert "Python" not in plan_of(filled) and "Pandas" not in plan_of(filled)


def folded(spark, rows=900):
    """Three folds, gaps whose mean differs by fold, and a category that one fold alone holds."""
    return spark.range(rows).select(
        (F.col("id") % 3).cast("int").alias("_fold"),
        F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 101).cast("double") + 40 * (F.col("id") % 3)).alias("x"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("day"),
        F.when(F.col("id") % 30 == 2, "rare").when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"),
        (F.col("id") * 37 % 101 * 3.0 + F.col("id") * 53 % 17 + 20 * (F.col("id") % 2)).alias("_label"),
    )


def test_fold_errors_equal_models_fitted_without_the_fold(spark):
    """Against a regression by Spark for each fold and strength, with fills and categories of the other folds."""
    from pyspark.ml.regression import LinearRegression

    from adlake.ml.ridge import fold_errors, fold_moments

    frame = folded(spark).persist()
    design = training.design_of(frame, ["x", "day", "kind"], ["kind"])
    assert design.missing == ["x"] and design.labels == {"kind": ["a", "b", "rare"]} and design.width == 6
    fills = {k: {"x": frame.filter(F.col("_fold") != k).agg(F.avg("x")).first()[0]} for k in range(3)}
    found = {(s, k): e for s, k, _, e in fold_errors(fold_moments(frame, design, "_label", "_fold"), design, [0.0, 0.5, 20.0], fills)}
    for k in range(3):
        known = frame.filter(F.col("_fold") != k)
        given = [features.Fill("x", "mean", fills[k]["x"]), features.Fill("day", "none", None)]
        stages = training.preparation(frame.select("x", "day", "kind"), ["kind"], given).fit(known)
        for strength in (0.0, 0.5, 20.0):
            model = LinearRegression(featuresCol="_wide", labelCol="_label", predictionCol=PREDICTION, regParam=strength).fit(stages.transform(known))
            held = model.transform(stages.transform(frame.filter(F.col("_fold") == k)))
            assert training.evaluate(held, "_label").first().rmse == pytest.approx(found[strength, k], rel=1e-6)
    frame.unpersist()


def test_a_held_out_fold_does_not_leak(spark):
    """Changing the inputs and targets of a fold changes no model that predicts it."""
    from adlake.ml.ridge import fold_moments, solve

    frame = folded(spark)
    other = frame.withColumns({"_label": F.when(F.col("_fold") == 1, -999.0).otherwise(F.col("_label")), "x": F.when(F.col("_fold") == 1, 5e5).otherwise(F.col("x"))})
    weights = []
    for rows_in in (frame, other):
        design = training.design_of(rows_in, ["x", "day", "kind"], ["kind"])
        moments = fold_moments(rows_in, design, "_label", "_fold")
        fills = training._fold_fills(rows_in, 1, ["x", "day"], design.missing, False)
        assert [f.column for f in fills] == ["x"]
        weights.append((fills, solve(design.filled(moments[0] + moments[2], {"x": fills[0].value}), 1.0).round(9).tolist()))
    assert weights[0] == weights[1]


def test_candidates_of_both_kinds_agree(spark, monkeypatch):
    """Ridge candidates give one error, by sums or fitted for each fold."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    def ridge_grid(pipeline, seed, bins):
        linear = LinearRegression(featuresCol="_wide", labelCol="_label", predictionCol=PREDICTION)
        return ParamGridBuilder().baseOn({pipeline.stages: [linear]}).addGrid(linear.regParam, [0.1, 5.0]).build()

    frame = folded(spark).drop("_fold").withColumnRenamed("_label", "spend")
    by_sums = training.train(frame, "spend", ["kind"], grid=ridge_grid)
    monkeypatch.setattr(training, "WIDEST_DESIGN", 2)
    fitted = training.train(frame, "spend", ["kind"], grid=ridge_grid)
    errors = [[r.rmse for r in t.metrics.orderBy("trial").collect()] for t in (by_sums, fitted)]
    assert errors[0] == pytest.approx(errors[1], rel=1e-6) and errors[0][0] < errors[0][1]


def test_vectors_no_candidate_reads_are_not_written(spark, monkeypatch):
    from pyspark.ml.tuning import ParamGridBuilder

    def two(pipeline, seed, bins):
        linear = LinearRegression(featuresCol="_wide", labelCol="_label", predictionCol=PREDICTION, regParam=1.0, elasticNetParam=0.5)
        grid = ParamGridBuilder().baseOn({pipeline.stages: [linear]})
        return grid.build() + grid.addGrid(linear.featuresCol, ["_features"]).build()

    written, write = [], training.materialize
    monkeypatch.setattr(training, "materialize", lambda frame, label: written.append((label, frame.columns)) or write(frame, label))
    frame = folded(spark).drop("_fold").withColumnRenamed("_label", "spend")
    found = training.train(frame, "spend", ["kind"], grid=two).metrics.filter("best").first()
    assert [c for label, c in written if label == "features"][:-1] == [["_wide", "_features", "_label", "_fold"]] * 3
    assert written[-1] == ("features", [["_wide", "_features"][found.trial], "_label"])
    written.clear()
    training.train(frame, "spend", ["kind"], grid=lambda *a: two(*a)[1:])
    assert {tuple(c) for label, c in written if label == "features"} == {("_features", "_label", "_fold"), ("_features", "_label")}


def test_one_fold_alone_is_refused(spark):
    from adlake.ml.ridge import Design, fold_errors, fold_moments

    frame = folded(spark).withColumn("_fold", F.lit(0))
    design = Design(["x"], {}, ["x"])
    with pytest.raises(ValueError):
        fold_errors(fold_moments(frame, design, "_label", "_fold"), design, [0.0], {0: {"x": 1.0}})
