"""Trees grown over coded rows, against those that Spark fits."""

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from adlake.fixed import PREDICTION
from adlake.ml import features, trees, training
from adlake.ml.blocks import rows_of
from adlake.ml.ridge import Design, number
from adlake.sources.tables import TableStore

COLUMNS = {"featuresCol": "_features", "labelCol": "_label", "predictionCol": PREDICTION}
NUMBERS, CATEGORIES = ["x", "y", "few", "same"], ["kind", "side"]


@pytest.fixture(scope="module")
def given(spark):
    """Numbers with gaps, many and few values, ties and a constant; categories of very different size, one with a null."""
    i = F.col("id")
    frame = spark.range(6000).repartition(5).select(
        F.when(i % 19 != 3, (F.hash("id") % 10_007) / 7.0).alias("x"), ((i * 53) % 997 * F.when(i % 4 == 0, 0.0).otherwise(1.5)).alias("y"),
        (i * 37 % 11).alias("few"), F.lit(4.0).alias("same"),
        F.concat(F.lit("k"), F.floor(F.sqrt(i * 11 % 200))).alias("kind"), F.when(i % 7 < 2, "p").when(i % 7 < 6, "q").alias("side"),
    )
    label = F.coalesce("x", F.lit(50.0)) / 9 + F.col("few") * F.length("kind") * 20 + F.when(F.col("side") == "p", F.col("y")).otherwise(-F.col("y") / 3)
    return frame.withColumns({"_label": label.cast("double"), "_fold": F.pmod(F.hash("x", "y"), F.lit(3))}).persist()


@pytest.fixture(scope="module")
def coded(given):
    inputs = given.select(*NUMBERS, *CATEGORIES)
    fills = [features.Fill(c, "mean", 12.5) for c in NUMBERS]
    stages = training.preparation(inputs, CATEGORIES, fills).fit(inputs)
    design = Design(NUMBERS, dict(zip(CATEGORIES, training._labels(stages), strict=True)), ["x"])
    packed = rows_of(stages.transform(given), {c: number(given, c) for c in NUMBERS}, {c: F.col(f"_i_{c}") for c in CATEGORIES}, F.col("_label"), F.col("_fold"))
    coding, blocks = training._coded(packed, design, given, given.count(), stages, fills, 32, 7)
    return coding, blocks, stages.transform(given).select("_features", "_label").persist(), (packed, design, stages, fills)


def predicted(model, ready):
    return np.array([r[PREDICTION] for r in model.transform(ready).collect()])


def estimators():
    return [
        GBTRegressor(maxIter=10, maxDepth=4, seed=1, **COLUMNS), GBTRegressor(maxIter=3, maxDepth=7, stepSize=0.5, seed=1, **COLUMNS),
        GBTRegressor(maxIter=1, maxDepth=1, seed=1, **COLUMNS), RandomForestRegressor(numTrees=2, maxDepth=6, bootstrap=False, featureSubsetStrategy="all", seed=1, **COLUMNS),
    ]


@pytest.mark.parametrize("which", range(4))
def test_trees_equal_those_of_spark(coded, which):
    """Without random draws, and with a sample of all rows, they are the same but for rounding."""
    coding, blocks, ready, _ = coded
    estimator = estimators()[which]
    grown = trees.grow(blocks, coding, trees.growth(estimator, {}))
    mine, theirs = trees.as_model(grown, coding, estimator), estimator.fit(ready)
    a, b = predicted(mine, ready), predicted(theirs, ready)
    assert a == pytest.approx(b, rel=1e-9, abs=1e-9) and len(np.unique(a)) > 1
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-4)  # equal gains of two features may fall either way
    count, error = trees.squared_error(blocks, coding, grown)
    label = np.array([r[0] for r in ready.select("_label").collect()])
    assert (count, error) == (6000, pytest.approx(((a - label) ** 2).sum()))


def test_a_forest_is_as_good_as_sparks(coded):
    """Draws differ, so errors are compared over several seeds."""
    coding, blocks, ready, _ = coded
    errors = [[], []]
    for seed in range(5):
        estimator = RandomForestRegressor(numTrees=20, maxDepth=5, seed=seed, **COLUMNS)
        models = trees.as_model(trees.grow(blocks, coding, trees.growth(estimator, {})), coding, estimator), estimator.fit(ready)
        for own, model in zip(errors, models, strict=True):
            own.append(model.transform(ready).select(F.sqrt(F.avg((F.col(PREDICTION) - F.col("_label")) ** 2))).first()[0])
    assert np.mean(errors[0]) == pytest.approx(np.mean(errors[1]), rel=0.1) and len(set(errors[0])) == 5


def test_a_held_fold_sets_nothing(given, coded):
    """Another target and other numbers in a fold change no tree that is grown without it."""
    packed, design, stages, fills = coded[3]
    held = F.col("_fold") == 1
    other = given.withColumns({"_label": F.when(held, -9e9).otherwise(F.col("_label")), "y": F.when(held, 7e7).otherwise(F.col("y"))})
    changed = rows_of(stages.transform(other), {c: number(other, c) for c in NUMBERS}, {c: F.col(f"_i_{c}") for c in CATEGORIES}, F.col("_label"), F.col("_fold"))
    found = []
    for table, frame in ((packed, given), (changed, other)):
        known = frame.filter(~held)
        coding, blocks = training._coded(table, design, known, known.count(), stages, fills, 32, 7, 1)
        assert blocks.filter("NOT held").agg(F.sum("rows")).first()[0] == known.count()
        assert blocks.filter("held").agg(F.sum("rows")).first()[0] == 6000 - known.count()
        grown = trees.grow(blocks.filter("NOT held"), coding, trees.growth(estimators()[1], {}))
        found.append([t.values for _, t in grown])
    assert np.allclose(found[0], found[1], rtol=1e-12)


def test_small_passes_and_sums_added_in_tasks_give_the_same_trees(coded, monkeypatch):
    coding, blocks, _, _ = coded
    estimator = RandomForestRegressor(numTrees=5, maxDepth=4, seed=3, **COLUMNS)
    asked = trees.growth(estimator, {})
    usual = [t.values for _, t in trees.grow(blocks, coding, asked)]
    monkeypatch.setattr(trees, "PASS_BYTES", 1)
    monkeypatch.setattr(trees, "GATHERED_BYTES", 0)
    monkeypatch.setattr(trees, "PIECE", 100)
    assert np.allclose(usual, [t.values for _, t in trees.grow(blocks, coding, asked)], rtol=1e-12)


def test_only_known_parameters_are_grown():
    assert trees.growth(GBTRegressor(maxIter=5, maxDepth=3, seed=2), {}) == trees.Growth(5, 3, 32, 2, rate=0.1)
    forest = trees.growth(RandomForestRegressor(seed=2), {})
    assert forest == trees.Growth(20, 5, 32, 2, share=1 / 3, weighted=True)
    for unusual in (
        GBTRegressor(lossType="absolute"), GBTRegressor(subsamplingRate=0.5), GBTRegressor(weightCol="w"), GBTRegressor(maxDepth=9), GBTRegressor(minInstancesPerNode=9),
        GBTRegressor(validationIndicatorCol="v"), GBTRegressor(leafCol="l"), RandomForestRegressor(featureSubsetStrategy="sqrt"), RandomForestRegressor(minInfoGain=0.1),
    ):
        assert trees.growth(unusual, {}) is None
    estimator = GBTRegressor(seed=2)
    assert trees.growth(estimator, {estimator.minInfoGain: 0.5}) is None and trees.growth(estimator, {estimator.maxDepth: 2}).depth == 2


def test_wide_categories_and_constant_targets(spark):
    """More categories than a byte tells apart, each with a target of its own; and nothing to split."""
    frame = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 300).alias("kind"), (F.col("id") % 2).alias("x"), (F.col("id") % 300 * 5.0).alias("spend"))
    found = training.train(frame, "spend", ["kind"], grid=lambda *a: training.default_grid(*a)[-1:])
    scored = training.score(frame, found.model, found.signature, keep=["spend"])
    assert training.evaluate(scored, "spend").first().r2 > 0.95
    flat = training.train(frame.withColumn("spend", F.lit(0.1)), "spend", ["kind"], grid=lambda *a: training.default_grid(*a)[-2:])
    assert [r.rmse for r in flat.metrics.collect()] == pytest.approx([0, 0], abs=1e-9)
    assert flat.model.stages[-1].totalNumNodes in (10, 20)


def test_training_grows_its_trees_over_blocks(spark, given, monkeypatch, tmp_path):
    """The usual candidates need no fit of Spark's trees; the errors are those of Spark's fits, and the model is saved as any other."""
    frame = given.drop("_fold").withColumnRenamed("_label", "spend")
    with monkeypatch.context() as m:
        m.setattr(trees, "growth", lambda *a: None)
        by_spark = training.train(frame, "spend", CATEGORIES)

    def refused(*args):
        raise AssertionError("fitted by Spark")

    for kind in (GBTRegressor, RandomForestRegressor):
        monkeypatch.setattr(kind, "_fit", refused)
    result = training.train(frame, "spend", CATEGORIES)
    errors = [{r.trial: r.rmse for r in t.metrics.collect()} for t in (result, by_spark)]
    assert errors[0][4] == pytest.approx(errors[1][4], rel=1e-9) and errors[0][3] == pytest.approx(errors[1][3], rel=0.2)
    assert result.metrics.filter("best").first().estimator == "GBTRegressor"
    models = training.ModelStore(TableStore(spark, str(tmp_path)))
    models.save("trees", result)
    model, signature = models.load("trees")
    scored = [training.score(frame, m, signature, keep=["spend"]) for m in (model, result.model, by_spark.model)]
    assert rows(scored[0]) == rows(scored[1])
    assert [r.rmse for s in scored[1:] for r in training.evaluate(s, "spend").collect()] == pytest.approx([training.evaluate(scored[2], "spend").first().rmse] * 2, rel=1e-9)
