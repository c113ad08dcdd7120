"""Spend regression: cross-validated training, versioned models and scoring."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.fixed import PREDICTION, TRAINING_SEED
from adlake.ml import trees
from adlake.ml.blocks import BLOCKS_AT_ONCE, Rows, rows_of
from adlake.ml.features import DATETIME, DateState, Fill, fit_dates, fit_impute, hash_share
from adlake.ml.ridge import Design, block_moments, fold_errors, number
from adlake.session import OPEN_FILES, OPEN_FILES_SETTING, materialize, setting
from adlake.sources.tables import TableStore

LABEL = "_label"
EPOCH = date(1970, 1, 1).toordinal()
MODELS = "models/versions"
_LISTED = "name string, version int, path string"
#: Widest linear design whose candidates are compared by fold statistics, which take the square of it in sums.
WIDEST_DESIGN = 64
SAFE_UPCASTS = {"tinyint", "smallint", "int", "bigint", "float", "double"}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    signature: list[tuple[str, str]]
    metrics: DataFrame
    dates: DateState | None = None


def signature_of(frame: DataFrame, columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(c, frame.schema[c].dataType.simpleString()) for c in columns]


def check_signature(frame: DataFrame, signature: Sequence[tuple[str, str]]) -> list[str]:
    """How the frame differs from the signature in names, types or order; empty when it fits."""
    actual = [(f.name, f.dataType.simpleString()) for f in frame.schema]
    wanted = list(signature)
    if actual == wanted:
        return []
    problems = [f"missing {n}" for n, _ in wanted if n not in dict(actual)]
    problems += [f"unexpected {n}" for n, _ in actual if n not in dict(wanted)]
    problems += [
        f"{n} is {t}, expected {dict(wanted)[n]}" for n, t in actual if n in dict(wanted) and dict(wanted)[n] != t
    ]
    return problems or ["columns are out of order"]


def to_signature(frame: DataFrame, signature: Sequence[tuple[str, str]]) -> DataFrame:
    """Select the signature's columns in order, widening numbers where that is safe."""
    columns = []
    for name, kind in signature:
        if name not in frame.columns:
            raise ValueError(f"scoring input lacks column {name}")
        have = frame.schema[name].dataType
        numeric = have.simpleString() in SAFE_UPCASTS or isinstance(have, T.DecimalType)
        if have.simpleString() != kind and not (numeric and kind == "double"):
            raise ValueError(f"{name} is {have.simpleString()}, the model expects {kind}")
        columns.append(F.col(name).cast(kind).alias(name))
    return frame.select(*columns)


def _sql_literal(value: object) -> str:
    return repr(float(value))


def _numeric_stage(frame: DataFrame, inputs: Sequence[str], fills: Mapping[str, Fill]) -> SQLTransformer:
    """Every numeric or date-time input as a filled double, saved as part of the model. Dates count days."""
    parts = []
    for name in inputs:
        value = f"`{name}`"
        fill = fills[name].value
        if isinstance(frame.schema[name].dataType, DATETIME):
            day = "NULL" if fill is None else f"date'{fill:%Y-%m-%d}'"
            parts.append(f"double(coalesce(unix_date(coalesce(date({value}), {day})), 0)) AS `_f_{name}`")
            continue
        parts.append(f"coalesce(nanvl(double({value}), NULL), {_sql_literal(fill or 0.0)}) AS `_f_{name}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def default_grid(pipeline: Pipeline, seed: int, bins: int = 32) -> list[dict]:
    """Candidates: regularised linear models over one-hot categories, a random forest and boosted trees over indexed ones.

    bins: at least the categories of the widest column.
    """
    shared = {"featuresCol": "_features", "labelCol": LABEL, "predictionCol": PREDICTION}
    linear = LinearRegression(**{**shared, "featuresCol": "_wide"})
    forest = RandomForestRegressor(seed=seed, numTrees=20, maxBins=bins, **shared)
    boosted = GBTRegressor(seed=seed, maxIter=10, maxBins=bins, **shared)

    def candidates(estimator, param, values) -> list[dict]:
        return ParamGridBuilder().baseOn({pipeline.stages: [estimator]}).addGrid(param, values).build()

    return (
        candidates(linear, linear.regParam, [0.0, 0.1, 1.0])
        + candidates(forest, forest.maxDepth, [5])
        + candidates(boosted, boosted.maxDepth, [4])
    )


def preparation(frame: DataFrame, categorical: Sequence[str], fills: Sequence[Fill]) -> Pipeline:
    """Filled numbers, indexed categories and one feature vector, as model stages."""
    by_column = {f.column: f for f in fills}
    numeric = [c for c in frame.columns if c not in categorical]
    indexed, hot = [f"_i_{c}" for c in categorical], [f"_h_{c}" for c in categorical]
    numbers = [f"_f_{c}" for c in numeric]
    stages = [_numeric_stage(frame, numeric, by_column)]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=numbers + indexed, outputCol="_features"))
    stages.append(VectorAssembler(inputCols=numbers + hot, outputCol="_wide"))
    return Pipeline(stages=stages)


def widest_category(prepared: PipelineModel) -> int:
    """Values of the column with the most categories, the one for unseen values included."""
    indexers = [s for s in prepared.stages if isinstance(s, StringIndexerModel)]
    return max([0, *(len(labels) + 1 for s in indexers for labels in s.labelsArray)])


def design_of(frame: DataFrame, inputs: Sequence[str], categorical: Sequence[str]) -> Design:
    """The linear design of a frame's inputs, from one pass over it."""
    numbers = [c for c in inputs if c not in categorical]
    seen = frame.agg(
        *[F.count_if(number(frame, c).isNull()).alias(f"m_{c}") for c in numbers],
        *[F.count_distinct(F.col(f"`{c}`")).alias(f"d_{c}") for c in categorical],
    ).first()
    missing = [c for c in numbers if seen[f"m_{c}"]]
    if len(numbers) + len(missing) + sum(seen[f"d_{c}"] for c in categorical) > WIDEST_DESIGN:
        return Design(numbers, {c: [None] * seen[f"d_{c}"] for c in categorical}, missing)  # too wide: only its width counts
    labels = {c: [r[0] for r in frame.select(F.col(f"`{c}`").alias("v")).distinct().filter("v is not null").orderBy("v").collect()] for c in categorical}
    return Design(numbers, labels, missing)


def _plain_ridge(candidate: Mapping, estimator) -> float | None:
    """The strength of a candidate that is ridge regression and nothing else."""
    if not isinstance(estimator, LinearRegression) or estimator.getElasticNetParam() or estimator.getLoss() != "squaredError" or not estimator.getStandardization():
        return None
    others = [p for p in candidate if p.parent == estimator.uid and p.name != "regParam"]
    return None if others else float(next((v for p, v in candidate.items() if p.parent == estimator.uid), estimator.getRegParam()))


def train(
    frame: DataFrame,
    target: str,
    categorical: Sequence[str] = (),
    folds: int = 3,
    trials: int = 10,
    parallelism: int = 3,
    seed: int = TRAINING_SEED,
    metric: str = "rmse",
    grid=default_grid,
    dates_along: tuple[Sequence[str], Sequence[str]] | None = None,
) -> Trained:
    """Cross-validate the candidates and keep the best one's refit.

    A grid of more than `trials` candidates is refused, as leaving some out would choose in silence. Rows without a target are
    left out. Folds are set by row hash, so a recomputed partition keeps its fold. What a fold is predicted with, fills and
    categories included, is learnt from the other folds alone. Ridge candidates over few enough columns are compared by
    statistics of the folds, which one pass gathers for all of them; other candidates are fitted for each fold, forests and
    boosted trees of usual parameters by :mod:`adlake.ml.trees`.

    dates_along: columns of groups and of the order within them, along which gaps in date-time inputs take the last known
    value; the most frequent value fills what is left. These columns are inputs only where they are categories. A row's
    earlier rows are known when it is scored, whatever their fold, so they fill it in every fold.
    """
    rows = frame.filter(F.col(target).isNotNull())
    dates = None
    along = [*dates_along[0], *dates_along[1]] if dates_along else []
    inputs = [c for c in frame.columns if c != target and (c not in along or c in categorical)]
    if dates_along:
        dates = fit_dates(rows.select(*[c for c in frame.columns if c in along or c in inputs]), *dates_along)
        rows = dates.apply(rows)
    numeric = [c for c in inputs if c not in categorical]
    labelled = rows.withColumns({LABEL: F.col(target).cast("double"), "_fold": hash_share(frame.columns, seed, folds).cast("int")})
    labelled = materialize(labelled.select(*inputs, LABEL, "_fold"), "labelled")
    given = labelled.select(*inputs)
    known_fills = fit_impute(given.select(*numeric))
    prepared = preparation(given, categorical, known_fills).fit(given)

    pipeline = Pipeline(stages=[])
    candidates = grid(pipeline, seed, max(32, widest_category(prepared)))
    if len(candidates) > trials:
        raise ValueError(f"{len(candidates)} candidates for at most {trials} trials")
    estimators = [c[pipeline.stages][-1] for c in candidates]
    strengths = [_plain_ridge(c, e) for c, e in zip(candidates, estimators, strict=True)]
    design = Design(numeric, dict(zip(categorical, _labels(prepared), strict=True)), _with_gaps(labelled, numeric))
    by_sums = {i: s for i, s in enumerate(strengths) if s is not None and metric == "rmse" and design.width <= WIDEST_DESIGN}
    learnt = {k: _fold_fills(labelled, k, numeric, design.missing, len(by_sums) < len(candidates)) for k in range(folds)}

    measured: dict[int, list[float]] = {i: [] for i in range(len(candidates))}
    others = [i for i in measured if i not in by_sums]
    asked = {i: trees.growth(estimators[i], _own(candidates[i], estimators[i])) for i in others}
    asked = {i: g for i, g in asked.items() if g and metric == "rmse" and _vectors(candidates, estimators, [i]) == ["_features"]}
    fitted = [i for i in others if i not in asked]
    if by_sums or asked:
        numbers, indexed = {c: number(labelled, c) for c in numeric}, {c: F.col(f"_i_{c}") for c in categorical}
        packed = rows_of(prepared.transform(labelled), numbers, indexed, F.col(LABEL), F.col("_fold"))
    with setting(frame.sparkSession, *BLOCKS_AT_ONCE):
        if by_sums:
            moments = block_moments(packed, design)
            fills = {k: {f.column: _as_number(f.value) for f in learnt[k] if f.column in design.missing} for k in learnt}
            for strength, _, _, error in fold_errors(moments, design, sorted(set(by_sums.values())), fills):
                for i in (i for i, s in by_sums.items() if s == strength):
                    measured[i].append(error)
        evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName=metric)
        sizes = {r["_fold"]: r["count"] for r in labelled.groupBy("_fold").count().collect()} if asked else {}

        def fold_work(k: int) -> list[tuple[int, Callable[[], float]]]:
            """The fits that a fold needs, over rows prepared for it."""
            stages = preparation(given, categorical, learnt[k]).fit(labelled.filter(F.col("_fold") != k))
            work = []
            for bins in dict.fromkeys(g.bins for g in asked.values()):
                count = sum(n for f, n in sizes.items() if f != k)
                coding, blocks = _coded(packed, design, labelled.filter(F.col("_fold") != k), count, stages, learnt[k], bins, seed, k)

                def grown_error(i: int, coding: trees.Coding = coding, blocks: DataFrame = blocks) -> float:
                    grown = trees.grow(blocks.filter("NOT held"), coding, asked[i])
                    rows, error = trees.squared_error(blocks.filter("held"), coding, grown)
                    return math.sqrt(error / rows) if rows else math.nan

                work += [(i, partial(grown_error, i)) for i, g in asked.items() if g.bins == bins]
            if fitted:
                ready = materialize(stages.transform(labelled).select(*_vectors(candidates, estimators, fitted), LABEL, "_fold"), "features")

                def fitted_error(i: int) -> float:
                    model = estimators[i].fit(ready.filter(F.col("_fold") != k), _own(candidates[i], estimators[i]))
                    return float(evaluator.evaluate(model.transform(ready.filter(F.col("_fold") == k))))

                work += [(i, partial(fitted_error, i)) for i in fitted]
            return work

        if others:
            with ThreadPoolExecutor(parallelism) as pool, setting(frame.sparkSession, OPEN_FILES_SETTING, OPEN_FILES):
                work = [w for fold in pool.map(fold_work, learnt) for w in fold]
                for (i, _), value in zip(work, pool.map(lambda w: w[1](), work), strict=True):
                    measured[i].append(value)

        averages = [sum(measured[i]) / len(measured[i]) for i in range(len(candidates))]
        larger = RegressionEvaluator(metricName=metric).isLargerBetter()
        chosen = averages.index(max(averages) if larger else min(averages))
        found = [(i, type(e).__name__, m, i == chosen) for i, (e, m) in enumerate(zip(estimators, averages, strict=True))]
        metrics = frame.sparkSession.createDataFrame(found, f"trial int, estimator string, {metric} double, best boolean")
        own = _own(candidates[chosen], estimators[chosen])
        if chosen in asked:
            coding, blocks = _coded(packed, design, labelled, sum(sizes.values()), prepared, known_fills, asked[chosen].bins, seed)
            best = trees.as_model(trees.grow(blocks, coding, asked[chosen]), coding, estimators[chosen].copy(own))
        else:
            ready = materialize(prepared.transform(labelled).select(*_vectors(candidates, estimators, [chosen]), LABEL), "features")
            best = estimators[chosen].fit(ready, own)
    return Trained(PipelineModel([*prepared.stages, best]), signature_of(frame, inputs), metrics, dates)


def _own(candidate: Mapping, estimator) -> dict:
    return {p: v for p, v in candidate.items() if p.parent == estimator.uid}


def _vectors(candidates: Sequence[Mapping], estimators: Sequence, wanted: Sequence[int]) -> list[str]:
    """The feature columns that some candidates are fitted on; what no candidate reads is neither computed nor written."""
    return list(dict.fromkeys(_own(candidates[i], estimators[i]).get(estimators[i].featuresCol, estimators[i].getFeaturesCol()) for i in wanted))


def _labels(prepared: PipelineModel) -> list[Sequence[str]]:
    """The values of each category, in the order of their numbers."""
    return [labels for s in prepared.stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray]


def _with_gaps(frame: DataFrame, numbers: Sequence[str]) -> list[str]:
    seen = frame.agg(F.count("*").alias("_rows"), *[F.count(number(frame, c)).alias(f"n_{c}") for c in numbers]).first()
    return [c for c in numbers if seen[f"n_{c}"] < seen["_rows"]]


def _coded(
    rows: Rows, design: Design, known: DataFrame, count: int, prepared: PipelineModel, fills: Sequence[Fill], bins: int, seed: int, held: int | None = None
) -> tuple[trees.Coding, DataFrame]:
    """Rows as codes, set by the known ones alone. design: has the labels of the rows' categories in the order of their numbers."""
    own = [{v: i for i, v in enumerate(found)} for found in _labels(prepared)]
    orders = [np.array([*(at.get(v, len(at)) for v in design.labels[c]), len(at)], np.int32) for c, at in zip(rows.categories, own, strict=True)]
    edges = trees.sampled_edges(prepared.transform(known), [f"_f_{c}" for c in rows.numbers], count, bins, seed)
    coding = trees.coding_of([*edges, *(len(at) + 1 for at in own)])
    return coding, trees.coded(rows, coding, {f.column: _as_number(f.value) for f in fills if f.column in design.missing}, orders, held)


def _fold_fills(labelled: DataFrame, fold: int, numeric: Sequence[str], missing: Sequence[str], every: bool) -> list[Fill]:
    """Fill values of the rows outside a fold; of all columns only where a model is fitted on them, else of those with gaps."""
    columns = list(numeric) if every else list(missing)
    known = labelled.filter(F.col("_fold") != fold).select(*columns)
    gaps = [c for c in columns if c in missing]
    found = {f.column: f for f in fit_impute(known.select(*gaps))} if gaps else {}
    return [found.get(c, Fill(c, "none", None)) for c in columns]


def _as_number(value: object) -> float:
    """A fill value as the model counts it: dates as days, 0 where nothing was learnt."""
    if value is None:
        return 0.0
    if hasattr(value, "toordinal"):
        return float(value.toordinal() - EPOCH)
    return float(value)


def score(
    frame: DataFrame,
    model: PipelineModel,
    signature: Sequence[tuple[str, str]],
    output: str = PREDICTION,
    keep: Sequence[str] = (),
    dates: DateState | None = None,
) -> DataFrame:
    """The signature's columns, others asked for, and the prediction. dates: what the model fills date-times with."""
    if dates:
        frame = dates.apply(frame)
    fitted = to_signature(frame, signature)
    if keep:
        extra = [F.col(c) for c in keep if c not in dict(signature)]
        fitted = frame.select(*[F.col(n).cast(t).alias(n) for n, t in signature], *extra)
    predicted = model.transform(fitted)
    return predicted.select(*fitted.columns, F.col(PREDICTION).alias(output))


def evaluate(predicted: DataFrame, target: str, output: str = PREDICTION) -> DataFrame:
    """Row count, RMSE, MAE and R2 of predictions, in one pass."""
    truth, guess = F.col(target).cast("double"), F.col(output)
    error = truth - guess
    known = predicted.filter(truth.isNotNull() & guess.isNotNull())
    return known.agg(
        F.count("*").alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.sum(error * error) / F.nullif(F.var_pop(truth) * F.count("*"), F.lit(0.0))).alias("r2"),
    )


def fit_line(train: DataFrame, test: DataFrame, feature: str, target: str) -> tuple[tuple[float, float], DataFrame]:
    """Least-squares slope and intercept over the train rows, and the errors of that line over the test rows."""

    def known(frame: DataFrame) -> DataFrame:
        pair = frame.select(F.col(feature).cast("double").alias(feature), F.col(target).cast("double").alias(LABEL))
        return VectorAssembler(inputCols=[feature], outputCol="_features").transform(pair.na.drop())

    line = LinearRegression(featuresCol="_features", labelCol=LABEL, predictionCol=PREDICTION, regParam=0.0).fit(known(train))
    return (float(line.coefficients[0]), float(line.intercept)), evaluate(line.transform(known(test)), LABEL)


class ModelStore:
    """Saved models by name and version. The catalog table MODELS lists their folders, a row once a folder is complete."""

    def __init__(self, store: TableStore):
        self.store = store

    def versions(self, name: str) -> DataFrame:
        """version, path of a model, the newest first."""
        listed = self.store.read(MODELS) if self.store.exists(MODELS) else self.store.spark.createDataFrame([], _LISTED)
        return listed.filter(F.col("name") == name).orderBy(F.desc("version"))

    def save(self, name: str, trained: Trained) -> int:
        newest = self.versions(name).first()
        version = newest["version"] + 1 if newest else 1
        path = f"{self.store.root}/model_files/{name}/v{version}-{uuid.uuid4().hex}"
        trained.model.write().save(f"{path}/model")
        rows = [(i, n, t) for i, (n, t) in enumerate(trained.signature)]
        signature = self.store.spark.createDataFrame(rows, "place int, name string, type string")
        signature.coalesce(1).write.parquet(f"{path}/signature")
        if trained.dates:
            trained.dates.known.write.parquet(f"{path}/dates/known")
            names = [(i, role, c) for role in ("partition_by", "order_by", "columns") for i, c in enumerate(getattr(trained.dates, role))]
            self.store.spark.createDataFrame(names, "place int, role string, name string").coalesce(1).write.parquet(f"{path}/dates/names")
        kind = self.store.spark.createDataFrame([(trained.dates is not None,)], "dates boolean")
        kind.coalesce(1).write.parquet(f"{path}/kind")
        row = self.store.spark.createDataFrame([(name, version, path)], _LISTED)
        (self.store.append if self.store.exists(MODELS) else self.store.write)(row, MODELS)
        return version

    def _path(self, name: str, version: int | None) -> str:
        listed = self.versions(name)
        found = (listed if version is None else listed.filter(F.col("version") == version)).first()
        if not found:
            raise KeyError(f"no saved model {name!r}")
        return found["path"]

    def load(self, name: str, version: int | None = None) -> tuple[PipelineModel, list[tuple[str, str]]]:
        path = self._path(name, version)
        rows = self.store.spark.read.parquet(f"{path}/signature").orderBy("place").collect()
        return PipelineModel.load(f"{path}/model"), [(r["name"], r["type"]) for r in rows]

    def dates(self, name: str, version: int | None = None) -> DateState | None:
        """What a saved model fills date-times with; None where it was trained without."""
        path, read = self._path(name, version), self.store.spark.read.parquet
        if not read(f"{path}/kind").first()["dates"]:
            return None
        names = read(f"{path}/dates/names").orderBy("place").collect()
        roles = {role: tuple(r["name"] for r in names if r["role"] == role) for role in ("partition_by", "order_by", "columns")}
        return DateState(**roles, known=read(f"{path}/dates/known"))


def manual_rows(spark: SparkSession, rows: Sequence[tuple], signature: Sequence[tuple[str, str]]) -> DataFrame:
    """Hand-made scoring rows under a signature; types and non-null values are verified."""
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(t), False) for n, t in signature])
    return spark.createDataFrame(list(rows), schema)
