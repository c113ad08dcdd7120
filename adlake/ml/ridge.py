"""Ridge regression from fold statistics.

One pass gathers, for each fold, the sums of products of all pairs of inputs, target and constant. Sums of
folds add up, so a model that leaves a fold out, and its error on that fold, need no further pass:
the system of equations comes from the sums of the other folds, the squared error from those of the fold itself. Missing numbers stay
apart from zeros by a mark of their own, so every fold is filled with values learnt without it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.ml.blocks import Rows

#: Rows of one product, few enough that it stays in the task's own thread.
SLICE_ROWS = 256
#: A standard deviation below this part of the mean counts as none.
FLAT = 1e-9


@dataclass(frozen=True)
class Design:
    """Inputs of a linear model: numbers (some with missing values) and the labels of categories."""

    numbers: Sequence[str]
    labels: Mapping[str, Sequence[object]]
    missing: Sequence[str] = ()

    @property
    def width(self) -> int:
        return len(self.numbers) + len(self.missing) + sum(len(v) for v in self.labels.values())

    def columns(self, frame: DataFrame, target: str) -> list[Column]:
        """Numbers (0 where missing), marks of missing ones, a column a label, the constant and the target."""
        values = [number(frame, c) for c in self.numbers]
        marks = [number(frame, c).isNull().cast("double") for c in self.missing]
        hot = [F.col(f"`{c}`").eqNullSafe(F.lit(label)).cast("double") for c, labels in self.labels.items() for label in labels]
        return [*[F.coalesce(v, F.lit(0.0)) for v in values], *marks, *hot, F.lit(1.0), F.col(f"`{target}`").cast("double")]

    def filled(self, moments: np.ndarray, fills: Mapping[str, float]) -> np.ndarray:
        """The moments with missing numbers filled; the marks are left out."""
        n, m = len(self.numbers), len(self.missing)
        size = moments.shape[0]
        chosen = np.zeros((size - m, size))
        chosen[:n, :n] = np.eye(n)
        chosen[n:, n + m :] = np.eye(size - n - m)
        for k, c in enumerate(self.missing):
            chosen[list(self.numbers).index(c), n + k] = fills[c]
        return chosen @ moments @ chosen.T


def number(frame: DataFrame, name: str) -> Column:
    """A numeric or date-time column as double, dates as days; NaN is missing."""
    if isinstance(frame.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(F.col(f"`{name}`").cast("date")).cast("double")
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def fold_moments(frame: DataFrame, design: Design, target: str, fold: str) -> dict[int, np.ndarray]:
    """Per fold the sums of products of all pairs of the design's columns; one pass, one row a fold and task to the driver."""
    columns = design.columns(frame, target)
    size = len(columns)
    known = F.coalesce(columns[-1], F.lit(0.0))  # a missing target adds nothing
    rows = frame.select(F.col(fold).cast("int").alias("_fold"), *[c.alias(f"_z{i}") for i, c in enumerate([*columns[:-1], known])])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            folds, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield np.column_stack(values), folds

    return _products(rows, tables, size)


def block_moments(rows: Rows, design: Design) -> dict[int, np.ndarray]:
    """The moments of :func:`fold_moments` of rows in blocks, whose categories are numbered in the order of the design's labels."""
    missing = [list(rows.numbers).index(c) for c in design.missing]
    counts, read, size = [len(v) for v in design.labels.values()], rows.reader(), design.width + 2

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for numbers, categories, target, folds in read(batches):
            gaps = [np.isnan(numbers[i]) for i in missing]
            filled = list(numbers)
            for i, gap in zip(missing, gaps, strict=True):
                filled[i] = np.where(gap, 0.0, numbers[i])
            hot = [named == label for named, count in zip(categories, counts, strict=True) for label in range(count)]
            yield np.array([*filled, *gaps, *hot, np.ones(len(target)), target]).T, folds

    return _products(rows.table, tables, size)


def _products(frame: DataFrame, tables: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], size: int) -> dict[int, np.ndarray]:
    """Sums of products of all pairs of columns by fold, of what the frame's batches hold as tables and folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for table, folds in tables(batches):
            for k in np.unique(folds).tolist():
                part = table[folds == k]
                for a in range(0, len(part), SLICE_ROWS):
                    found[k] = found.get(k, 0.0) + part[a : a + SLICE_ROWS].T @ part[a : a + SLICE_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([m.tobytes() for m in found.values()], pa.binary())], ["fold", "sums"])

    moments: dict[int, np.ndarray] = {}
    for row in frame.mapInArrow(run, "fold int, sums binary").collect():
        moments[row["fold"]] = moments.get(row["fold"], 0.0) + np.frombuffer(row["sums"]).reshape(size, size)
    return dict(sorted(moments.items()))


def solve(moments: np.ndarray, strength: float) -> np.ndarray:
    """Coefficients and intercept from moments that end in constant and target.

    The penalty is on inputs and target in units of their standard deviation. Inputs without spread get none. Without a
    penalty, inputs that depend on each other share the least coefficients.
    """
    k = len(moments) - 2
    rows = moments[k, k]
    mean = moments[k, :k] / rows
    level = moments[k, k + 1] / rows
    covariance = moments[:k, :k] / rows - np.outer(mean, mean)
    with_target = moments[:k, k + 1] / rows - mean * level
    spread = np.sqrt(np.maximum(np.diag(covariance), 0.0))
    spread_of_target = math.sqrt(max(moments[k + 1, k + 1] / rows - level**2, 0.0))
    used = np.flatnonzero(spread > FLAT * (1.0 + np.abs(mean)))
    weights = np.zeros(k + 1)
    if len(used) and spread_of_target > 0:
        scale = spread[used]
        matrix = covariance[np.ix_(used, used)] / np.outer(scale, scale) + strength / spread_of_target * np.eye(len(used))
        weights[used] = np.linalg.lstsq(matrix, with_target[used] / scale, rcond=1e-11)[0] / scale
    weights[k] = level - mean @ weights[:k]
    return weights


def squared_error(moments: np.ndarray, weights: np.ndarray) -> float:
    """Sum of squared errors over the rows behind the moments."""
    v = np.append(weights, -1.0)
    return max(float(v @ moments @ v), 0.0)


def fold_errors(moments: Mapping[int, np.ndarray], design: Design, strengths: Sequence[float], fills: Mapping[int, Mapping[str, float]] | None = None) -> list[tuple[float, int, int, float]]:
    """strength, fold, rows and RMSE of the fold under the model of all other folds. fills: per fold, learnt from the others."""
    out = []
    for fold, own in moments.items():
        given = (fills or {}).get(fold, {})
        others = sum(m for f, m in moments.items() if f != fold)
        if np.isscalar(others):
            raise ValueError("one fold can't be predicted from others")
        train, held = design.filled(others, given), design.filled(own, given)
        rows = held[-2, -2]
        out += [(s, fold, int(rows), math.sqrt(squared_error(held, solve(train, s)) / rows)) for s in strengths]
    return out
