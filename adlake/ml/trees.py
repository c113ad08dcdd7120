"""Random forests and boosted trees, grown from sums over coded rows.

The method is Spark's: a feature has at most ``maxBins`` bins, cut by a sample of the size that Spark takes; a level of a tree is one pass that
sums target and rows per node, feature and bin; categories of a node are ordered by their mean; the forest draws Poisson weights and features per node, boosting
follows the residuals of the trees before. What differs is how rows are kept: each is coded once, two features of 32 bins to a 16-bit number, in
blocks of bytes that NumPy sums, where Spark keeps an object a row and visits it feature by feature. Random draws are others than Spark's, which depend
on partitions. The result is Spark's own model; only the impurity of its nodes, which no prediction needs, is not gathered and is NaN.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.ml.blocks import STORED, Rows
from adlake.session import materialize

BLOCK_ROWS = 32_768
#: Bits of the features that share a code: the sums of all their pairs of bins should stay in a processor's cache.
CODE_BITS = 10
DEEPEST = 8
SAMPLE_ROWS = 10_000
#: Sums of one pass in a task; trees of a forest that need more take several passes.
PASS_BYTES = 64 << 20
#: Sums of all tasks that the driver adds up; more are added in tasks first.
GATHERED_BYTES = 16 << 20
PIECE = 1 << 17
#: Part of the squared mean below which a gain is rounding.
ROUNDING = 1e-18
_BLOCKS = "held boolean, block bigint, rows int, codes binary, target binary"
_KINDS = (pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
_FREE = {"featuresCol", "labelCol", "predictionCol", "seed", "maxDepth", "maxBins", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval", "validationTol"}
_POISSON = np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)])), (np.arange(65_536) + 0.5) / 65_536).astype(np.float64)

Split = tuple[int, object]  # feature and its last bin to the left, or by bin whether it goes right
Level = dict[int, Split]  # by place in the level, from the left


@dataclass(frozen=True)
class Growth:
    """What an estimator asks for. share: of the features each node looks at; rate: None for a forest."""

    trees: int
    depth: int
    bins: int
    seed: int
    rate: float | None = None
    share: float = 1.0
    weighted: bool = False


def growth(estimator, own: Mapping) -> Growth | None:
    """The parameters of trees that can be grown here; None for other estimators, and for parameters beyond these."""
    if not isinstance(estimator, (RandomForestRegressor, GBTRegressor)):
        return None
    forest = isinstance(estimator, RandomForestRegressor)
    given = {p.name: v for p, v in estimator.extractParamMap(dict(own)).items()}
    usual = {p.name: v for p, v in type(estimator)().extractParamMap().items()}
    free = _FREE | ({"numTrees", "bootstrap", "featureSubsetStrategy"} if forest else {"maxIter", "stepSize"})
    if any(n not in free and (n not in usual or v != usual[n]) for n, v in given.items()) or not 1 <= given["maxDepth"] <= DEEPEST:
        return None
    shared = {"depth": given["maxDepth"], "bins": given["maxBins"], "seed": given["seed"]}
    if not forest:
        return Growth(given["maxIter"], rate=given["stepSize"], **shared)
    subset = {"all": 1.0, "onethird": 1 / 3, "auto": 1 / 3 if given["numTrees"] > 1 else 1.0}.get(given["featureSubsetStrategy"])
    return None if subset is None else Growth(given["numTrees"], share=subset, weighted=given["bootstrap"], **shared)


@dataclass(frozen=True)
class Coding:
    """Edges of each number or count of each category's values, and where a feature's bin stands: group, lowest bit, bits."""

    edges: Sequence[np.ndarray | int]
    places: Sequence[tuple[int, int, int]]
    groups: Sequence[int]

    @property
    def kind(self) -> type:
        return np.uint16 if max(self.groups) <= 16 else np.uint32

    def bins(self, feature: int) -> int:
        edges = self.edges[feature]
        return edges if isinstance(edges, int) else len(edges) + 1

    @property
    def all_bins(self) -> int:
        return sum(self.bins(f) for f in range(len(self.edges)))

    def pack(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Codes of some rows, a row of the result a group."""
        codes = np.zeros((len(self.groups), len(columns[0])), self.kind)
        for values, edges, (group, low, _) in zip(columns, self.edges, self.places, strict=True):
            found = values if isinstance(edges, int) else np.searchsorted(edges, values, "left")
            codes[group] |= found.astype(self.kind) << low
        return codes

    def digits(self, codes: np.ndarray) -> Callable[[int], np.ndarray]:
        """The bins of a feature in some codes, cut out once."""
        found: dict[int, np.ndarray] = {}

        def of(feature: int) -> np.ndarray:
            if feature not in found:
                group, low, bits = self.places[feature]
                cut = (codes[group] >> low) & ((1 << bits) - 1)
                found[feature] = cut.astype(np.uint8) if bits <= 8 else cut
            return found[feature]

        return of


def coding_of(edges: Sequence[np.ndarray | int]) -> Coding:
    places, groups = [], []
    for e in edges:
        bits = ((e if isinstance(e, int) else len(e) + 1) - 1).bit_length()
        if not groups or groups[-1] + bits > CODE_BITS:
            groups.append(0)
        places.append((len(groups) - 1, groups[-1], bits))
        groups[-1] += bits
    return Coding(edges, places, groups)


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of a number from a sample of it: halfway between neighbours, all of them or where counts come closest to equal parts."""
    found, uses = np.unique(values, return_counts=True)
    halfway = (found[:-1] + found[1:]) / 2
    if len(halfway) < bins:
        return halfway
    stride = len(values) / bins
    chosen, target, reached = [], stride, np.cumsum(uses)
    for i in range(1, len(found)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            chosen.append(halfway[i - 1])
            target += stride
    return np.array(chosen)


def sampled_edges(frame: DataFrame, numbers: Sequence[str], rows: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of all numbers, each found in a task of its own."""
    wanted = max(bins * bins, SAMPLE_ROWS)
    taken = frame if rows <= wanted else frame.sample(wanted / rows, seed)
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(numbers)]))

    def find(key: tuple, table: pa.Table) -> pa.Table:
        edges = edges_of(table["value"].to_numpy(), bins)
        return pa.table({"place": pa.array([key[0].as_py()], pa.int32()), "edges": pa.array([edges.tolist()], pa.list_(pa.float64()))})

    found = {r.place: r.edges for r in taken.select(cells).groupBy("place").applyInArrow(find, "place int, edges array<double>").collect()} if numbers else {}
    return [np.array(found.get(i, []), np.float64) for i in range(len(numbers))]


def coded(rows: Rows, coding: Coding, fills: Mapping[str, float], orders: Sequence[np.ndarray], held: int | None) -> DataFrame:
    """Rows as blocks of codes, those of a held fold apart, written once. orders: what each category's numbers are here."""
    filled, read = [fills.get(c) for c in rows.numbers], rows.reader()

    def columns(numbers: np.ndarray, categories: np.ndarray) -> list[np.ndarray]:
        whole = [v if fill is None else np.where(np.isnan(v), fill, v) for v, fill in zip(numbers, filled, strict=True)]
        return [*whole, *[order[named] for order, named in zip(orders, categories, strict=True)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list] = {False: [], True: []}

        def full(side: bool, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal block
            count = sum(len(y) for _, y in waiting[side])
            if count < least:
                return
            codes, values = np.concatenate([c for c, _ in waiting[side]], axis=1), np.concatenate([y for _, y in waiting[side]])
            end = count if least == 1 else count - count % BLOCK_ROWS
            for a in range(0, end, BLOCK_ROWS):
                part = values[a : min(a + BLOCK_ROWS, end)]
                cells = [side, block, len(part), codes[:, a : a + len(part)].tobytes(), part.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, _KINDS, strict=True)], ["held", "block", "rows", "codes", "target"])
                block += 1
            waiting[side] = [(codes[:, end:], values[end:])] if end < count else []

        for numbers, categories, target, fold in read(batches):
            codes, apart = coding.pack(columns(numbers, categories)), fold == held
            for side in (False, True):
                own = apart == side
                if own.any():
                    waiting[side].append((codes[:, own], target[own]))
                    yield from full(side, BLOCK_ROWS)
        for side in (False, True):
            yield from full(side, 1)

    return materialize(rows.table.mapInArrow(run, _BLOCKS), "coded", ["held"], **STORED)


Block = tuple[int, np.ndarray, np.ndarray]


def summed(blocks: DataFrame, coding: Coding, size: int, work: Callable[[Iterable[Block]], np.ndarray]) -> np.ndarray:
    """The sum of what tasks find in their blocks, each ``size`` numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            for block, rows, codes, target in zip(*[batch.column(i) for i in range(4)], strict=True):
                cells = np.frombuffer(codes.as_buffer(), coding.kind).reshape(len(coding.groups), rows.as_py())
                yield block.as_py(), cells, np.frombuffer(target.as_buffer(), np.float64)

    def packed(piece: Sequence[int], sums: Sequence[bytes]) -> list[pa.Array]:
        return [pa.array(piece, pa.int32()), pa.array(sums, pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(read(batches))
        cuts = range(0, size, PIECE)
        yield pa.RecordBatch.from_arrays(packed(range(len(cuts)), [found[a : a + PIECE].tobytes() for a in cuts]), ["piece", "sums"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table["sums"])
        return pa.Table.from_arrays(packed([key[0].as_py()], [total.tobytes()]), ["piece", "sums"])

    parts = blocks.select("block", "rows", "codes", "target").mapInArrow(run, "piece int, sums binary")
    if 8 * size * blocks.rdd.getNumPartitions() > GATHERED_BYTES:
        parts = parts.groupBy("piece").applyInArrow(add, parts.schema)
    total = np.zeros(size)
    for row in parts.collect():
        total[row.piece * PIECE :][:PIECE] += np.frombuffer(row.sums, np.float64)
    return total


def _places(levels: Sequence[Level], digit: Callable[[int], np.ndarray], rows: int) -> np.ndarray:
    """Each row's place, from the left, below some levels of a tree. What is not split goes left."""
    place = np.zeros(rows, np.uint8)
    for depth, level in enumerate(levels):
        right = np.zeros(rows, bool)
        for at, (feature, cut) in level.items():
            goes = digit(feature) > cut if isinstance(cut, int) else cut[digit(feature)]
            right |= goes & (place == at) if depth else goes
        place = (place << 1) | right
    return place


class _Sums:
    """Rows and targets per place and bin of the features that a pass looks at."""

    def __init__(self, coding: Coding, places: int, wanted: Iterable[int]):
        self.coding, self.places = coding, places
        groups = {coding.places[f][0] for f in wanted}
        self.cells = {g: np.zeros((2, places << coding.groups[g])) for g in groups}

    def add(self, codes: np.ndarray, place: np.ndarray, target: np.ndarray, weights: np.ndarray | None = None) -> None:
        wide = place.astype(np.intp)
        for g, cells in self.cells.items():
            at = codes[g] + (wide << self.coding.groups[g]) if self.places > 1 else codes[g].astype(np.intp)
            cells[0] += np.bincount(at, weights, cells.shape[1])
            cells[1] += np.bincount(at, target, cells.shape[1])

    def by_feature(self) -> np.ndarray:
        out = np.zeros((2, self.places, self.coding.all_bins))
        start = 0
        for f, (group, low, bits) in enumerate(self.coding.places):
            own = self.coding.bins(f)
            if group in self.cells:
                apart = self.cells[group].reshape(2, self.places, -1, 1 << bits, 1 << low)
                out[:, :, start : start + own] = apart.sum(axis=(2, 4))[:, :, :own]
            start += own
        return out.ravel()


def _best(cells: np.ndarray, coding: Coding, wanted: Sequence[int]) -> tuple[float, Split, tuple, tuple] | None:
    """Gain, split and both children (rows, sum) of the best split of a node; None where none gains."""
    best = None
    starts = np.cumsum([0, *(coding.bins(f) for f in range(len(coding.edges)))])
    for f in wanted:
        rows, sums = cells[:, starts[f] : starts[f + 1]]
        if len(rows) < 2:
            continue
        order = None
        if isinstance(coding.edges[f], int):
            means = np.divide(sums, rows, out=np.full(len(rows), np.inf), where=rows > 0)
            order = np.argsort(means, kind="stable")
            rows, sums = rows[order], sums[order]
        n, s = rows.sum(), sums.sum()
        if n <= 0:
            continue
        left, total = np.cumsum(rows)[:-1], np.cumsum(sums - s / n * rows)[:-1]
        valid = (left >= 1) & (n - left >= 1)
        gains = np.divide(total * total * n, left * (n - left), out=np.full(len(left), -1.0), where=valid) / n
        at = int(gains.argmax())
        if gains[at] > ROUNDING * (s / n) ** 2 and (best is None or gains[at] > best[0]):
            cut: object = at
            if order is not None:
                cut = np.ones(len(rows), bool)
                cut[order[: at + 1]] = False
            near = (float(left[at]), float(sums[: at + 1].sum()))
            best = (float(gains[at]), (f, cut), near, (float(n) - near[0], float(s) - near[1]))
    return best


class Tree:
    """A tree under growth: levels of splits, and rows, sum and gain of its nodes by level and place."""

    def __init__(self, depth: int):
        self.depth = depth
        self.levels: list[Level] = []
        self.nodes: dict[tuple[int, int], tuple[float, float]] = {}
        self.gains: dict[tuple[int, int], float] = {}

    def open(self) -> list[int]:
        """Places of the next level that may still be split."""
        level = len(self.levels)
        if level == 0:
            return [0]
        return [c for p in self.levels[-1] for c in (2 * p, 2 * p + 1)] if level < self.depth else []

    def grow(self, found: np.ndarray, coding: Coding, wanted: Mapping[int, Sequence[int]]) -> None:
        level, splits = len(self.levels), {}
        for place, features in wanted.items():
            cells = found[:, place]
            if level == 0:
                own = slice(sum(coding.bins(f) for f in range(features[0])), None)
                self.nodes[0, 0] = tuple(float(cells[k, own][: coding.bins(features[0])].sum()) for k in (0, 1))
            best = _best(cells, coding, features)
            if best:
                self.gains[level, place], splits[place], self.nodes[level + 1, 2 * place], self.nodes[level + 1, 2 * place + 1] = best
        self.levels.append(splits)

    def value(self, level: int, place: int) -> float:
        rows, total = self.nodes[level, place]
        return total / rows if rows else 0.0

    @property
    def values(self) -> np.ndarray:
        """Predictions by place below the last level."""
        out = np.zeros(1 << len(self.levels))
        for level, place in sorted(self.nodes):
            out[place << (len(self.levels) - level)] = self.value(level, place)
        return out

    @property
    def plain(self) -> tuple:
        return self.levels, self.values


def _guess(trees: Sequence[tuple], digit: Callable[[int], np.ndarray], rows: int) -> np.ndarray:
    """The sum of the predictions of weighted trees."""
    total = np.zeros(rows)
    for weight, (levels, values) in trees:
        total += (weight * values)[_places(levels, digit, rows)]
    return total


def boosted(blocks: DataFrame, coding: Coding, asked: Growth) -> list[tuple[float, Tree]]:
    """Trees, each fitted to twice the residuals of those before, as squared error asks for."""
    grown: list[tuple[float, Tree]] = []
    features = range(len(coding.edges))
    for k in range(asked.trees):
        tree = Tree(asked.depth)
        before = [(w, t.plain) for w, t in grown]
        while tree.open():
            levels, places = tree.levels, 1 << len(tree.levels)

            def work(given: Iterable[Block], levels=levels, places=places, before=before) -> np.ndarray:
                sums = _Sums(coding, places, features)
                for _, codes, target in given:
                    digit = coding.digits(codes)
                    rest = 2.0 * (target - _guess(before, digit, len(target))) if before else target
                    sums.add(codes, _places(levels, digit, len(target)), rest)
                return sums.by_feature()

            found = summed(blocks, coding, 2 * places * coding.all_bins, work).reshape(2, places, -1)
            tree.grow(found, coding, {p: features for p in tree.open()})
        grown.append((asked.rate if k else 1.0, tree))
    return grown


def forest(blocks: DataFrame, coding: Coding, asked: Growth) -> list[tuple[float, Tree]]:
    """Trees over rows of Poisson weights, each node split by features of its own draw. A level of all trees is one pass."""
    trees = [Tree(asked.depth) for _ in range(asked.trees)]
    draw = np.random.default_rng(asked.seed % (1 << 63))
    count = int(np.ceil(asked.share * len(coding.edges)))
    for level in range(asked.depth):
        places = 1 << level
        wanted = {i: {p: sorted(draw.choice(len(coding.edges), count, replace=False).tolist()) for p in t.open()} for i, t in enumerate(trees) if t.open()}
        at_once = max(1, PASS_BYTES // (16 * places * sum(1 << g for g in coding.groups)))
        for a in range(0, len(wanted), at_once):
            chosen = list(wanted)[a : a + at_once]
            given_trees = [(i, trees[i].levels, sorted({f for fs in wanted[i].values() for f in fs})) for i in chosen]

            def work(given: Iterable[Block], given_trees=given_trees, places=places) -> np.ndarray:
                sums = [_Sums(coding, places, features) for _, _, features in given_trees]
                for block, codes, target in given:
                    digit = coding.digits(codes)
                    for own, (i, levels, _) in zip(sums, given_trees, strict=True):
                        weights = None
                        if asked.weighted:
                            random = np.random.Generator(np.random.SFC64([asked.seed % (1 << 63), i, block]))
                            weights = _POISSON[random.integers(0, 65_536, len(target), np.uint16)]
                        own.add(codes, _places(levels, digit, len(target)), target if weights is None else target * weights, weights)
                return np.concatenate([s.by_feature() for s in sums])

            found = summed(blocks, coding, len(chosen) * 2 * places * coding.all_bins, work).reshape(len(chosen), 2, places, -1)
            for i, cells in zip(chosen, found, strict=True):
                trees[i].grow(cells, coding, wanted[i])
    return [(1.0 / len(trees), t) for t in trees]


def grow(blocks: DataFrame, coding: Coding, asked: Growth) -> list[tuple[float, Tree]]:
    return (forest if asked.rate is None else boosted)(blocks, coding, asked)


def squared_error(blocks: DataFrame, coding: Coding, grown: Sequence[tuple[float, Tree]]) -> tuple[float, float]:
    """Rows and the sum of their squared errors."""
    trees = [(w, t.plain) for w, t in grown]

    def work(given: Iterable[Block]) -> np.ndarray:
        total = np.zeros(2)
        for _, codes, target in given:
            error = target - _guess(trees, coding.digits(codes), len(target))
            total += len(target), np.square(error).sum()
        return total

    return tuple(summed(blocks, coding, 2, work))


def as_model(grown: Sequence[tuple[float, Tree]], coding: Coding, estimator):
    """Spark's model of the trees, with the estimator's columns and parameters."""
    gateway = SparkContext._active_spark_context._gateway
    spark_ml, impurity = gateway.jvm.org.apache.spark.ml, gateway.jvm.org.apache.spark.mllib.tree.impurity

    def array(kind, values: Sequence):
        out = gateway.new_array(kind, len(values))
        for i, v in enumerate(values):
            out[i] = v
        return out

    def doubles(values: Iterable[float]):
        return array(gateway.jvm.double, [float(v) for v in values])

    def node(tree: Tree, level: int, place: int):
        rows, total = tree.nodes[level, place]
        stats = impurity.VarianceCalculator(doubles([rows, total, np.nan]), int(rows))
        if level == len(tree.levels) or place not in tree.levels[level]:
            return spark_ml.tree.LeafNode(tree.value(level, place), float("nan"), stats)
        feature, cut = tree.levels[level][place]
        if isinstance(cut, int):
            split = spark_ml.tree.ContinuousSplit(feature, float(coding.edges[feature][cut]))
        else:
            split = spark_ml.tree.CategoricalSplit(feature, doubles(np.flatnonzero(~cut)), len(cut))
        left, right = (node(tree, level + 1, 2 * place + k) for k in (0, 1))
        return spark_ml.tree.InternalNode(tree.value(level, place), float("nan"), tree.gains[level, place], left, right, split, stats)

    kind, size = spark_ml.regression.DecisionTreeRegressionModel, len(coding.edges)
    trees = array(kind, [kind(f"{estimator.uid}_{i}", node(tree, 0, 0), size) for i, (_, tree) in enumerate(grown)])
    if isinstance(estimator, RandomForestRegressor):
        model = RandomForestRegressionModel(spark_ml.regression.RandomForestRegressionModel(estimator.uid, trees, size))
    else:
        model = GBTRegressionModel(spark_ml.regression.GBTRegressionModel(estimator.uid, trees, doubles(w for w, _ in grown), size))
    return estimator._copyValues(model)
