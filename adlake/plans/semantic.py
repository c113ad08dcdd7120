"""Governed measures over a star schema, evaluated in filter context."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions import display, divide
from adlake.operators.pick import top_with_ties
from adlake.session import materialize

KEY_LIST = 256
KEY_TABLE = 200_000
COMPARISONS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    "<>": operator.ne,
}


def slug(name: str) -> str:
    """Result column name of a governed name: the part after the table, in lower snake case."""
    return re.sub("[^a-z0-9]+", "_", name.split(".", 1)[-1].lower()).strip("_")


@dataclass(frozen=True)
class Dimension:
    """A dimension table and its many-to-one relationship to the fact.

    ``columns`` binds governed names to physical ones, ``sort_by`` names the column
    that orders another, and ``monotone`` a column that grows with the key, which lets
    a range on it become a range on the fact's key.
    """

    name: str
    table: DataFrame
    key: str
    fact_key: str
    columns: Mapping[str, str]
    sort_by: Mapping[str, str] = field(default_factory=dict)
    monotone: str | None = None
    hierarchies: Mapping[str, Sequence[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    """Either the sum of a fact column or the ratio of two other measures."""

    name: str
    column: str | None = None
    ratio: tuple[str, str] | None = None
    pattern: str = "#,##0"


@dataclass(frozen=True)
class Members:
    """Filter: the column is one of the values; None selects the blank member."""

    column: str
    values: Sequence[object]

    def test(self, value: Column) -> Column:
        listed = value.isin([v for v in self.values if v is not None])
        return (value.isNull() | listed) if self.keeps_blank else listed

    @property
    def keeps_blank(self) -> bool:
        return any(v is None for v in self.values)


@dataclass(frozen=True)
class Between:
    """Filter: the column lies in the closed range; an open end is None."""

    column: str
    low: object = None
    high: object = None
    keeps_blank = False

    def test(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value >= F.lit(self.low))
        if self.high is not None:
            test = test & (value <= F.lit(self.high))
        return test


@dataclass(frozen=True)
class Having:
    """Filter on a measure's value per group."""

    measure: str
    comparison: str
    value: object


@dataclass(frozen=True)
class Model:
    """Fact, dimensions and measures under governed names."""

    name: str
    fact: DataFrame
    fact_columns: Mapping[str, str]
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]

    # -- names ---------------------------------------------------------------

    def locate(self, column: str) -> tuple[Dimension | None, str]:
        """Dimension (None for the fact) and physical column of ``Table.Column``."""
        table, _, name = column.partition(".")
        if table == self.name and name in self.fact_columns:
            return None, self.fact_columns[name]
        if table in self.dimensions and name in self.dimensions[table].columns:
            return self.dimensions[table], self.dimensions[table].columns[name]
        raise KeyError(f"the model has no column {column!r}")

    def _sums_behind(self, names: Sequence[str]) -> list[Measure]:
        found: dict[str, Measure] = {}
        for name in names:
            if name not in self.measures:
                raise KeyError(f"the model has no measure {name!r}")
            measure = self.measures[name]
            for part in self._sums_behind(measure.ratio) if measure.ratio else [measure]:
                found[part.name] = part
        return list(found.values())

    def _value(self, name: str) -> Column:
        measure = self.measures[name]
        if measure.ratio:
            return divide(*[self._value(part) for part in measure.ratio])
        return F.col(f"_{slug(name)}")

    # -- evaluation ----------------------------------------------------------

    def _filtered(self, filters: Sequence[Members | Between]) -> tuple[DataFrame, dict[str, tuple[DataFrame, str]], list]:
        """Fact under the filters, and for each filtered dimension how to join it still.

        A dimension filter that selects few members becomes a key list on the fact
        scan, where it skips files and needs no join. A longer one becomes a key range
        where keys follow the filtered column, and a semi join with the counted keys.
        Only members too many to broadcast wait for the summed fact.
        """
        fact, by_dimension = self.fact, {}
        joins: dict[str, tuple[DataFrame, str]] = {}
        late = []
        for f in filters:
            dim, physical = self.locate(f.column)
            if dim is None:
                fact = fact.filter(f.test(F.col(physical)))
            elif f.keeps_blank:
                late.append(f)
            else:
                by_dimension.setdefault(dim.name, []).append((f, physical))
        for name, tests in by_dimension.items():
            dim = self.dimensions[name]
            chosen = reduce(lambda rows, t: rows.filter(t[0].test(F.col(t[1]))), tests, dim.table)
            keys = [r[0] for r in chosen.select(dim.key).limit(KEY_LIST + 1).collect()]
            if len(keys) <= KEY_LIST:
                fact = fact.filter(F.col(dim.fact_key).isin(keys))
                joins[name] = (chosen, "resolved")
                continue
            if any(f.column == f"{name}.{dim.monotone}" for f, _ in tests):
                low, high = chosen.agg(F.min(dim.key), F.max(dim.key)).first()
                fact = fact.filter(F.col(dim.fact_key).between(low, high))
            if chosen.select(dim.key).limit(KEY_TABLE + 1).count() <= KEY_TABLE:
                wanted = chosen.select(F.col(dim.key).alias(dim.fact_key))
                fact = fact.join(F.broadcast(wanted), dim.fact_key, "left_semi")
                joins[name] = (chosen, "resolved")
            else:
                joins[name] = (chosen, "inner")
        return fact, joins, late

    def _grouped(
        self,
        columns: Sequence[str],
        sums: Sequence[Measure],
        filters: Sequence[Members | Between] = (),
        rollup: bool = False,
    ) -> DataFrame:
        """Sums per group of labels.

        The fact is summed by surrogate key first; only those sums meet the dimensions
        and are summed again per label. The join input is then as small as the key
        combinations, each key once per combination, so hot members cannot skew it.
        """
        fact, joins, late = self._filtered(filters)
        labels: dict[str, tuple[Dimension | None, str]] = {}
        for column in [*columns, *[f.column for f in late]]:
            labels[slug(column)] = self.locate(column)
        needed = {d.name: d for d, _ in labels.values() if d}
        needed |= {n: self.dimensions[n] for n, (_, how) in joins.items() if how == "inner"}

        own = [F.col(p).alias(s) for s, (d, p) in labels.items() if d is None]
        keys = [F.col(d.fact_key).alias(f"_k_{n}") for n, d in needed.items()]
        total = [F.sum(m.column).alias(f"_{slug(m.name)}") for m in sums]
        result = fact.groupBy(*own, *keys).agg(*total) if total else fact.select(*own, *keys).distinct()

        for name, dim in needed.items():
            members, how = joins.get(name, (dim.table, "left"))
            shown = [F.col(p).alias(s) for s, (d, p) in labels.items() if d is dim]
            side = members.select(F.col(dim.key).alias(f"_k_{name}"), *shown)
            result = result.join(side, f"_k_{name}", "left" if how == "left" else "inner")
        for f in late:
            result = result.filter(f.test(F.col(slug(f.column))))

        wanted = [slug(c) for c in columns]
        again = [F.sum(f"_{slug(m.name)}").alias(f"_{slug(m.name)}") for m in sums]
        if rollup:
            return result.rollup(*wanted).agg(F.grouping_id().alias("grouping_id"), *again)
        if not needed and not late:
            return result
        return result.groupBy(*wanted).agg(*again) if again else result.select(*wanted).distinct()

    def query(
        self,
        group_by: Sequence[str] = (),
        measures: Sequence[str] = (),
        filters: Sequence[Members | Between] = (),
        having: Sequence[Having] = (),
        order_by: Sequence[tuple[str, str]] = (),
        top: tuple[int, str] | None = None,
        rollup: bool = False,
    ) -> DataFrame:
        """Measures per group, in filter context.

        Rows whose measures are all blank are left out. ``top=(n, measure)`` keeps the
        n best groups and ties. ``order_by`` takes governed columns or measures, shown
        or not; a column with a declared sort column is ordered by that.
        """
        ordering = [(c, d) for c, d in order_by]
        used = [*measures, *[h.measure for h in having], *([top[1]] if top else [])]
        used += [c for c, _ in ordering if c in self.measures]
        sums = self._sums_behind(used)
        sorters = {c: self._sorter(c) for c, _ in ordering if c not in self.measures}
        extra = [s for s in dict.fromkeys(sorters.values()) if s not in group_by]
        grouped = self._grouped([*group_by, *extra], sums, filters, rollup)

        labels = [F.col(slug(c)) for c in [*group_by, *extra]] + ([F.col("grouping_id")] if rollup else [])
        values = {m: self._value(m) for m in dict.fromkeys(used)}
        result = grouped.select(*labels, *[v.alias(slug(m)) for m, v in values.items()])
        if measures and group_by:
            result = result.filter(F.coalesce(*[F.col(slug(m)).cast("double") for m in measures]).isNotNull())
        for h in having:
            result = result.filter(COMPARISONS[h.comparison](F.col(slug(h.measure)), F.lit(h.value)))
        if top:
            result = top_with_ties(result, slug(top[1]), top[0])
        if ordering:
            keys = [(F.col(slug(sorters.get(c, c))), d) for c, d in ordering]
            result = result.orderBy(*[k.desc_nulls_last() if d == "desc" else k.asc_nulls_first() for k, d in keys])
        shown = [slug(c) for c in group_by] + (["grouping_id"] if rollup else []) + [slug(m) for m in measures]
        return result.select(*shown)

    def _sorter(self, column: str) -> str:
        dim, _ = self.locate(column)
        by = dim.sort_by.get(column.partition(".")[2]) if dim else None
        return f"{dim.name}.{by}" if by else column

    def drill(self, hierarchy: str, measures: Sequence[str], filters: Sequence[Members | Between] = ()) -> DataFrame:
        """Every level of a hierarchy ``Table.Hierarchy`` at once, told apart by ``grouping_id``."""
        table, _, name = hierarchy.partition(".")
        levels = [f"{table}.{c}" for c in self.dimensions[table].hierarchies[name]]
        return self.query(levels, measures, filters, rollup=True)

    def members(self, column: str, filters: Sequence[Members | Between] = ()) -> DataFrame:
        """Slicer list: the distinct members of a column, in its sort order.

        Relationships filter from dimension to fact only, so a filter must be on the
        same dimension to narrow the list.
        """
        dim, physical = self.locate(column)
        rows = dim.table if dim else self.fact
        for f in filters:
            other, name = self.locate(f.column)
            if other is not dim:
                raise ValueError(f"{f.column} does not filter {column}")
            rows = rows.filter(f.test(F.col(name)))
        sorter = self.locate(self._sorter(column))[1]
        listed = rows.select(F.col(physical).alias(slug(column)), F.col(sorter).alias("_sort")).distinct()
        return listed.orderBy(F.col("_sort").asc_nulls_first(), slug(column)).select(slug(column))

    def decompose(
        self,
        measure: str,
        path: Sequence[str],
        selected: Mapping[str, object] | None = None,
        bars: int = 3,
        filters: Sequence[Members | Between] = (),
    ) -> DataFrame:
        """Decomposition tree of a measure along a path of columns.

        Per level: the `bars` largest members under each shown parent, their rank, value
        and share of the parent. Every shown member is opened, or only the ``selected`` one
        (shown or not) on levels that name one.
        One row per bar; columns of deeper levels are null. The fact is summed once, and one rollup of those sums,
        stored, holds all levels.
        """
        selected = dict(selected or {})
        sums = self._sums_behind([measure])
        names = [slug(c) for c in path]
        totals = [F.sum(f"_{slug(m.name)}").alias(f"_{slug(m.name)}") for m in sums]
        rolled = self._grouped(path, sums, filters).rollup(*names).agg(F.grouping_id().alias("_rolled"), *totals)
        rolled = materialize(rolled, "decomposition")
        additive = not self.measures[measure].ratio

        def level(depth: int) -> DataFrame:
            rows = rolled.filter(F.col("_rolled") == (1 << (len(names) - depth)) - 1)
            return rows.select(*names[:depth], self._value(measure).alias("value"))

        levels = []
        for depth in range(1, len(path) + 1):
            parents = names[: depth - 1]
            whole = level(depth - 1)
            over = whole.select(*[F.col(c).alias(f"_p_{c}") for c in parents], F.col("value").alias("_whole"))
            if depth == 1:
                current = level(1).withColumn("_whole", over.select("_whole").scalar())
            else:
                parent = opened.select(*[F.col(c).alias(f"_o_{c}") for c in parents])
                current = level(depth).join(
                    parent, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in parents], "left_semi"
                )
                current = current.join(over, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in parents], "inner")
            valued = current.filter(F.col("value").isNotNull())
            shown = opened = largest(valued, parents, names[:depth], bars)
            if path[depth - 1] in selected:
                opened = valued.filter(F.col(names[depth - 1]).eqNullSafe(F.lit(selected[path[depth - 1]])))
            share = divide(F.col("value"), F.col("_whole")) if additive else F.lit(None).cast("double")
            levels.append(
                shown.select(
                    F.lit(depth).alias("level"),
                    *[
                        (F.col(n) if i < depth else F.lit(None).cast(rolled.schema[n].dataType)).alias(n)
                        for i, n in enumerate(names)
                    ],
                    "place",
                    "value",
                    share.alias("share"),
                )
            )
        return reduce(DataFrame.unionByName, levels)

    def formatted(self, result: DataFrame) -> DataFrame:
        """A query result with each measure as display text."""
        patterns = {slug(m.name): m.pattern for m in self.measures.values()}
        return result.select(
            *[display(F.col(c), patterns[c]).alias(c) if c in patterns else F.col(c) for c in result.columns]
        )


#: Parts in which the members of one parent are ranked before the parent's own ranking.
RANKED_PARTS = 64


def largest(rows: DataFrame, parents: Sequence[str], names: Sequence[str], n: int) -> DataFrame:
    """Rows with ``place``, their rank by value under their parent, of the n first places; ties share a place.

    The members of a parent are ranked in parts by a hash of their names first. What is among the n first of all is among the n first of its
    part, and all that outranks it too, so the second ranking sees few rows of each part and gives the same places.
    """
    part = F.pmod(F.xxhash64(*names), F.lit(RANKED_PARTS))
    by_value = F.col("value").desc_nulls_last()
    first = rows.withColumn("_part", part)
    first = first.withColumn("place", F.rank().over(Window.partitionBy(*parents, "_part").orderBy(by_value))).filter(F.col("place") <= n)
    whole = Window.partitionBy(*(parents or [F.lit(0)])).orderBy(by_value)
    return first.drop("_part").withColumn("place", F.rank().over(whole)).filter(F.col("place") <= n)


def share_of_total(result: DataFrame, measure: str) -> DataFrame:
    """A query result with each row's share of the measure's total over all rows."""
    value = F.col(slug(measure))
    total = result.agg(F.sum(value.cast("double"))).scalar()
    return result.withColumn("share", divide(value, total))
