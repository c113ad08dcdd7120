"""Property-graph view of the star schema: entities, relationships, traversal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import positive_ratio, text_key
from adlake.operators.quality import key_gaps
from adlake.session import materialize


@dataclass(frozen=True)
class Entity:
    """An entity type: its table, typed properties bound to columns, and key columns."""

    name: str
    table: str
    key: Sequence[str]
    properties: Mapping[str, tuple[str, str]]
    computed: Mapping[str, tuple[str, str]] | None = None


@dataclass(frozen=True)
class Relationship:
    """Edges from a source entity to a target, both read from one table's columns."""

    name: str
    source: str
    target: str
    table: str
    target_column: str


@dataclass(frozen=True)
class Ontology:
    tables: Mapping[str, DataFrame]
    entities: Mapping[str, Entity]
    relationships: Mapping[str, Relationship]

    def entity_key(self, name: str) -> Column:
        """The key of an entity as one column; several parts join to text, nulls kept apart."""
        parts = self.entities[name].key
        return F.col(parts[0]) if len(parts) == 1 else text_key(*[F.col(p) for p in parts])

    def entity(self, name: str) -> DataFrame:
        """Instances of an entity type: its key and typed properties.

        A ratio property without a bound column is computed from the row.
        """
        e = self.entities[name]
        bound = [F.col(column).cast(kind).alias(prop) for prop, (column, kind) in e.properties.items()]
        computed = [
            positive_ratio(F.col(top), F.col(bottom)).cast("double").alias(prop)
            for prop, (top, bottom) in (e.computed or {}).items()
        ]
        return self.tables[e.table].select(self.entity_key(name).alias("entity_key"), *bound, *computed)

    def edges(self, name: str) -> DataFrame:
        """Edges of a relationship: the source's key parts and the target's key."""
        r = self.relationships[name]
        parts = self.entities[r.source].key
        return self.tables[r.table].select(
            *[F.col(p).alias(f"source_{p}") for p in parts], F.col(r.target_column).alias("target_key")
        )

    def resolved_edges(self, name: str) -> DataFrame:
        """Edges whose target exists."""
        target = self._targets(name)
        return self.edges(name).join(target, "target_key", "left_semi")

    def _targets(self, name: str) -> DataFrame:
        r = self.relationships[name]
        e = self.entities[r.target]
        return self.tables[e.table].select(F.col(e.key[0]).alias("target_key"))

    def dangling(self) -> DataFrame:
        """Per relationship: edges without a target entity, and the target keys they name. One pass per table of edges."""
        by_table: dict[str, dict[str, tuple[str, DataFrame]]] = {}
        for name, r in self.relationships.items():
            by_table.setdefault(r.table, {})[name] = (r.target_column, self._targets(name))
        gaps = [key_gaps(self.tables[table], members) for table, members in by_table.items()]
        return reduce(DataFrame.unionByName, gaps).toDF("relationship", "missing_targets", "dangling_edges")

    def related(self, relationship: str, members: DataFrame) -> DataFrame:
        """One hop: edges that lead to the given target members (a frame with their key column)."""
        r = self.relationships[relationship]
        key = self.entities[r.target].key[0]
        chosen = members.select(F.col(key).alias("target_key"))
        return self.edges(relationship).join(chosen, "target_key", "left_semi")

    def traverse(self, start: str, end: str) -> DataFrame:
        """Two hops, target to source to target: distinct pairs of start and end keys with edge counts.

        Both relationships share their source entity and table, so its key fixes both
        targets and each row carries the whole path. The hops need no join of edges,
        which would pair up all rows of a shared source.
        """
        first, second = self.relationships[start], self.relationships[end]
        if (first.source, first.table) != (second.source, second.table):
            raise ValueError(f"{start} and {end} do not share their source")
        return (
            self.tables[first.table]
            .groupBy(F.col(first.target_column).alias("start_key"), F.col(second.target_column).alias("end_key"))
            .agg(F.count("*").alias("paths"))
        )

    def traverse_members(
        self, start: str, end: str, start_label: str, end_label: str, only: Column | None = None
    ) -> DataFrame:
        """Distinct labels reached: start entity's property to end entity's property."""
        s = self.entities[self.relationships[start].target]
        e = self.entities[self.relationships[end].target]
        origin = self.tables[s.table] if only is None else self.tables[s.table].filter(only)
        left = origin.select(F.col(s.key[0]).alias("start_key"), F.col(s.properties[start_label][0]).alias(start_label))
        right = self.tables[e.table].select(
            F.col(e.key[0]).alias("end_key"), F.col(e.properties[end_label][0]).alias(end_label)
        )
        pairs = self.traverse(start, end).join(left, "start_key")
        met = pairs.groupBy(start_label, "end_key").agg(F.sum("paths").alias("paths")).join(right, "end_key")
        return met.groupBy(start_label, end_label).agg(F.sum("paths").alias("paths"))

    # -- paths of any length ------------------------------------------------------

    def _carried(self, entity: str) -> list[str]:
        """Columns a frontier of an entity holds: its key and, where its own table has them, the targets of its relationships.

        A row of a source entity then knows its neighbours, and a hop to them needs no join.
        """
        e = self.entities[entity]
        targets = [r.target_column for r in self.relationships.values() if r.source == entity and r.table == e.table]
        return list(dict.fromkeys([*e.key, *targets]))

    def _members(self, entity: str, members: DataFrame) -> DataFrame:
        """The first frontier: instances of the entity that have the keys given."""
        key = list(self.entities[entity].key)
        rows = self.tables[self.entities[entity].table].select(*self._carried(entity))
        return _semi(rows, members.select(*key), key, key).distinct()

    def _hop(self, frontier: DataFrame, at: str, relationship: str) -> tuple[str, DataFrame]:
        """The entity on the other side of a relationship, and its distinct instances next to the frontier.

        Sources of a frontier of targets are a semi join of the edge table, whose skewed targets adaptive
        execution splits; the frontier is distinct, so a hub's edges are never multiplied.
        """
        r = self.relationships[relationship]
        source_key, target_key = list(self.entities[r.source].key), self.entities[r.target].key[0]
        if r.source == at:
            if r.target_column in frontier.columns:
                reached = frontier.select(F.col(r.target_column).alias(target_key))
            else:
                edges = self.tables[r.table].select(*source_key, F.col(r.target_column).alias("_target"))
                reached = _semi(edges, frontier.select(*source_key), source_key, source_key).select(F.col("_target").alias(target_key))
            members = self.tables[self.entities[r.target].table].select(*self._carried(r.target))
            return r.target, _semi(members, reached.distinct(), [target_key], [target_key])
        if r.target != at:
            raise ValueError(f"{relationship} does not touch {at}")
        rows = self.tables[r.table]
        columns = [c for c in self._carried(r.source) if c in rows.columns]
        near = _semi(rows.select(*dict.fromkeys([*columns, r.target_column])), frontier.select(target_key), [r.target_column], [target_key])
        return r.source, near.select(*columns).distinct()

    def walk(self, start: str, members: DataFrame, path: Sequence[str]) -> DataFrame:
        """Keys of the entities at the end of a path of relationships, each followed in the direction that leads on.

        members: a frame with the start entity's key columns. Every hop is written down, so no hop is run twice.
        """
        at, frontier = start, self._members(start, members)
        for name in path:
            at, frontier = self._hop(frontier, at, name)
            frontier = materialize(frontier, "frontier")
        return frontier.select(*self.entities[at].key).distinct()

    def reachable(self, start: str, members: DataFrame, relationships: Sequence[str] | None = None, max_hops: int | None = None) -> DataFrame:
        """entity, entity_key (as text) and hops: every instance that members lead to over the relationships, with its least number of hops.

        A search by frontiers: each hop is written, and goes on only with instances no earlier hop has seen.
        It ends where a hop finds none, or after ``max_hops``.
        """
        allowed = list(self.relationships if relationships is None else relationships)
        frontier = {start: materialize(self._members(start, members), "frontier")}
        seen = {start: [(0, frontier[start])]}
        hop = 0
        while frontier and (max_hops is None or hop < max_hops):
            hop += 1
            near: dict[str, list[DataFrame]] = {}
            for at, rows in frontier.items():
                for name in allowed:
                    if at in (self.relationships[name].source, self.relationships[name].target):
                        to, reached = self._hop(rows, at, name)
                        near.setdefault(to, []).append(reached)
            frontier = {}
            for to, parts in near.items():
                key = list(self.entities[to].key)
                new = reduce(DataFrame.unionByName, parts).distinct() if len(parts) > 1 else parts[0]
                for _, old in seen.get(to, []):
                    new = _semi(new, old.select(*key), key, key, "left_anti")
                new = materialize(new, "frontier")
                if not new.isEmpty():
                    frontier[to] = new
                    seen.setdefault(to, []).append((hop, new))
        found = [
            rows.select(F.lit(name).alias("entity"), self.entity_key(name).cast("string").alias("entity_key"), F.lit(hops).alias("hops"))
            for name, parts in seen.items()
            for hops, rows in parts
        ]
        return reduce(DataFrame.unionByName, found).distinct()

    def label_pairs(self, path: Sequence[str], start_label: str, end_label: str, only: Column | None = None) -> DataFrame:
        """start and end: distinct labels that a path from target to target joins, with its steps through shared sources.

        Each two hops are counted per pair of keys before they are joined, so a hub counts once per neighbour and
        not once per edge. Pairs of a step are written, and so is each frontier.
        """
        if not path or len(path) % 2:
            raise ValueError("a path from target to target has an even number of hops")
        first, last = self.relationships[path[0]], self.relationships[path[-1]]
        s, e = self.entities[first.target], self.entities[last.target]
        origin = self.tables[s.table] if only is None else self.tables[s.table].filter(only)
        pairs = origin.select(F.col(s.properties[start_label][0]).alias("start"), F.col(s.key[0]).alias("_key")).distinct()
        for back, on in zip(path[::2], path[1::2], strict=True):
            step = materialize(self.traverse(back, on).drop("paths"), "step")
            pairs = materialize(pairs.join(step, pairs["_key"] == step["start_key"]).select("start", F.col("end_key").alias("_key")).distinct(), "pairs")
        labels = self.tables[e.table].select(F.col(e.key[0]).alias("_key"), F.col(e.properties[end_label][0]).alias("end"))
        return pairs.join(labels, "_key").select("start", "end").distinct()


def _semi(rows: DataFrame, keys: DataFrame, left: Sequence[str], right: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows with (or, left_anti, without) a match among keys; null parts of a key match each other."""
    named = keys.toDF(*[f"_k{i}" for i in range(len(right))])
    return rows.join(named, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(left)]), how)


# --- fixed values: entity types, property bindings and relationships ---------
PERFORMANCE_KEY = ["date_key", "channel_key", "campaign_key", "product_key", "region", "device_category"]
ENTITIES = [
    Entity(
        "Product", "product", ["product_key"],
        {
            "Product": ("product_name", "string"),
            "Brand": ("brand", "string"),
            "Category": ("category", "string"),
            "List_Price": ("list_price", "double"),
            "Rating": ("rating", "double"),
            "Availability_Status": ("availability_status", "string"),
            "product_key": ("product_key", "bigint"),
            "Product_Name": ("product_name", "string"),
        },
    ),
    Entity(
        "Date", "date", ["date_key"],
        {
            "Date": ("date", "timestamp_ntz"),
            "date_key": ("date_key", "bigint"),
            "Year": ("year", "bigint"),
            "Quarter": ("quarter", "string"),
            "Month_Name": ("month_name", "string"),
            "Month_Number": ("month_number", "bigint"),
            "Week_of_Year": ("week_of_year", "bigint"),
            "Day_of_Week": ("day_of_week", "string"),
        },
    ),
    Entity(
        "Channel", "channel", ["channel_key"],
        {
            "Platform": ("source_system", "string"),
            "Channel": ("channel", "string"),
            "channel_key": ("channel_key", "bigint"),
            "source_system": ("source_system", "string"),
        },
    ),
    Entity(
        "Campaign", "campaign", ["campaign_key"],
        {
            "Campaign": ("campaign_name", "string"),
            "Campaign_Objective": ("campaign_objective", "string"),
            "campaign_id": ("campaign_id", "bigint"),
            "campaign_name": ("campaign_name", "string"),
            "campaign_key": ("campaign_key", "bigint"),
        },
    ),
    Entity(
        "Marketing_Performance", "fact", PERFORMANCE_KEY,
        {
            "Region": ("region", "string"),
            "Device_Category": ("device_category", "string"),
            "Video_Views": ("video_views", "bigint"),
            "Engagements": ("engagements", "bigint"),
            "Total_Impressions": ("impressions", "bigint"),
            "Total_Clicks": ("clicks", "bigint"),
            "Total_Sessions": ("sessions", "bigint"),
            "Total_Spend": ("spend", "double"),
            "Total_Revenue": ("revenue", "double"),
            "Total_Conversions": ("conversions", "bigint"),
            "Total_Leads": ("leads", "bigint"),
            "Click_Through_Rate": ("click_through_rate", "double"),
            "Cost_per_Click": ("cost_per_click", "double"),
            "Return_on_Ad_Spend": ("return_on_ad_spend", "double"),
            "date_key": ("date_key", "bigint"),
            "channel_key": ("channel_key", "bigint"),
            "campaign_key": ("campaign_key", "bigint"),
            "product_key": ("product_key", "bigint"),
        },
        {"Conversion_Rate": ("conversions", "sessions"), "Cost_per_Lead": ("spend", "leads")},
    ),
]
RELATIONSHIPS = [
    Relationship(f"Marketing_Performance_has_{target}", "Marketing_Performance", target, "fact", column)
    for target, column in [
        ("Date", "date_key"),
        ("Channel", "channel_key"),
        ("Campaign", "campaign_key"),
        ("Product", "product_key"),
    ]
]


def performance_ontology(gold: Mapping[str, DataFrame]) -> Ontology:
    return Ontology(gold, {e.name: e for e in ENTITIES}, {r.name: r for r in RELATIONSHIPS})
