import pytest
from conftest import rows
from pyspark.sql import functions as F

from adlake.plans.graph import PERFORMANCE_KEY, Relationship

HAS = "Marketing_Performance_has_"


def test_entities_are_typed_and_keyed(loaded):
    ontology = loaded.ontology()
    expected = {"Product": 30, "Date": 180, "Channel": 3, "Campaign": 8, "Marketing_Performance": 2160}
    for name, count in expected.items():
        entity = ontology.entity(name)
        assert entity.count() == count == entity.select("entity_key").distinct().count()
    types = {f.name: f.dataType.simpleString() for f in ontology.entity("Marketing_Performance").schema}
    assert types["Total_Spend"] == "double" and types["Total_Clicks"] == "bigint" and types["Cost_per_Lead"] == "double"
    channel = ontology.entity("Channel")
    assert channel.filter("Platform <> source_system").count() == 0


def test_edges_reach_their_targets(loaded):
    ontology = loaded.ontology()
    for target in ("Date", "Channel", "Campaign", "Product"):
        edges = ontology.edges(HAS + target)
        assert edges.columns == [*[f"source_{k}" for k in PERFORMANCE_KEY], "target_key"]
        assert edges.count() == ontology.resolved_edges(HAS + target).count() == 2160
    assert ontology.dangling().agg(F.sum("dangling_edges")).first()[0] == 0


def test_traversal_equals_a_join_of_edges(loaded):
    ontology = loaded.ontology()
    parts = [f"source_{k}" for k in PERFORMANCE_KEY]

    def keyed(target):
        edges = ontology.edges(HAS + target)
        return edges.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("s"), "target_key")

    left = keyed("Product").withColumnRenamed("target_key", "start_key")
    right = keyed("Campaign").withColumnRenamed("target_key", "end_key")
    joined = left.join(right, "s").groupBy("start_key", "end_key").count()
    assert rows(ontology.traverse(HAS + "Product", HAS + "Campaign")) == rows(joined)


def test_traverse_members_from_some(loaded):
    ontology = loaded.ontology()
    found = ontology.traverse_members(
        HAS + "Product", HAS + "Campaign", "Brand", "Campaign", only=F.col("brand") == "Make 2"
    )
    assert {r.Brand for r in found.collect()} == {"Make 2"}
    assert found.agg(F.sum("paths")).first()[0] == loaded.gold()["fact"].filter("product_key % 6 = 3").count()


def test_related_is_one_hop(loaded):
    ontology = loaded.ontology()
    members = loaded.gold()["channel"].filter("source_system = 'Meta Ads'")
    assert ontology.related(HAS + "Channel", members).count() == 720


def test_hops_must_share_their_source(loaded):
    from dataclasses import replace

    ontology = loaded.ontology()
    other = Relationship("other", "Product", "Channel", "product", "product_key")
    wider = replace(ontology, relationships={**ontology.relationships, "other": other})
    with pytest.raises(ValueError):
        wider.traverse(HAS + "Product", "other")


def keys(frame):
    return sorted(r[0] for r in frame.collect())


def test_a_walk_equals_joins(loaded):
    ontology, fact = loaded.ontology(), loaded.gold()["fact"]
    start = loaded.gold()["product"].filter("brand = 'Make 2'")
    product, campaign, date = (HAS + n for n in ("Product", "Campaign", "Date"))
    facts = fact.join(start.select("product_key"), "product_key", "left_semi")
    assert keys(ontology.walk("Product", start, [product, campaign])) == keys(facts.select("campaign_key").distinct())
    again = fact.join(facts.select("campaign_key").distinct(), "campaign_key", "left_semi").select("date_key").distinct()
    assert keys(ontology.walk("Product", start, [product, campaign, campaign, date])) == keys(again)
    assert ontology.walk("Product", start, [product]).count() == facts.select(*PERFORMANCE_KEY).distinct().count()
    assert ontology.walk("Product", start.limit(0), [product, campaign]).count() == 0
    rows_of_fact = ontology.walk("Product", start, [product])
    assert keys(ontology.walk("Marketing_Performance", rows_of_fact, [campaign])) == keys(facts.select("campaign_key").distinct())
    with pytest.raises(ValueError):
        ontology.walk("Product", start, [campaign])


def test_reachable_counts_least_hops(spark):
    """A chain of days and products, a hub day, a part that nothing leads to, and null key parts."""
    from adlake.plans.graph import Entity, Ontology

    facts = [(1, 1, None), (1, 2, "a"), (2, 2, "a"), (2, 3, None), (3, 3, "a"), (9, 9, "a"), (9, 9, "a"), (5, 77, "a"), *[(4, k, "a") for k in range(3, 40)]]
    frames = {
        "fact": spark.createDataFrame(facts, "date_key long, product_key long, region string"),
        "date": spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 9)], "date_key long"),
        "product": spark.createDataFrame([(k,) for k in range(1, 41)], "product_key long"),
    }
    entities = {n: Entity(n, t, k, {}) for n, t, k in (("F", "fact", ["date_key", "product_key", "region"]), ("D", "date", ["date_key"]), ("P", "product", ["product_key"]))}
    ontology = Ontology(frames, entities, {r.name: r for r in (Relationship("d", "F", "D", "fact", "date_key"), Relationship("p", "F", "P", "fact", "product_key"))})

    def plain(limit):
        links = {}
        for d, p, region in facts:
            node = ("F", d, p, region)
            for other in [("D", d)] * (d in (1, 2, 3, 4, 9)) + [("P", p)] * (p <= 40):
                links.setdefault(node, set()).add(other)
                links.setdefault(other, set()).add(node)
        seen, edge, hop = {("P", 1): 0}, {("P", 1)}, 0
        while edge and (limit is None or hop < limit):
            hop += 1
            edge = {n for e in edge for n in links.get(e, ())} - set(seen)
            seen.update(dict.fromkeys(edge, hop))
        return sorted((n[0], h) for n, h in seen.items())

    start = frames["product"].filter("product_key = 1")
    for limit in (None, 0, 1, 4):
        found = ontology.reachable("P", start, max_hops=limit)
        assert sorted((r.entity, r.hops) for r in found.collect()) == plain(limit)
    assert {r.entity_key for r in ontology.reachable("P", start, ["d"]).collect()} == {"1"}


def test_label_pairs_over_four_hops(loaded):
    ontology, gold = loaded.ontology(), loaded.gold()
    fact = gold["fact"].join(gold["product"].select("product_key", "brand"), "product_key").select("brand", "campaign_key").distinct()
    pairs = fact.join(fact.withColumnRenamed("brand", "end"), "campaign_key").select(F.col("brand").alias("start"), "end").distinct()
    product, campaign = HAS + "Product", HAS + "Campaign"
    path = [product, campaign, campaign, product]
    assert rows(ontology.label_pairs(path, "Brand", "Brand")) == rows(pairs)
    assert rows(ontology.label_pairs(path, "Brand", "Brand", F.col("brand") == "Make 2")) == rows(pairs.filter("start = 'Make 2'"))
    with pytest.raises(ValueError):
        ontology.label_pairs(path[:3], "Brand", "Brand")
