"""Mixing sources to target weights, in DataFrame operations alone.

Documents form a tree of domain, language and source. A token budget goes down the tree by the
weights of the nodes. A node that holds less than its share gives the rest to its siblings; only what
all of them together can't use stays with their parent, whose own siblings get it, as a node is
never given more than its leaves hold. Each leaf then reads its documents in a seeded order, epoch
after epoch, until its tokens are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.session import materialize

LEVELS = ("domain", "lang", "source")
#: Tokens to choose, in percent of all, and how often a document may be used.
PERCENT = 100
MAX_EPOCHS = 3
SEED = 17
#: Hex digits of the order key that cut a leaf into parts whose tokens are summed before any is sorted.
PART_DIGITS = 3

_BIG = "decimal(38,0)"


def tokens_of(text: str = "text") -> Column:
    """Words: runs outside \\x20 and \\x09-\\x0D; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string")).cast("binary"))


def _shares(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """nodes (parent, key, weight, cap, budget of the parent) with their share of the budget.

    By ascending cap over weight, nodes are full as long as their cap is within their part of what is
    left; the others divide the rest by weight, rounded down.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    weight, cap = F.col("weight").cast(_BIG), F.col("cap").cast(_BIG)
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(F.lit(1e300))
    order = family.orderBy(ratio, key)
    left = F.col("budget").cast(_BIG) - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(_BIG)
    nodes = nodes.withColumns({"left": left, "weights": weights})
    nodes = nodes.withColumn("full", (F.col("weight") > 0) & (F.col("left") > 0) & (cap * F.col("weights") <= F.col("left") * weight))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), F.lit(0))
    sharing = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    nodes = nodes.withColumns({"rest": rest, "sharing": sharing})
    part = F.when(F.col("sharing") > 0, F.floor(F.col("rest").cast(_BIG) * weight / F.col("sharing").cast(_BIG)))
    return nodes.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.coalesce(part, F.lit(0)).cast("long"))).drop("left", "weights", "full", "rest", "sharing")


def _weighted(nodes: DataFrame, weights: DataFrame | None, depth: int) -> DataFrame:
    """nodes with their weight; 1 where none is given."""
    if weights is None:
        return nodes.withColumn("weight", F.lit(1).cast("long"))
    own = weights.filter(" and ".join(f"{c} is {'not ' * (k <= depth)}null" for k, c in enumerate(LEVELS)))
    own = own.groupBy(*LEVELS[: depth + 1]).agg(F.max("weight").cast("long").alias("weight"))
    return nodes.join(own, list(LEVELS[: depth + 1]), "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(1).cast("long")), F.lit(0).cast("long")))


def budgets(leaves: DataFrame, weights: DataFrame | None = None, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """domain, lang, source, n (tokens of the leaf), share (tokens it is given). leaves: domain, lang, source, n.

    weights: domain, lang, source, weight, where a null lang or source stands for the node above.
    """
    caps = leaves.withColumn("cap", F.col("n") * max_epochs)
    given = caps.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("n").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    given = given.withColumn("budget", F.floor(F.sum("n").over(everything).cast(_BIG) * percent / 100).cast("long")).drop("n")
    for depth, key in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        if depth:
            below = caps.groupBy(*LEVELS[: depth + 1]).agg(F.sum("cap").alias("cap"))
            given = below.join(given.select(*parent, F.col("share").alias("budget")), parent)
        given = _shares(_weighted(given, weights, depth), parent, key)
    return given.join(leaves, list(LEVELS)).select(*LEVELS, "n", "share")


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, the leaf, n_tokens. A null domain, language or source counts as the empty name."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LEVELS]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names, tokens_of().alias("n_tokens")).filter("doc_id is not null")


def _planned(sized: DataFrame, weights: DataFrame | None, percent: int, max_epochs: int) -> DataFrame:
    """Per leaf: whole epochs, and tokens of the next one."""
    given = budgets(sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n")), weights, percent, max_epochs)
    whole = F.when(F.col("n") > 0, F.expr("share div n")).otherwise(F.lit(0).cast("long"))
    return given.withColumn("epochs", whole).withColumn("rest", F.col("share") - F.col("epochs") * F.col("n"))


def _cut(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Documents of the last, partial epoch of their leaf, with the tokens taken.

    The leaf's tokens are summed by parts of the order first; only the part in which the tokens run out is
    sorted, so a leaf of a third of all documents is never in one task.
    """
    leaf = list(LEVELS)
    rows = sized.join(plan.filter("rest > 0").select(*leaf, "epochs", "rest"), leaf)
    rows = rows.withColumn("key", order_key(F.col("epochs"), seed)).withColumn("part", F.substring("key", 1, PART_DIGITS))
    parts = rows.groupBy(*leaf, "part").agg(F.sum("n_tokens").alias("size"))
    until = F.sum("size").over(Window.partitionBy(*leaf).orderBy("part"))
    parts = parts.withColumn("before", until - F.col("size"))
    rows = rows.join(parts, [*leaf, "part"]).filter("before < rest")
    whole = rows.filter("before + size <= rest").withColumn("taken", F.col("n_tokens"))
    order = Window.partitionBy(*leaf, "part").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.filter("before + size > rest").withColumn("start", F.col("before") + F.sum("n_tokens").over(order) - F.col("n_tokens"))
    edge = edge.filter("start < rest").withColumn("taken", F.least("n_tokens", F.col("rest") - F.col("start"))).drop("start")
    return whole.unionByName(edge)


def mixed(docs: DataFrame, weights: DataFrame | None = None, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens, taken: each use of a document in the mix.

    docs: doc_id, text, domain, lang, source. Tokens are words. Whole epochs take every document of the leaf; of
    the last document of the partial epoch only a prefix of ``taken`` tokens is used. The budget is
    ``percent`` of all tokens; what no leaf can give within ``max_epochs`` stays unused. Shares are rounded
    down. Missing weights are 1, weights of 0 or less give nothing; the largest of repeated weights counts.
    Null or empty texts have no tokens: they come along in whole epochs, and in a partial epoch as
    long as tokens are left; a leaf without any token isn't used. Rows without doc_id are left out; repeated rows are documents of their
    own. Other columns don't matter. No documents: no rows.
    """
    sized = materialize(_sized(docs), "sized")
    plan = materialize(_planned(sized, weights, percent, max_epochs), "mix")
    whole = sized.join(plan.filter("epochs > 0").select(*LEVELS, "epochs"), list(LEVELS))
    whole = whole.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1))).withColumn("taken", F.col("n_tokens"))
    cut = _cut(sized, plan, seed).withColumn("epoch", F.col("epochs"))
    columns = ("doc_id", *LEVELS, "epoch", "n_tokens", "taken")
    return whole.select(*columns).unionAll(cut.select(*columns))


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of docs that a mix of one epoch uses, with all their columns; the last document of a leaf is whole.

    docs as for ``mixed``, and so are the cases. Each leaf's last order key is written, so that Spark knows their size, and joined to the
    documents, which aren't shuffled when the leaves are few. Of rows with one key, which share a doc_id, all are used or none.
    """
    sized = materialize(_sized(docs), "sized")
    plan = materialize(_planned(sized, weights, percent, 1), "mix")
    ends = _cut(sized, plan, seed).groupBy(*LEVELS).agg(F.max("key").alias("end"))
    # an epoch that is used up ends beyond every hex digest
    ends = ends.unionByName(plan.filter("epochs > 0").select(*LEVELS, F.lit("~").alias("end")))
    leaf = [F.coalesce(F.col(c).cast("string"), F.lit("")).eqNullSafe(F.col(f"_leaf_{c}")) for c in LEVELS]
    ends = ends.select(*[F.col(c).alias(f"_leaf_{c}") for c in LEVELS], F.col("end").alias("_leaf_end"))
    used = (F.col("_leaf_end") == "~") | (order_key(F.lit(0), seed) <= F.col("_leaf_end"))
    return docs.join(materialize(ends, "ends"), leaf[0] & leaf[1] & leaf[2] & used, "left_semi")
