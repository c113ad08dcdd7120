"""A prefix trie of conversations, rolled up by bands of depth.

A node is a sequence of first turns, known by its depth and a 128-bit sum over its turns, each hashed
with its place. Subtree sums go up in bands of fixed height: a node explodes only to the ancestors of its own
band; the tops of bands are again a trie, one band-height shallower, whose totals are completed the
same way and then propagate to the band above. So a trie of depth D takes log(D) rounds to the base of the
band height, and no node explodes to more rows than a band is high.

All of it is DataFrame code. Texts are read once, for their hash and length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.ranges import ranged
from adlake.session import materialize

#: Depths of a band; also the turns whose hashes one window adds up.
BAND = 16
#: Conversations whose first turns another one takes are the multiples of this, and it takes fewer turns than HEADS.
FAMILY = 100
HEADS = 6

#: What is added up over subtrees.
_VALUES = ("saved", "leaves")
_WIDE = "decimal(38,0)"


def _key(depth, one, two) -> F.Column:
    """16 bytes that name a node."""
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), one.cast(_WIDE).cast("string"), two.cast(_WIDE).cast("string"))))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place from 0), x (hash of role and text) and chars of every turn; nulls first, equal turns by x.

    Rows are cut into ranges of (conversation, turn), so that one conversation may hold any part of all
    rows. Only its place in a range and the counts of ranges before are added up.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    x = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), x.alias("x"), F.char_length(text).cast("long").alias("chars"))
    turns = turns.filter("conv_id is not null").withColumn("tie", F.monotonically_increasing_id())  # parts equal rows, which may change places
    order = ["conv_id", "turn", "x", "tie"]
    rows = ranged(turns, order)
    counts = rows.groupBy("conv_id", "_bucket").agg(F.count("*").alias("c"))
    earlier = Window.partitionBy("conv_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.sum("c").over(earlier)).filter("before > 0").select("conv_id", "_bucket", "before")
    first = F.row_number().over(Window.partitionBy("conv_id", "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]]))
    numbered = rows.withColumn("i", first.cast("long") - 1).join(before, ["conv_id", "_bucket"], "left")
    return numbered.select("conv_id", (F.col("i") + F.coalesce("before", F.lit(0))).alias("i"), "x", "chars")


def rebuilt_turns(turns: DataFrame, conversations: DataFrame, band: int = BAND) -> DataFrame:
    """conv_id, d (depth from 1), x, chars and length of every turn of the rebuilt conversations.

    What a turn must know of its conversation comes by blocks of turns, so a long conversation makes no hot key.
    """
    own = turns.filter("i >= heads").withColumn("block", F.expr(f"i div {band}"))
    blocks = conversations.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {band})"))).select("conv_id", "block", "taken", "length")
    tail = own.join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("i") - F.col("heads") + F.col("taken") + 1).alias("d"), "x", "chars", "length")
    base = turns.filter(f"conv_id % {FAMILY} = 0 and i < {HEADS - 1}").select(F.col("conv_id").alias("base"), "i", "x", "chars")
    head = conversations.join(base, "base").filter("i < heads").select("conv_id", (F.col("i") + 1).alias("d"), "x", "chars", "length")
    return tail.unionByName(head)


def _running(rows: DataFrame, deepest: int, band: int) -> DataFrame:
    """rows (conv_id, at from 0, one, two, ...) with block, and s1 and s2: the sums of one and two up to and with at."""
    rows = rows.withColumn("block", F.expr(f"at div {band}"))
    window = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"s1": F.sum("one").over(window).cast(_WIDE), "s2": F.sum("two").over(window).cast(_WIDE)})
    if deepest < band:
        return rows
    sums = rows.groupBy("conv_id", "block").agg(F.sum("one").cast(_WIDE).alias("one"), F.sum("two").cast(_WIDE).alias("two")).withColumnRenamed("block", "at")
    above = _running(sums, deepest // band, band).select("conv_id", F.col("at").alias("block"), (F.col("s1") - F.col("one")).alias("b1"), (F.col("s2") - F.col("two")).alias("b2"))
    return rows.join(above, ["conv_id", "block"]).withColumns({"s1": (F.col("s1") + F.col("b1")).cast(_WIDE), "s2": (F.col("s2") + F.col("b2")).cast(_WIDE)}).drop("b1", "b2")


def _with_path(rows: DataFrame, band: int) -> DataFrame:
    """rows (conv_id, d, key, parent, ...) with path: the top of the row's band, then the nodes of the band down to the row's own."""
    window = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    path = F.concat(F.array(F.first("parent").over(window)), F.collect_list("key").over(window))
    return rows.withColumn("block", F.expr(f"(d - 1) div {band}")).withColumn("path", path).drop("block")


def _totals(nodes: DataFrame, rows: DataFrame, deepest: int, band: int) -> DataFrame:
    """key and the sums of _VALUES over the subtree of every node.

    nodes: key, d, path (null for the root) and the node's own values. rows: conv_id, d, key and path of all
    conversations' turns. Both are written tables, as both are read several times.
    """
    sums = [F.sum(v).alias(v) for v in _VALUES]
    parts = nodes.select(F.posexplode("path").alias("at", "key"), *_VALUES)
    bands = materialize(parts.groupBy("key", (F.col("at") == 0).alias("top")).agg(*sums), "bands")
    below = bands.filter("top").select("key", *[F.col(v).alias(f"_{v}") for v in _VALUES])
    tops = nodes.filter(f"d % {band} = 0").join(below, "key", "left").select("key", "d", *[F.coalesce(f"_{v}", F.lit(0)).cast("long").alias(v) for v in _VALUES])
    within = bands.filter("not top").select("key", *_VALUES)
    if deepest > band:
        upper = rows.filter(f"d % {band} = 0").select("conv_id", F.expr(f"d div {band}").alias("d"), "key", F.col("path")[0].alias("parent"))
        upper = materialize(_with_path(upper, band).drop("parent"), "upper")
        paths = upper.groupBy("key").agg(F.any_value("path").alias("path"))
        tops = tops.withColumn("d", F.expr(f"d div {band}")).join(paths, "key", "left")
        done = materialize(_totals(materialize(tops, "tops"), upper, deepest // band, band), "totals")
        ends = nodes.filter(f"d > 0 and d % {band} = 0").select("key", "path").join(done, "key")
        through = ends.select(F.posexplode("path").alias("at", "key"), *_VALUES).filter("at > 0").select("key", *_VALUES)
        within = within.unionByName(through).groupBy("key").agg(*sums)
        below_root = done
    else:
        below_root = tops
    root = nodes.filter("d = 0").select("key", *[F.col(v).alias(f"_{v}") for v in _VALUES]).join(below_root, "key")
    return within.unionByName(root.select("key", *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in _VALUES]))


def _end_digests(ends: DataFrame) -> DataFrame:
    """key and SHA-256 of the ascending conversation ids that end at the node, joined by commas.

    Ids are joined in blocks of 256 neighbouring numbers first; a node's blocks then stream through
    one hash in order, so no list of a node is ever held.
    """
    blocks = ends.groupBy("key", F.shiftright("conv_id", 8).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(digest, "key binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the prefix trie of rebuilt conversations.

    A conversation c is rebuilt from the first h turns of conversation c - c % 100 and its own turns after its first
    h, with h = crc32(decimal c) % 6. Result, all long but the digest: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless nodes in
    the subtree), saved_tokens (over the subtree, members but one times the code points of the node's last text),
    ends_sha256 (of the ids of the members that end there).

    Turns go in order of turn, null first; equal ones by a hash of role and text, so repeated rows are turns one
    after another. Null role or text is empty. Rows without conv_id are left out. A conversation left without turns
    is a member of the root alone. Other columns don't matter. No conversations: no rows.
    """
    if band < 2:
        raise ValueError("a band has two depths at least")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    turns = materialize(placed_turns(conversations).withColumn("heads", heads), "turns")
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    bases = counted.filter(f"conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = counted.withColumn("heads", heads).withColumn("base", family).join(bases, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_n", F.lit(0))))
    convs = materialize(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("heads"), F.lit(0))), "conversations")
    all_convs, first, deepest = convs.agg(F.count("*"), F.min("conv_id"), F.max("length")).first()
    deepest = deepest or 0

    rows = rebuilt_turns(turns, convs.drop("base_n"), band).withColumn("at", F.col("d") - 1)
    rows = rows.withColumns({"one": F.xxhash64("at", "x").cast(_WIDE), "two": F.xxhash64("x", "at", F.lit(2)).cast(_WIDE)})
    rows = _running(rows, max(deepest - 1, 0), band)
    key, parent = _key(F.col("d"), F.col("s1"), F.col("s2")), _key(F.col("at"), F.col("s1") - F.col("one"), F.col("s2") - F.col("two"))
    rows = rows.select("conv_id", "d", key.alias("key"), parent.alias("parent"), "chars", (F.col("d") == F.col("length")).alias("ends"))
    rows = materialize(_with_path(rows, band), "paths")

    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *[F.any_value(c).alias(c) for c in ("d", "parent", "chars", "path")],
    )
    spark = conversations.sparkSession
    zero = F.lit(0).cast("long")
    top = spark.range(1 if all_convs else 0).select(
        _key(zero, zero, zero).alias("key"), F.lit(first).cast("long").alias("conv_id"), F.lit(all_convs).cast("long").alias("n_convs"), zero.alias("d"),
        F.lit(None).cast("binary").alias("parent"), zero.alias("chars"), F.lit(None).cast("array<binary>").alias("path"),
    )
    nodes = materialize(nodes.unionByName(top), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    nodes = materialize(nodes, "counted")
    totals = _totals(nodes.select("key", "d", "path", *_VALUES), rows.select("conv_id", "d", "key", "path"), deepest, band)

    ends = rows.filter("ends").select("key", "conv_id").unionByName(convs.filter("length = 0").select(_key(zero, zero, zero).alias("key"), "conv_id"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    sums = totals.select("key", F.col("saved").alias("saved_tokens"), F.col("leaves").alias("n_leaves"))
    found = nodes.drop(*_VALUES).join(sums, "key").join(_end_digests(ends), "key", "left").join(parents, "parent", "left")
    return found.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
