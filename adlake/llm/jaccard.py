"""Similarity join on word n-grams: candidates share prefix tokens under several token orders.

A document's tokens are the 64-bit hashes of its distinct n-grams. In any order of all tokens, two
sets of Jaccard similarity t or more share one of their first n - ceil(t * n) + 1 tokens. The
orders here: rarest first, which makes the candidates, and two independent hash orders, which
candidates must pass too before their sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.components import components
from adlake.llm.text import CODES, LOWER, WHITE, Fingerprints, member, mix, pack, pack_small, per_row, slices, unpack, unpack_small, word_windows, words
from adlake.llm.units import cut, release, with_units
from adlake.session import materialize

SHINGLE_WORDS = 5
#: Similarity, in hundredths.
SIMILAR = 75
#: Rounds that compare the members of a token's list with one leader before all that is left is compared. Rounds after
#: the first are left out where no more than FEW_CANDIDATES pairs a member are left, which changes no result.
LEADER_ROUNDS = 3
FEW_CANDIDATES = 1

#: Seeds of the hash orders.
_ORDERS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))

_SENT = "bucket long, unit long, tokens binary, counts binary"
_SENT_ARROW = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
_COUNTS = "unit long, tokens binary, counts binary"
_COUNTS_ARROW = pa.schema([("unit", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
_SETS = "doc_id long, n long, s1 long, s2 long, alone long, prefix array<int>, shared binary, ends array<long>"
_SETS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("alone", pa.int64()),
    ("prefix", pa.list_(pa.int32())), ("shared", pa.binary()), ("ends", pa.list_(pa.int64())),
])


def _sets(unit: pa.Table, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice: first and last row, distinct shingle hashes of the rows, ascending within a row, and their rows."""
    inner, outer = Fingerprints(), Fingerprints()
    for first, last, data, bounds in slices(unit["text"]):
        data = LOWER[data]
        starts, ends, rows = words(data, bounds, WHITE)
        hashes = inner.ranges(inner.prefix(CODES[data]), starts, ends)
        found, at = word_windows(hashes, rows, size, outer)
        of, counts = rows[at], per_row(rows, last - first)
        parts, owners = [found], [of]
        for n in range(1, size):
            few = np.flatnonzero(counts == n)
            if len(few):
                found, at = word_windows(hashes, rows, n, outer)
                own = np.isin(rows[at], few)
                parts.append(found[own])
                owners.append(rows[at][own])
        tokens, owners = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((tokens, owners))
        tokens, owners = tokens[order], owners[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
        yield first, last, tokens[new], owners[new]


def _prefix_length(n: int) -> int:
    return n - (SIMILAR * n + 99) // 100 + 1


def shingle_sets(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (signature of the set), and what the join needs of it.

    alone: tokens that no other document holds; they come first in the rarest-first order. shared: all
    others, ascending. prefix: places in shared of those in the rarest-first prefix. Both are null where the
    prefix has none, as then no other set can be similar. ends: the last
    value of the prefix in each hash order. Document frequencies are counted over all documents.
    """
    docs, units = with_units(docs)
    buckets = max(1, units // 2)

    def send(unit: pa.Table) -> pa.Table:
        tokens = [tokens for _, _, tokens, _ in _sets(unit, size)]
        tokens, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *tokens]), return_counts=True)
        out = [(k, unit["unit"][0].as_py(), pack(tokens[a:b]), pack_small(counts[a:b])) for k, a, b in cut(tokens, buckets)]
        return pa.Table.from_pylist([dict(zip(_SENT_ARROW.names, x, strict=True)) for x in out], _SENT_ARROW)

    def count(bucket: pa.Table) -> pa.Table:
        parts = [unpack(x.as_py()) for x in bucket["tokens"]]
        of = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        tokens, counts = np.concatenate(parts), np.concatenate([unpack_small(x.as_py()) for x in bucket["counts"]])
        order = np.argsort(tokens, kind="stable")
        tokens, counts, of = tokens[order], counts[order], of[order]
        first = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]) != 0)
        total = np.repeat(np.add.reduceat(counts.astype(np.int64), first), np.diff(first, append=len(tokens)))
        more = total >= 2
        tokens, total, of = tokens[more], np.minimum(total[more], (1 << 32) - 1), of[more]
        out = [(bucket["unit"][int(k)].as_py(), pack(tokens[of == k]), pack_small(total[of == k])) for k in np.unique(of)]
        return pa.Table.from_pylist([dict(zip(_COUNTS_ARROW.names, x, strict=True)) for x in out], _COUNTS_ARROW)

    def build(unit: pa.Table, told: pa.Table) -> pa.Table:
        if not unit.num_rows:
            return _SETS_ARROW.empty_table()
        known = np.concatenate([np.zeros(0, np.uint64), *(unpack(x.as_py()) for x in told["tokens"])])
        counts = np.concatenate([np.zeros(0, np.uint32), *(unpack_small(x.as_py()) for x in told["counts"])])
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        ids, out = unit["doc_id"].to_pylist(), []
        for first, last, tokens, owners in _sets(unit, size):
            edges = np.searchsorted(owners, np.arange(last - first + 1))
            more = member(tokens, known)
            frequency = np.ones(len(tokens), np.uint32)
            frequency[more] = counts[np.searchsorted(known, tokens[more])]
            values = [mix(tokens ^ seed) for seed in _ORDERS]
            for k in range(last - first):
                own = slice(edges[k], edges[k + 1])
                n = int(edges[k + 1] - edges[k])
                mine, also = tokens[own], more[own]
                s1, s2 = (int(v[own].sum(dtype=np.uint64).view(np.int64)) for v in values)
                alone = n - int(also.sum())
                room = _prefix_length(n) - alone if n else 0
                prefix = shared = ends = None
                if room > 0:
                    held = mine[also]
                    prefix = np.lexsort((held, frequency[own][also]))[:room].astype(np.int32)
                    shared = pack(held)
                    # signed, so that Spark can hold it; read back as unsigned
                    last_of = _prefix_length(n) - 1
                    ends = [int(np.partition(v[own], last_of)[last_of].view(np.int64)) for v in values]
                out.append((ids[first + k], n, s1, s2, alone, prefix, shared, ends))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SETS_ARROW.types, strict=True)], schema=_SETS_ARROW)

    sent = docs.groupBy("unit").applyInArrow(send, _SENT)
    told = sent.groupBy("bucket").applyInArrow(count, _COUNTS)
    return docs.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(build, _SETS)


def prefix_tokens(sets: DataFrame) -> DataFrame:
    """doc_id, n, token, room of every prefix token; room: tokens of the set from this one on, in the rarest-first order."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch["prefix"]).to_numpy()
            prefixes = batch["prefix"].flatten().to_numpy()
            ends = np.cumsum(sizes)
            tokens = [unpack(blob.as_py())[prefixes[b - k : b]] for blob, k, b in zip(batch["shared"], sizes, ends, strict=True)]
            places = np.arange(len(prefixes)) - np.repeat(ends - sizes, sizes)
            of = [np.repeat(batch[name].to_numpy(), sizes) for name in ("doc_id", "n", "alone")]
            token = np.concatenate([np.zeros(0, np.uint64), *tokens]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (of[0], of[1], token, of[1] - of[2] - places)], names=["doc_id", "n", "token", "room"])

    return sets.select("doc_id", "n", "alone", "prefix", "shared").mapInArrow(unfold, "doc_id long, n long, token long, room long")


def _similar(x: tuple, y: tuple) -> bool:
    """Whether two sets (n, shared tokens, ends) are similar: first the prefixes of every order, then the sets."""
    (n, mine, ends), (m, other, others) = x, y
    for seed, a, b in zip(_ORDERS, ends, others, strict=True):
        end = np.array(sorted((a, b), key=lambda v: v % (1 << 64))[0], np.int64).view(np.uint64)
        if not member(mine[mix(mine ^ seed) <= end], other).any():
            return False
    both = int(member(mine, other).sum())
    return 100 * both >= SIMILAR * (n + m - both)


def similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar.

    Sets are joined to pairs, so a frequent document is split like any skewed key; both joins read one
    exchange of the sets.
    """
    own = sets.select("doc_id", "n", "shared", "ends")
    set_of = F.struct("n", "shared", "ends")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            us, vs, out = batch["u"].to_pylist(), batch["v"].to_pylist(), []
            xs, ys = batch["x"], batch["y"]
            for k, (u, v) in enumerate(zip(us, vs, strict=True)):
                if last[0] != v:
                    y = ys[k].as_py()
                    last = v, (y["n"], unpack(y["shared"]), y["ends"])
                x = xs[k].as_py()
                if _similar((x["n"], unpack(x["shared"]), x["ends"]), last[1]):
                    out.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["u", "v"])

    left = pairs.join(own, pairs["u"] == own["doc_id"]).select("u", "v", set_of.alias("x"))
    both = left.join(own, left["v"] == own["doc_id"]).select("u", "v", "x", set_of.alias("y"))
    return both.mapInArrow(verify, "u long, v long")


def similarity_components(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.75 or more of their word shingles, as components.

    Result: doc_id, n_shingles (set size), component_id (smallest doc_id reachable by links, itself included).
    Words are runs of bytes outside \\x20 and \\x09-\\x0D, in lower case of A-Z. A text of fewer words than
    a shingle is one shingle; null, empty and blank texts have an empty set and no links. Equal
    sets are always linked. Rows without doc_id are left out. Repeated rows each get a result; rows of
    different texts under one doc_id are one document with several sets, of which a link needs only one.
    Other columns don't matter. No documents: no rows.

    Equal sets go on as one representative. Comparing all members of a token's list would grow with the
    square of a group, so each list first meets one leader, then what is outside its largest
    component meets other leaders of that component; members that turn out to be of one component
    need no more comparison with each other. At last all candidates of different components are
    compared; none is dropped.
    """
    sets = materialize(shingle_sets(docs, size), "sets")
    classes = sets.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    reps = classes.select("s1", "s2", "n", F.col("rep").alias("doc_id"))
    own = ["doc_id", "s1", "s2", "n"]
    chosen = materialize(sets.filter("prefix is not null").join(reps, own, "left_semi").dropDuplicates(own), "representatives")
    rows = prefix_tokens(chosen)
    common = rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    rows = materialize(rows.join(common, "token", "left_semi"), "postings")
    total = rows.count()

    spark = docs.sparkSession
    release(spark)
    label = None
    for turn in range(LEADER_ROUNDS + 1):
        lists = rows.withColumn("comp", F.col("doc_id")) if label is None else _labelled(rows, label)
        if turn and turn < LEADER_ROUNDS and _candidates(lists) <= FEW_CANDIDATES * total:
            continue
        pairs = _all_candidates(lists) if turn == LEADER_ROUNDS else _with_leader(lists, turn)
        found = materialize(similar_pairs(pairs, chosen), "links")
        label = components(found if label is None else label.unionAll(found))
        release(spark)
    label = label.select(F.col("u").alias("rep"), F.col("v").alias("root"))
    members = classes.join(label, "rep", "left").select("s1", "s2", "n", F.coalesce("root", "rep").alias("root"))
    return sets.join(members, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def single_documents(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component of similar documents, of the smallest doc_id, with all columns.

    Cases as for ``similarity_components``; rows without doc_id go. Of several rows under one doc_id that of the smallest hash over
    all columns stays. Only such rows are shuffled for that; the others meet a list of doc_ids.
    """
    kept = similarity_components(docs, size).filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    own = F.col("doc_id").cast("long")
    again = materialize(docs.groupBy(own.alias("_again")).count().filter("count > 1 and _again is not null").select("_again"), "repeated")
    named = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own.alias("_id"), named)
    once = rows.join(again, rows["_id"] == again["_again"], "left_anti")
    place = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("row")))
    first = rows.join(again, rows["_id"] == again["_again"], "left_semi").withColumn("_place", place).filter("_place = 1").select("_id", "row")
    single = once.unionAll(first)
    return single.join(kept, single["_id"] == kept["_kept"], "left_semi").select("row.*")


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    known = label.select(F.col("u").alias("doc_id"), F.col("v").alias("root"))
    return rows.join(known, "doc_id", "left").withColumn("comp", F.coalesce("root", "doc_id")).drop("root")


def _may_be_similar(other: str) -> F.Column:
    """Whether a token can be the first that two similar sets share: no more than what follows it in both can be common."""
    room = F.least("room", f"{other}room")
    return (100 + SIMILAR) * room >= SIMILAR * (F.col("n") + F.col(f"{other}n"))


def _main_components(lists: DataFrame) -> DataFrame:
    """token, main (largest component of its list), few (members outside it), size; for lists of several components."""
    sizes = lists.groupBy("token", "comp").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("most"), F.sum("c").alias("size"))
    return largest.select("token", F.col("most.comp").alias("main"), (F.col("size") - F.col("most.c")).alias("few"), "size").filter("few > 0")


def _candidates(lists: DataFrame) -> int:
    """Pairs of tokens' lists that _all_candidates would meet at most."""
    return int(_main_components(lists).agg(F.sum(F.col("few").cast("decimal(38,0)") * F.col("size"))).first()[0] or 0)


def _with_leader(lists: DataFrame, turn: int) -> DataFrame:
    """Members of a token's list with a leader of its largest component, where they are outside it.

    At first every member is a component, and all lists of a document lead to few leaders; later each token has its own,
    a member that holds it as early as any: fewer of the others are then ruled out by its place.
    """
    place = F.xxhash64("doc_id") if not turn else F.struct(F.col("n") - F.col("room"), F.xxhash64(F.lit(turn), "token", "doc_id"))
    if turn:
        lists = lists.join(_main_components(lists).select("token", "main"), "token")
        led = lists.filter("comp = main")
    else:
        led = lists
    leaders = led.groupBy("token").agg(F.min(F.struct(place.alias("place"), "doc_id", "n", "room", "comp")).alias("l"))
    leaders = leaders.select("token", F.col("l.doc_id").alias("v"), F.col("l.n").alias("_n"), F.col("l.room").alias("_room"), F.col("l.comp").alias("_comp"))
    met = lists.join(leaders, "token").filter((F.col("comp") != F.col("_comp")) & _may_be_similar("_"))
    return met.select(F.col("doc_id").alias("u"), "v").distinct()


def _all_candidates(lists: DataFrame) -> DataFrame:
    """Every pair of one token's list that is of two components: what is outside a list's largest component meets the list."""
    lists = lists.join(_main_components(lists).select("token", "main"), "token")
    few = lists.filter("comp != main").select("token", F.col("doc_id").alias("u"), F.col("n").alias("_n"), F.col("room").alias("_room"), F.col("comp").alias("_comp"))
    once = (F.col("comp") == F.col("main")) | (F.col("u") < F.col("doc_id"))
    met = few.join(lists, "token").filter((F.col("comp") != F.col("_comp")) & once & _may_be_similar("_"))
    return met.select("u", F.col("doc_id").alias("v")).distinct()
