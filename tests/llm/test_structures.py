"""Packing, spelling variants and the conversation trie against plain versions."""

from collections import defaultdict

import brute
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlake.llm import packing, queries, spelling, trie
from adlake.llm.text import slices
from adlake.session import materialize


@pytest.fixture(scope="module")
def messy(spark):
    return brute.messy(spark)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# -- packing -------------------------------------------------------------------


def filled(packed, size=packing.SEQUENCE_TOKENS):
    """Sequences, after a look that each is gapless and not too long."""
    found = defaultdict(list)
    for r in packed:
        found[r.sequence_id].append((r.offset, r.length))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(found)


def test_pieces_equal_the_tokenizer(messy, tokenizer):
    packed = packing.packed_documents(messy).collect()
    docs = brute.documents(brute.messy_rows())
    assert sorted(tuple(r)[:5] for r in packed) == sorted(brute.pieces(docs, tokenizer))
    assert filled(packed) == -(-sum(r.length for r in packed) // packing.SEQUENCE_TOKENS)
    assert packing.packed_documents(messy.limit(0)).collect() == []


def test_words_equal_the_tokenizer(tokenizer):
    ids = packing.WordIds(public_tokenizers.path(packing.TOKENIZER))
    rng = np.random.default_rng(5)
    parts = [*"abZ'smtdlvre \n\t\x0b\x0c\x1c\x85\xa0 éÉßÿŸİıſK÷×日½²١.,#-_ﬁΣς", "é", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "'ll"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 50))) for _ in range(3000)]
    for text in [*texts, "", " ", "it's DON'T we'll 'S x'd'm <|ENDOFTEXT|> a<|endoftext|>b", "word " * 300_000]:
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_slices_of_texts_equal_the_tokenizer(tokenizer, monkeypatch):
    """Many texts at once, cut into chunks: two calls of the tokenizer a chunk for plain words and others."""
    monkeypatch.setattr(packing, "CHUNK_BYTES", 4000)
    known, calls = packing.WordIds(public_tokenizers.path(packing.TOKENIZER)), []
    monkeypatch.setattr(known, "_ids", lambda texts, ids=known._ids: calls.append(len(texts)) or ids(texts))
    rng = np.random.default_rng(9)
    parts = [*"abZ'smtdlvreÀßÿ \n\t9.,<|", "'ll", "'S", "it's ", " don't, ", "''re've", "'", " \xd7", "é", "日本", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(600)] + ["", " ", brute.prose("slice", 3000), "x"]
    column = pa.array([None, *(t.encode() for t in texts), b"\xc3 \xa9 \xc3", b"\xa9"], pa.binary())
    (_, _, data, bounds), = slices(column, 1 << 24)
    ids, counts = known.encode_texts(data, bounds)
    ends = np.cumsum(counts)
    expected = [tokenizer.encode((x.as_py() or b"").decode("utf-8", "replace"), add_special_tokens=False).ids for x in column]
    assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)] == expected
    assert len(calls) <= 2 * (len(data) // 4000 + 1)


def test_words_are_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    monkeypatch.setattr(packing, "KNOWN_PARTS", 2)
    ids, text = packing.WordIds(public_tokenizers.path(packing.TOKENIZER)), brute.prose("forgotten", 200)
    for _ in range(2):
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    before = len(ids.words)
    ids.encode(b"one")
    assert before > 100 and len(ids.words) == len(ids.parts) == 1


def test_best_fit_takes_the_fullest_bin():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sizes = rng.integers(1, 101, 200)
        bins, offsets, used = packing.best_fit(sizes, 100)
        held = []
        for size, own, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
            fits = [u for u in held if u + size <= 100]
            if fits:
                assert held[own] == max(fits) == offset
            else:
                assert own == len(held) and not offset
                held.append(0)
            held[own] += size
        assert held == used.tolist() and sum(2 * u <= 100 for u in held) <= 1


@pytest.mark.parametrize("kind", ["small", "large", "mixed"])
def test_tree_merges_underfull_bins(spark, kind):
    """Many nodes of few pieces and groups of two come close to one best fit over all pieces."""
    low, high = {"small": (1, 40), "large": (51, 100), "mixed": (1, 100)}[kind]
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.expr(f"{low} + pmod(xxhash64(id), {high - low + 1})").alias("length"), F.lit(0).alias("ids_crc32"))
    pieces = materialize(frame, "pieces")
    lengths = np.sort(np.array([r.length for r in pieces.collect()]))[::-1]
    packed = packing.pack_pieces(pieces, 100, 12, 2, 2).collect()
    assert len(packed) == 3000 and sorted(r.length for r in packed) == sorted(lengths.tolist())
    n, best = filled(packed, 100), len(packing.best_fit(lengths, 100)[2])
    assert n == best == 3000 if kind == "large" else n <= 1.12 * best
    alone = packing.pack_pieces(pieces, 100, 12, 1 << 20, 2).collect()
    assert n <= filled(alone, 100) + 250


def test_merging_loses_no_small_bin(spark):
    """Nodes end with one small bin each, which all find a host or each other."""
    frame = spark.range(64).select(F.col("id").alias("bin"), F.col("id").alias("node"), F.expr("if(id % 2 = 0, 40, 60)").alias("used"))
    moved = packing._merge(materialize(frame, "bins"), 6, 100, 2, 0).collect()
    assert len(moved) == 32 and len({r["head"] for r in moved}) == 32 and {r["shift"] for r in moved} == {60}
    heads = {r["head"] for r in moved}
    assert not heads & {r["bin"] for r in moved}


def test_sequences_hold_the_ids(messy, tokenizer):
    packed = materialize(packing.packed_documents(messy, size=64, with_ids=True), "packed")
    assert filled(packed.collect(), 64)
    held = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(packed).collect()}
    texts = defaultdict(list)
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.start)):
        texts[r.doc_id].append(held[r.sequence_id][r.offset : r.offset + r.length])
    for doc, text in brute.documents(brute.messy_rows()):
        if doc != 1:  # given twice
            assert [i for part in texts[doc] for i in part] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


# -- spelling ------------------------------------------------------------------


def test_spelling_on_awkward_rows(messy):
    docs = brute.documents(brute.messy_rows())
    assert rows(spelling.spelling_variants(messy)) == sorted(brute.spelling(docs), key=repr)
    assert spelling.spelling_variants(messy.limit(0)).collect() == []


def test_forms_and_roots(spark, monkeypatch):
    """Chains of forms, ties, anagrams and words of many lengths, searched in many small cells."""
    monkeypatch.setattr(spelling, "CELL_SAMPLE", 3)
    monkeypatch.setattr(spelling, "PAIRS", 50)
    monkeypatch.setattr(spelling, "BLOCK", 20)
    texts = [("running " * 3000) + ("runing " * 7) + ("runnings " * 250) + "runningss " * 20 + "runningsss runningsss", "abababab " * 40 + "babababa " * 40 + "abababba " * 4]
    rng = np.random.default_rng(8)
    texts += [" ".join("".join(rng.choice([*"abÀé"], rng.integers(6, 10))) for _ in range(600)) for _ in range(6)]
    texts += ["ÀÈÌÒÙÇÑ ÀÈÌÒÙÇÑx " * 3, "long" * 5000 + " " + "long" * 5000, None, "", "RUNNING Running"]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(spelling.spelling_variants(frame, cell_words=10)) == sorted(brute.spelling(docs), key=repr)
    trees = spelling.cell_trees(materialize(spelling.word_counts(frame), "words"), 10)
    assert max(len(tree.leaves) for tree in trees.values()) >= 4
    chain = {r.word: r.root for r in spelling.spelling_variants(frame).collect()}
    assert chain["runningsss"] == chain["runningss"] == "running"


def test_boxes_are_pruned_and_none_is_lost():
    rng = np.random.default_rng(9)
    points = spelling.letter_counts(rng.integers(97, 101, (400, 7)).astype(np.uint8))
    tree = spelling.Tree(points, 8)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(400))
    far = np.abs(points[:, None].astype(int) - points[None]).sum(axis=2)
    visited = 0
    for reach in (1, 2):
        seen = np.zeros((400, 400), bool)
        for leaf, own in tree.within(points, reach):
            seen[np.ix_(own, tree.leaves[leaf])] = True
        assert seen[far <= reach].all()
        visited = seen.mean()
    assert visited < 0.8


# -- trie ----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth long, key string, path string, i long"


def messy_turns():
    deep = [(500, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(90)]
    same = [(c, t, "user", text) for c in (101, 102, 103, 199, 201, 777) for t, text in enumerate(["hi", "there", "é\U0001f600", "", "x"])]
    odd = [
        (100, 0, None, None), (100, 1, "user", "base"), (100, None, "user", "first of all"), (104, 5, "a", "bc"), (104, 5, "ab", "c"), (104, 5, "ab", "c"),
        (105, 0, "user", None), (501, 3, "user", "turn 3"), (599, 0, "late", "one"), (-7, 0, "user", "below zero"), (None, 0, "user", "nobody"), (700, 1, "", ""),
    ]
    return [(*r, 1, "key", "path", 2) for r in [*deep, *same, *odd, *odd[:4]]]


@pytest.mark.parametrize("band", [2, 7, 16])
def test_trie_on_awkward_rows(spark, band):
    turns = messy_turns()
    frame = spark.createDataFrame(turns, TURNS)
    found = rows(trie.conversation_trie(frame, band))
    assert found == sorted(brute.trie([r[:4] for r in turns]), key=repr)
    assert max(r[1] for r in found) == 90


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x", 1, "", "", 1)], TURNS)).collect() == []


def test_conversations_without_turns(spark):
    """All that is left of them are members of the root."""
    from zlib import crc32

    ids = [c for c in range(100, 200) if crc32(str(c).encode()) % 6 == 5][:4]
    turns = [(c, 0, "user", "x", 0, "", "", 0) for c in ids if c % 100]
    found = rows(trie.conversation_trie(spark.createDataFrame(turns, TURNS)))
    assert found == sorted(brute.trie([r[:4] for r in turns]), key=repr) and len(found) == 1


def test_hot_conversation_is_split(spark):
    """A conversation with a third of all rows, in many ranges and blocks."""
    turns = [(300, t, "user", f"t{t % 7}", 0, "", "", 0) for t in range(700)] + [(c, t, "user", f"t{t % 7}", 0, "", "", 0) for c in range(301, 340) for t in range(36)]
    found = rows(trie.conversation_trie(spark.createDataFrame(turns, TURNS).repartition(5), 8))
    assert found == sorted(brute.trie([r[:4] for r in turns]), key=repr)


def test_digest_streams_over_blocks(spark):
    ends = spark.range(2000).select(F.lit(b"k").alias("key"), (F.col("id") * 37 - 5000).alias("conv_id"))
    (found,) = trie._end_digests(ends.unionByName(spark.range(0).select(F.lit(b"l").alias("key"), F.col("id").alias("conv_id")))).collect()
    assert found.ends_sha256 == brute.sha(",".join(str(37 * i - 5000) for i in range(2000)))


# -- queries -------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_conversation_trie"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    told = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in told.description]
    frame = queries.QUERIES[name](spark, TESTDATA)
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.select(*columns)) == sorted(told.fetchall(), key=repr)


def test_packing_query(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    packed = queries.QUERIES["op11_best_fit_packing"](spark, TESTDATA).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(brute.pieces(docs, tokenizer))
    assert filled(packed) == -(-sum(r.length for r in packed) // packing.SEQUENCE_TOKENS)
