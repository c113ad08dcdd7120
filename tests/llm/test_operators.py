"""Every dealt operator against a plain version, over awkward rows, empty tables and small real ones."""

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from adlake.llm import decontaminate, embedding, jaccard, language, licenses, mixing, queries, rules, substrings, suffixes, units, wavelet
from adlake.llm.components import components
from adlake.llm.text import Fingerprints, Rolling, pack, pack_small, slices, unpack, unpack_small, words

#: Enough labelled rows to learn from.
MORE = TESTDATA.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def messy(spark):
    return brute.messy(spark)


@pytest.fixture(scope="module")
def docs():
    return brute.documents(brute.messy_rows())


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{TESTDATA}/documents.parquet")


@pytest.fixture(autouse=True)
def small_units(monkeypatch):
    """Several units and buckets, so that the exchange between them is at work."""
    whole = units.with_units
    for module in (substrings, suffixes, jaccard):
        monkeypatch.setattr(module, "with_units", lambda d: whole(d, 40_000))


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def real_docs(real):
    return sorted((r.doc_id, r.text or "") for r in real.collect())


def benchmark(spark, more=()):
    items = [(1, brute.ITEM), (2, " ".join(brute.ITEM.split()[3:])), (10, "one two"), (11, None), (12, " "), (None, brute.PASSAGE), (1, brute.ITEM), *more]
    return spark.createDataFrame(items, "item_id long, text string"), [x for x in items if x[0] is not None]


def test_words_and_blobs():
    import pyarrow as pa

    text = pa.array(["a bc", None, "", "  d\x0be ", "f"])
    found = []
    for first, _, data, bounds in slices(text, 4):
        starts, ends, of = words(data, bounds, np.isin(np.arange(256), [0x20, *range(9, 14)]))
        found += [(first + r, bytes(data[a:b])) for a, b, r in zip(starts, ends, of, strict=True)]
    assert found == [(0, b"a"), (0, b"bc"), (3, b"d"), (3, b"e"), (4, b"f")]
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 999, dtype=np.uint64))
    assert (unpack(pack(values)) == values).all() and len(unpack(pack(values[:0]))) == 0
    small = np.array([5, 1, 1 << 31], np.uint32)
    assert (unpack_small(pack_small(small)) == small).all()
    rolling, codes = Rolling(), np.random.default_rng(2).integers(0, 1 << 64, 50, dtype=np.uint64)
    twice = rolling.windows(np.concatenate([codes, codes]), 50)
    assert twice[0] == twice[-1] and len(set(twice.tolist())) == 50


# -- 1 -------------------------------------------------------------------------


def test_tokens_equal_the_tokenizer(spark, messy, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(wavelet, "RANGE_BYTES", 60_000)
    monkeypatch.setattr(wavelet, "RUN_BYTES", 500)
    odd = spark.createDataFrame([(900, "a<|endoftext|> b \n c  d\n\n e "), (901, "it's 12　x\x85 y\xa0 z\r\nq\t\tw")], "doc_id long, text string")
    both = messy.select("doc_id", "text").unionAll(odd)
    path = wavelet.token_path(spark, "test")
    wavelet.write_tokens(both, path, shard_tokens=20_000)
    found = rows(wavelet.read_documents(spark, path), "start", "doc_id", "n_tokens", "ids_crc32")
    tokenizer, place, expected, every = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER)), 0, [], []
    for i, text in sorted((r.doc_id, r.text or "") for r in both.collect() if r.doc_id is not None):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        expected.append((place, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        place += len(ids)
        every += ids
    assert found == expected
    shards = rows(wavelet.read_shards(spark, path), "part", "shard", "n_tokens")
    assert len(shards) > 2 and len({p for p, *_ in shards}) > 1
    counts = wavelet.token_counts(spark, path, [2, 50256, 13]).groupBy("token").agg(F.sum("count").alias("n"))
    assert rows(counts, "token", "n") == sorted((t, every.count(t)) for t in (2, 50256, 13))
    starts = wavelet.shard_starts(wavelet.read_shards(spark, path))
    at = wavelet.occurrences(spark, path, 2).join(starts, ["part", "shard"]).select((F.col("start") + F.col("place")).alias("p"))
    assert [p for (p,) in rows(at, "p")] == [k for k, t in enumerate(every) if t == 2]


def test_wavelet_matrix_answers():
    ids = np.random.default_rng(3).integers(0, 300, 3000)
    matrix = wavelet.WaveletMatrix.of(ids, 9)
    assert (matrix.ids() == ids).all() and all(matrix.access(k) == ids[k] for k in range(0, 3000, 7))
    for token in (0, 7, 299, 511, 5000, -1):
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert [matrix.rank(token, p) for p in (0, 1, 512, 2999, 3000)] == [int((ids[:p] == token).sum()) for p in (0, 1, 512, 2999, 3000)]
        assert [matrix.select(token, k) for k in range(len(places))] == places.tolist() and matrix.select(token, len(places)) == -1
    assert len(wavelet.WaveletMatrix.of(ids[:0], 9).ids()) == 0


# -- 2, 8 ----------------------------------------------------------------------


def test_language_of_held_out_texts(spark, real, messy):
    found = language.predicted_languages(real).join(real.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == real.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in found)
    odd = {r.doc_id: r for r in language.predicted_languages(messy).collect()}
    assert sorted(odd) == sorted({i for i, _ in brute.documents(brute.messy_rows())})
    assert {i for i, r in odd.items() if r.lang_pred == "und"} == {5, 6, 7} and odd[5].score == 0
    none = messy.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predicted_languages(none).collect()} == {"und"}


def test_kernel_counts_common_grams():
    import pyarrow as pa

    (_, _, present), = language.Presence().scan(pa.array(["abc", "ABC", "xyz!", None]))
    values = language.kernel(present, present)
    assert values[0, 1] == pytest.approx(1) and values[0, 2] < 0.2 and values[3].max() == 0
    assert present[0].sum() == 6  # a, b, c, ab, bc, abc


def test_quality_of_held_out_texts(spark, messy):
    real, labels = (spark.read.parquet(f"{MORE}/{name}.parquet") for name in ("documents", "labels"))
    scores = embedding.quality_scores(real, labels)
    found = scores.join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    kept = embedding.of_quality(real, labels)
    assert kept.schema == real.schema and rows(kept, "doc_id") == rows(scores.filter("predicted = 1"), "doc_id")
    odd = embedding.quality_scores(messy, spark.createDataFrame([(1, 1), (8, 0), (8, 1), (None, 1), (3, None), (99, 0)], "doc_id long, quality int")).collect()
    assert len(odd) == len(brute.documents(brute.messy_rows())) and {r.score for r in odd if r.doc_id in (5, 6, 7)} == {0.5}
    assert embedding.of_quality(messy, labels.limit(0)).columns == messy.columns
    assert {r.score for r in embedding.quality_scores(messy, labels.limit(0)).collect()} == {0.5}


# -- 3, 7 ----------------------------------------------------------------------


@pytest.mark.parametrize("length", [400, 37])
def test_substrings_that_occur_twice(messy, docs, length):
    found = suffixes.repeated_substrings(messy, length)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed_substrings(docs, length)
    for r in found.collect():
        assert brute.sha(bytes(r.kept)) == r.kept_sha256 and sum(s.last - s.first for s in r.spans) == r.n_removed


def test_substrings_in_real_texts(real):
    found = suffixes.repeated_substrings(real, whole=False)
    expected = brute.removed_substrings(real_docs(real), 400)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected and sum(x[2] for x in expected) > 0


def test_names_double_up():
    data = np.frombuffer(b"abcabcabc" * 30, np.uint8)
    for length in (3, 37, 64, 200):
        names = suffixes.names_of(data, length, Fingerprints())
        strings = [bytes(data[k : k + length]) for k in range(len(data) - length + 1)]
        assert len(names) == len(strings) and len(set(zip(names.tolist(), strings, strict=True))) == len(set(strings)) == len(set(names.tolist()))
    values = np.random.default_rng(4).integers(0, 5, 200)
    for width in (1, 2, 7, 16):
        assert suffixes._leftmost_smallest(values, width).tolist() == [k + int(values[k : k + width].argmin()) for k in range(200 - width + 1)]


def test_windows_of_earlier_documents(messy, docs):
    found = substrings.repeated_windows(messy)
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.removed_windows(docs, 13)
    for r in found.collect():
        assert brute.sha(r.kept) == r.kept_sha256 and sum(s.last - s.first for s in r.spans) == r.n_removed
    assert all(x.kept is None for x in substrings.repeated_windows(messy, 5, whole=False).collect())


# -- 4 -------------------------------------------------------------------------


def test_similar_documents(messy, docs):
    found = rows(jaccard.similarity_components(messy), "doc_id", "n_shingles", "component_id")
    assert found == brute.similarity_classes(docs)
    kept = jaccard.single_documents(messy)
    assert kept.columns == messy.columns
    assert {i for (i,) in rows(kept, "doc_id")} == {i for i, _, c in found if i == c}


def test_similar_documents_without_leaders(spark, monkeypatch):
    """A large group of near copies and documents that share half their words, also when all candidates are compared at once."""
    base = brute.prose("group", 120).split()
    texts = []
    for k in range(60):
        own = list(base)
        own[(7 * k) % 120] = f"changed{k}"
        own[(13 * k + 5) % 120] = f"other{k}"
        texts.append(" ".join(own))
    texts += [" ".join(base[:60]) + " " + brute.prose(k, 55) for k in range(20)] + [" ".join(base[: 115 - k]) for k in range(0, 40, 3)]
    rows_ = [(1000 - k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    expected = brute.similarity_classes(sorted(rows_))
    assert len({c for *_, c in expected}) > 10
    for turns in (jaccard.LEADER_ROUNDS, 0):
        monkeypatch.setattr(jaccard, "LEADER_ROUNDS", turns)
        assert rows(jaccard.similarity_components(frame), "doc_id", "n_shingles", "component_id") == expected


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 105), (105, 103), (103, 100), (7, 7), (200, 201)]
    found = dict(rows(components(spark.createDataFrame(links, "u long, v long")), "u", "v"))
    assert found == {**{k: 0 for k in range(1, 41)}, 105: 100, 103: 100, 201: 200}


# -- 5 -------------------------------------------------------------------------


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "s", 100), ("a", "x", "t", 10), ("a", "y", "s", 30), ("b", "x", "s", 1000), ("b", "x", "", 0), ("c", "z", "s", 5)]
    weights = [("a", None, None, 5), ("b", None, None, 1), ("a", "x", "t", 9), ("c", "z", "s", 0), ("a", "x", "t", 2)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, n long")
    given = spark.createDataFrame(weights, "domain string, lang string, source string, weight int")
    found = {(r.domain, r.lang, r.source): r.share for r in mixing.budgets(frame, given, percent=30, max_epochs=2).collect()}
    weight = {tuple(x for x in w[:3] if x is not None): w[3] for w in sorted(weights, key=lambda w: w[3])}
    total, expected = sum(x[3] for x in leaves) * 30 // 100, {}

    def fill(prefix, budget):
        if len(prefix) == 3:
            expected[prefix] = budget
            return
        children = {x[: len(prefix) + 1] for x in leaves if x[: len(prefix)] == prefix}
        caps = {c: (weight.get(c, 1), 2 * sum(x[3] for x in leaves if x[: len(c)] == c)) for c in children}
        for child, share in brute.shares(budget, caps).items():
            fill(child, share)

    fill((), total)
    assert found == expected and found["a", "x", "t"] == 20


def test_mix_of_awkward_rows(spark, messy, docs):
    found = mixing.mixed(messy, percent=60, max_epochs=2)
    uses = found.collect()
    total = sum(len(brute.words(t)) for _, t in docs)
    assert 0.6 * total - 20 <= sum(r.taken for r in uses) <= 0.6 * total
    assert all(0 <= r.taken <= r.n_tokens and r.epoch < 2 for r in uses)
    cut = [r for r in uses if r.taken < r.n_tokens]
    assert len(cut) <= len({(r.domain, r.lang, r.source) for r in uses})
    some = mixing.mixed_documents(messy, percent=60)
    assert some.columns == messy.columns and 0 < some.count() < messy.count()
    assert rows(mixing.mixed_documents(messy), "doc_id") == sorted((i,) for i, t in docs if brute.words(t))


def test_every_language_is_learnt(spark):
    """More languages than were learnt before, most of them rare."""
    def text(lang, k):
        vocabulary = [f"{zlib.crc32(f'{lang}:{w}'.encode()):x}".translate(str.maketrans("0123456789", "ghijklmnop")) for w in range(12)]
        return " ".join(vocabulary[zlib.crc32(f"{k}:{w}".encode()) % 12] for w in range(30))

    rows = [(lang * 100 + k, f"l{lang}", text(lang, k)) for lang in range(300) for k in range(6 if lang < 250 else 4)]
    found = language.predicted_languages(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()
    learnt = {i // 100 for i, *_ in rows if zlib.crc32(str(i).encode()) % language.FOLDS != language.HELD_OUT}
    assert len(learnt) > 256
    right = [r.lang_pred == f"l{r.doc_id // 100}" for r in found if r.doc_id // 100 in learnt]
    assert {r.lang_pred for r in found} == {f"l{k}" for k in learnt} and np.mean(right) > 0.95


# -- 6 -------------------------------------------------------------------------


def test_licences_of_files_and_directories(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        (1, "p/LICENSE", mit), (2, "p/a/code.txt", brute.prose(1, 40)), (3, "p/b/LICENSE", apache + "\nand so on"), (4, "p/b/c/d/x", None),
        (5, "p/b/e", brute.prose(2, 30) + "\n" + mit + "\n" + brute.prose(3, 30)), (6, "q/f", "no licence here"), (7, None, ""), (8, "p/b/e2", ""),
        (9, "p/z/LICENSE.mit", mit), (10, "p/z/LICENSE.apache", apache), (11, "p/z/f", "x"), (4, "p/b/c/d/x", None), (12, "p/bb/f", "y"),
    ]
    frame = spark.createDataFrame(files, "file long, path string, text string").withColumn("at", F.lit(1))
    found = {r.file: r for r in licenses.licences(frame).collect()}
    counted = brute.frequencies(licenses.TEMPLATES, [t or "" for *_, t in files])
    for i, _, text in files:
        score, name = brute.best_template(text or "", licenses.TEMPLATES, counted, licenses.SIMILAR)
        if name:
            assert (found[i].licence, found[i].origin) == (name, "header") and found[i].score == pytest.approx(score, abs=1e-5)
    inherited = {i: (r.licence, r.directory) for i, r in found.items() if r.origin == "inherited"}
    assert inherited == {2: ("MIT", "p"), 4: ("Apache-2.0", "p/b"), 8: ("Apache-2.0", "p/b"), 11: ("Apache-2.0", "p/z"), 12: ("MIT", "p")}
    assert {i for i, r in found.items() if r.origin == "none"} == {6, 7} and licenses.licences(frame).count() == len(files)


def test_licences_in_real_texts(spark, real):
    found = {r.doc_id: r for r in queries.op6_license_scan(spark, TESTDATA).collect()}
    counted, stated = brute.frequencies(licenses.TEMPLATES, [t for _, t in real_docs(real)]), 0
    for i, text in real_docs(real):
        lines = [x for x in text.split("\n") if len(x) < 200]  # no template is a fifth as long
        score, name = brute.best_template("\n".join(lines), licenses.TEMPLATES, counted, licenses.SIMILAR)
        assert (found[i].origin == "header") == (name is not None)
        if name:
            stated += 1
            assert found[i].licence == name and found[i].score == pytest.approx(score, abs=1e-5)
    assert stated >= 3


def test_licences_at_every_size(spark):
    """Every planted notice is found, and the score of a line does not follow the frequency of template words it lacks."""
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0.",
               "This work is licensed under the GNU General Public License, version 3."]
    for folder in (MORE, TESTDATA.replace("sf0.001", "sf0.1")):
        planted = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if set((r.text or "").split("\n")) & set(notices)}
        found = {r.doc_id for r in queries.op6_license_scan(spark, folder).filter("origin = 'header'").select("doc_id").collect()}
        assert planted and planted <= found
    template, scores = [("proprietary", "Copyright. All rights reserved.")], set()
    for n in (3, 300):
        files = [(1, "a", "All rights reserved."), *[(k + 2, "b", "copyright" if n == 3 else "words alone") for k in range(n)]]
        found = licenses.licences(spark.createDataFrame(files, "file long, path string, text string"), template)
        scores |= {r.score for r in found.filter("file = 1").collect()}
    assert len(scores) == 1 and min(scores) >= licenses.SIMILAR


def test_licence_texts_and_wrapped_headers(spark):
    """Whole licence files, headers over several lines and usual short forms, among many texts."""
    import textwrap

    def header(name, start, mark):
        text = next(x for n, x in licenses.TEMPLATES if n == name and x.startswith(start))
        return "\n".join(f"{mark} {x}".rstrip() for part in text.split("\n") for x in [*textwrap.wrap(part, 60), ""])

    code = "\n".join(f"{brute.prose(k, 6)};" for k in range(200, 260))
    stated = {
        "s/a": ("MIT", "MIT License"), "s/b": ("MIT", "This file is released under the MIT License."), "s/c": ("GPL", "GNU GENERAL PUBLIC LICENSE"),
        "s/d": ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0\n" + code), "s/e": ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"),
        "s/f": ("Apache-2.0", "#!/usr/bin/env python\n# Copyright 2020 Some Body\n#\n" + header("Apache-2.0", "Licensed under the Apache License, Version 2.0 (", "#") + "\nimport os\n" + code),
        "s/g": ("LGPL-2.1", code + "\n/*\n" + header("LGPL-2.1", "This library", " *") + " */\n" + code),
        "s/h": ("MPL-2.0", header("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\n", "//") + "\n" + code),
        "s/i": ("Apache-2.0", code + "\nLicensed under the\nApache License, Version 2.0.\n\n" + code),
    }
    files = [(path, text) for path, (_, text) in stated.items()]
    for name, text in licenses.licence_texts():
        files += [(f"w/{name}/LICENSE", "Copyright (c) 2019 Some Body\n\n" + text), (f"w/{name}/code/file", brute.prose(1, 50))]
    files += [(f"n/{k}", brute.prose(k, 100) + "\nthe license of the software") for k in range(300)]
    frame = spark.createDataFrame(files, "path string, text string").withColumn("file", F.col("path"))
    found = {r.path: r for r in licenses.licences(frame).collect()}
    assert {p: (found[p].licence, found[p].origin) for p in stated} == {p: (name, "header") for p, (name, _) in stated.items()}
    for name, _ in licenses.licence_texts():
        assert (found[f"w/{name}/LICENSE"].licence, found[f"w/{name}/LICENSE"].origin) == (name, "header")
        assert (found[f"w/{name}/code/file"].licence, found[f"w/{name}/code/file"].directory) == (name, f"w/{name}")
    assert {found[f"n/{k}"].origin for k in range(300)} == {"none"}


def test_licences_weigh_every_word(spark):
    """Words outside the templates weigh by their own document frequency."""
    common, rare = brute.prose(5, 4), brute.prose(6, 4)
    files = [(1, "a/1", f"Released under the MIT License, {common}."), (2, "b/2", f"Released under the MIT License, {rare}."), *[(k, "c/3", f"x{k} {common}") for k in range(3, 300)]]
    found = {r.file: r for r in licenses.licences(spark.createDataFrame(files, "file long, path string, text string")).collect()}
    stated, extra = np.log(300 / 3) + 1, np.log(300 / 299) + 1
    assert found[1].licence == "MIT" and found[1].score == pytest.approx(np.sqrt(5 * stated**2 / (5 * stated**2 + 4 * extra**2)), abs=1e-6)
    assert found[2].origin == "none"


# -- 9, 10 ---------------------------------------------------------------------


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1500])
def test_contamination(spark, messy, docs, block):
    frame, items = benchmark(spark)
    found = decontaminate.contamination(messy, frame, block_bytes=block)
    expected = brute.contaminated(docs, items)
    assert rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected
    kept = decontaminate.without_contaminated(messy, frame, block_bytes=block)
    bad = {x[0] for x in expected if x[-1]}
    assert kept.columns == messy.columns and bad and {r.doc_id for r in kept.collect()} == {r[0] for r in brute.messy_rows()} - bad


def test_contamination_without_items(spark, messy):
    frame, _ = benchmark(spark)
    found = decontaminate.contamination(messy, frame.limit(0)).collect()
    assert found and not any(r.n_hit or r.contaminated for r in found)


def test_rules_count_and_judge(spark, messy, docs):
    trusted = spark.createDataFrame([(1,), (1,), (11,), (12,), (None,), (77,)], "doc_id long")
    found = rules.quality_rules(messy, trusted, threshold=0.0, buckets=64)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(found, *columns) == sorted((i, *brute.base_rules(t)) for i, t in docs)
    assert all(r.kept == (not r.base_failed and r.llr >= 0.0) for r in found.collect())


def test_ratios_equal_plain_counts(spark, messy, docs):
    trusted = spark.createDataFrame([(1,), (11,)], "trusted_id long")
    counts = {r.bucket: (r.raw, r.target) for r in rules.gram_counts(messy, trusted, 64).collect()}
    grams = sum(max(2 * len(brute.words(t)) - 1, 0) for _, t in docs)
    assert sum(r for r, _ in counts.values()) == grams
    own = [t for i, t in docs if i in (1, 11)]
    assert sum(t for _, t in counts.values()) == sum(2 * len(brute.words(t)) - 1 for t in own)
    ratios = rules.log_ratios(rules.gram_counts(messy, trusted, 64), 64)
    bucket, (raw, target) = next(iter(counts.items()))
    total = sum(t for _, t in counts.values())
    assert ratios[bucket] == pytest.approx(np.log((target + 1) / (total + 64)) - np.log((raw + 1) / (grams + 64)))


def test_rules_on_real_texts(spark, real):
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    found = {r.doc_id: r for r in rules.quality_rules(real, labels.filter("quality = 1")).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    good = [found[i].kept for i, q in marks.items() if q and not found[i].base_failed]
    assert sum(good) >= 0.95 * len(good)
    bad = [found[i].kept for i, q in marks.items() if not q]
    assert sum(bad) <= 0.5 * len(bad)
    again = {r.doc_id: r.kept for r in rules.quality_rules(real, labels.filter("quality = 1")).collect()}
    assert again == {i: r.kept for i, r in found.items()}


# -- all -----------------------------------------------------------------------


def test_empty_tables(spark, messy):
    none, labels = messy.limit(0), spark.createDataFrame([], "doc_id long, quality int")
    frame, _ = benchmark(spark)
    found = [
        wavelet.tokenized(none), language.predicted_languages(none), suffixes.repeated_substrings(none), jaccard.similarity_components(none),
        mixing.mixed(none), mixing.mixed_documents(none), licenses.licences(none.select(F.col("doc_id").alias("file"), "path", "text")),
        substrings.repeated_windows(none), embedding.quality_scores(none, labels), embedding.of_quality(none, labels),
        decontaminate.contamination(none, frame), rules.quality_rules(none, labels), jaccard.single_documents(none),
    ]
    for frame in found:
        assert frame.collect() == [] and len(frame.columns) > 2
