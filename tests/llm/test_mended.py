"""Cases that once crashed or gave wrong rows."""

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adlake.llm import jaccard, language, rules, substrings, suffixes, wavelet
from adlake.llm.text import CODES, Fingerprints, Rolling, slices


def encoded(encoder, texts):
    import pyarrow as pa

    out = []
    for _, _, data, bounds in slices(pa.array(texts)):
        ids, counts = encoder.encode(data, bounds)
        ends = np.cumsum(counts)
        out += [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)]
    return out


def test_one_word_texts_are_encoded(spark):
    rows = [(1, "hello"), (2, "world"), (3, None), (4, ""), (5, " ")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER))
    found = wavelet.tokenized(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_tokens for r in found] == [1 + len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows]


@pytest.mark.parametrize("texts", [["the cat sat on", "A cat sat"], ["one", "two", "one two", "two"], ["x y", "y x", "\n", "x"]])
def test_warm_encoders_encode_any_slice(texts):
    """Every text in a slice of its own, by an encoder that knows those before."""
    path = public_tokenizers.path(wavelet.TOKENIZER)
    encoder, tokenizer = wavelet.Encoder(path), Tokenizer.from_file(path)
    for text in [*texts, *reversed(texts)]:
        assert encoded(encoder, [text]) == [tokenizer.encode(text, add_special_tokens=False).ids]


def test_words_before_signs_are_encoded_once():
    """A word is one piece whatever sign follows it, and ids stay the tokenizer's where a cut would be wrong."""
    path = public_tokenizers.path(wavelet.TOKENIZER)
    encoder, tokenizer = wavelet.Encoder(path), Tokenizer.from_file(path)
    words, signs = [f"word{'x' * k}é" for k in range(20)], "!#$%&()*+,-./:;=?@"
    texts = [f"a {word}{sign} b" for word in words for sign in signs]
    odd = ["<|endoftext|>", "a<|endoftext|>,b", "<|endof,text|>", "it's 'S ''s, x's.", "\xd7, \xf7. a\xd7, 1, é, e\u0301, ª,", "a|b>c<d", "Ω, ж. 日,"]
    assert encoded(encoder, texts + odd) == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts + odd]
    encoder.known.clear()
    assert encoded(encoder, texts) and len(encoder.known) == len(words) + len(signs) + 2


def test_numbers_are_no_letters(spark):
    docs = [(3 * k, f"the words of it and more {k}", "en") for k in range(9)] + [(101, "½ ² ① 12", "en"), (102, "é", "en"), (103, "_ 7", "en"), (104, "½ a", None), (105, "日", None)]
    found = {r.doc_id: r.lang_pred for r in language.predicted_languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert [found[k] for k in (101, 102, 103, 104, 105)] == ["und", "en", "und", "en", "en"]
    assert not language.has_letter("½ ² ① _ 9 ٣") and language.has_letter("① ʰ")


def test_the_sample_holds_repeated_rows_once_a_place(spark):
    a, b, c, d = [k for k in range(1, 30) if zlib.crc32(str(k).encode()) % language.FOLDS != language.HELD_OUT][:4]
    docs = [(a, "some text here", "en")] * 5 + [(b, "other text", "en"), (c, "autre texte", "fr"), (c, None, "fr"), (d, "12", "fr")]
    sample = language.training_sample(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert [(lang, place) for lang, place, _ in sample] == [*(("en", k) for k in range(1, 7)), ("fr", 1)]


def test_one_row_of_a_document_stays(spark):
    """Fifty documents given twice, some of them under other columns, and one group of copies."""
    rows = [(k, brute.prose(k % 45, 30), k * 10 + again * (k % 3)) for k in range(50) for again in (0, 1)]
    rows += [(None, brute.prose(1, 30), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other long")
    kept = jaccard.single_documents(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted(r.doc_id for r in found) == list(range(45)) and {tuple(r) for r in found} <= set(rows)
    assert sorted(map(tuple, found)) == sorted(map(tuple, jaccard.single_documents(docs.repartition(5)).collect()))


def test_stages_keep_the_values_of_rows(spark):
    """Rows come out of the stages as they went in, whatever their other columns are called."""
    docs = brute.messy(spark).withColumn("Domain_", F.lit("mine"))
    given = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, TESTDATA)
        assert found.columns == docs.columns and {tuple(r) for r in found.collect()} <= given, name


@pytest.mark.parametrize("edits", [4, None])
def test_crowds_of_near_copies(spark, monkeypatch, edits):
    """Large groups of near copies in which most pairs are not similar: four edits each give many components, up to three one."""
    base = brute.prose("crowd", 150).split()
    texts = []
    for k in range(300):
        own = list(base)
        for j in range(edits or k % 4):
            own[(17 * k + 41 * j + k * k * (j + 1)) % 150] = f"changed{k}x{j}"
        texts.append(" ".join(own))
    rows_ = list(enumerate(texts))
    expected = brute.similarity_classes(rows_)
    assert (len({c for *_, c in expected}) > 50) == (edits == 4)
    monkeypatch.setattr(jaccard, "FEW_CANDIDATES", 0)
    found = jaccard.similarity_components(spark.createDataFrame(rows_, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == expected


def alternating(n, a="a", b="b"):
    """The first n letters of the Thue-Morse sequence: with a and b exchanged, equal under any polynomial hash modulo 2**64."""
    return "".join((a, b)[k.bit_count() & 1] for k in range(n))


#: Two words, two lines, two runs of words, two plain texts of 2048 letters or words each, which hashes must tell apart.
SIMILAR = [alternating(2048), alternating(2048, "b", "a")]
IN_LINES = [f"{a} and\n{b} and\n{a} and" for a, b in (SIMILAR, SIMILAR[::-1])]
IN_WORDS = [alternating(1024, "left ", "right "), alternating(1024, "right ", "left ")]
ALIKE = [*SIMILAR, *IN_LINES, *IN_WORDS, *(f"{x} {brute.prose('same', 14)} {y}" for x, y in (SIMILAR, SIMILAR[::-1]))]


def test_fingerprints_tell_alternating_texts_apart():
    one, two = (CODES[np.frombuffer(x.encode(), np.uint8)] for x in SIMILAR)

    def whole(hashes, codes):
        return hashes.ranges(hashes.prefix(codes), np.array([0]), np.array([len(codes)]))[0]

    assert whole(Rolling(), one) == whole(Rolling(), two)  # why Rolling must not stand for strings
    assert whole(Fingerprints(), one) != whole(Fingerprints(), two)


def test_fingerprints_are_those_of_their_definition():
    codes = np.random.default_rng(3).integers(0, 1 << 64, 200, dtype=np.uint64)
    codes[50:60] = codes[150:160]
    hashes = Fingerprints()
    sums = hashes.prefix(codes)
    first, last = (x.ravel() for x in np.triu_indices(201, 1))
    found = hashes.ranges(sums, first, last)
    strings = [tuple(codes[a:b].tolist()) for a, b in zip(first, last, strict=True)]
    assert len(set(zip(found.tolist(), strings, strict=True))) == len(set(strings)) == len(set(found.tolist()))
    for size in (1, 13, 200):
        assert (hashes.windows(codes, size) == hashes.ranges(sums, np.arange(201 - size), np.arange(size, 201))).all()
    assert len(hashes.windows(codes, 201)) == 0
    again = Fingerprints()
    assert (again.windows(codes[:20], 5) == hashes.windows(codes[:20], 5)).all()  # whatever was hashed before


@pytest.fixture(scope="module")
def alike(spark):
    return spark.createDataFrame(list(enumerate(ALIKE)), "doc_id long, text string")


def test_alternating_texts_are_encoded(alike):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER))
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in wavelet.tokenized(alike).collect()}
    for k, text in enumerate(ALIKE):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, wavelet.END_ID]
        assert found[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_alternating_texts_are_told_apart(alike):
    docs = list(enumerate(ALIKE))
    found = suffixes.repeated_substrings(alike, whole=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == brute.removed_substrings(docs, suffixes.LENGTH)
    assert sorted(map(tuple, jaccard.similarity_components(alike).collect())) == brute.similarity_classes(docs)
    found = substrings.repeated_windows(alike, whole=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == brute.removed_windows(docs, substrings.WINDOW_WORDS)
    found = rules.quality_rules(alike, alike.limit(0), 0.0)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted((k, *brute.base_rules(t)) for k, t in docs)
