"""Quality rules: plain counts of each text, and a log-likelihood ratio of hashed word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.text import CODES, WHITE, Fingerprints, covered, distinct, per_row, slices, word_windows, words

#: Word n-grams that are counted, and the number of buckets they are hashed to.
GRAM_WORDS = (1, 2)
BUCKETS = 1 << 16
#: The threshold on the mean log-likelihood ratio per n-gram lies MARGIN below the ratio, on a grid
#: of GRID, that a share of LOST of the held-out trusted documents stays under.
LOST, MARGIN, GRID = 0.002, 0.02, 0.001
#: The threshold where no trusted document is held out.
THRESHOLD = -0.05
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
REPEAT_WORDS = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STARTS_CODE_POINT = (np.arange(256) & 0xC0) != 0x80

SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double"
_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("llr", pa.float64()),
])


class Counter:
    """Words, word hashes and n-gram buckets of slices of texts."""

    def __init__(self, buckets: int = BUCKETS):
        self.inner, self.outer, self.buckets = Fingerprints(), Fingerprints(), buckets

    def word_hashes(self, data: np.ndarray, bounds: np.ndarray):
        starts, ends, rows = words(data, bounds, WHITE)
        sums = self.inner.prefix(CODES[data])
        return starts, rows, self.inner.ranges(sums, starts, ends), sums

    def grams(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and row of every n-gram."""
        found = [word_windows(hashes, rows, n, self.outer) for n in GRAM_WORDS]
        buckets = np.concatenate([h for h, _ in found]) % np.uint64(self.buckets)
        return buckets.astype(np.int64), np.concatenate([rows[at] for _, at in found])


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw, target: n-grams of all documents, and of those whose doc_id is a trusted_id.

    A task adds its counts up before they are shuffled, so it sends each bucket once at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, raw, target = Counter(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            chosen = np.array(batch["trusted"].to_pylist(), bool)
            for first, last, data, bounds in slices(batch["text"]):
                _, rows, hashes, _ = counter.word_hashes(data, bounds)
                found, of = counter.grams(hashes, rows)
                raw += np.bincount(found, minlength=buckets)
                target += np.bincount(found[chosen[first:last][of]], minlength=buckets)
        at = np.flatnonzero(raw)
        for k in range(0, len(at), 10_000):
            own = at[k : k + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(raw[own]), pa.array(target[own])], names=["bucket", "raw", "target"])

    docs = _documents(docs)
    # one plan at every size: a set that grows with the corpus is never broadcast
    marked = docs.join(trusted.hint("merge"), docs.doc_id == trusted.trusted_id, "left").select("text", F.col("trusted_id").isNotNull().alias("trusted"))
    counts = marked.mapInArrow(count, "bucket long, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket log p(target) / p(raw), each count plus one. The number of buckets bounds what the driver gets."""
    raw, target = np.ones(buckets), np.ones(buckets)
    for r in counts.toLocalIterator():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def threshold_of(scored: DataFrame, held_out: DataFrame) -> float:
    """The threshold that the held-out trusted documents set. The driver gets a count per grid value."""
    own = scored.filter("not base_failed").join(held_out, scored.doc_id == held_out.trusted_id, "left_semi")
    steps = own.groupBy(F.round(F.col("llr") / GRID).cast("long").alias("step")).count().orderBy("step").collect()
    allowed = LOST * sum(r["count"] for r in steps)
    for r in steps:
        if r["count"] > allowed:
            return r["step"] * GRID - MARGIN
        allowed -= r["count"]
    return THRESHOLD


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Counts, base rules and the n-gram verdict of every document.

    The verdict: the mean log-likelihood ratio of the text's hashed word 1- and 2-grams between the
    multinomial of the trusted documents and that of the whole corpus reaches a threshold. Half of the
    trusted documents, by the crc32 of their doc_id, make the multinomial; the others set the
    threshold, unless one is given. It is the same for every run, without sampling.

    Result: doc_id, n_words, word_chars (code points in words), n_symbols (characters of
    ``#*$%&|<>``), n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in
    3-word windows found twice or more in the text), base_failed, llr, kept. A null or empty text has zero counts,
    llr 0 and fails the base rules. Without trusted documents every ratio is that of smoothing
    alone. Rows without doc_id are left out; repeated rows each get a result; a doc_id that is trusted twice
    counts once. Other columns don't matter. No documents: no rows.
    """
    named = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).filter("trusted_id is not null").distinct()
    held_out = F.crc32(F.col("trusted_id").cast("string")) % 2 == 1
    ratios = log_ratios(gram_counts(docs, named.filter(~held_out), buckets), buckets)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(buckets)
        for batch in batches:
            ids = batch["doc_id"]
            for first, last, data, bounds in slices(batch["text"]):
                n = last - first
                starts, rows, hashes, sums = counter.word_hashes(data, bounds)
                counts = per_row(rows, n)
                of_byte = np.repeat(np.arange(n), np.diff(bounds))
                chars = per_row(of_byte[~WHITE[data] & _STARTS_CODE_POINT[data]], n)
                symbols = per_row(of_byte[_SYMBOL[data]], n)
                found, of = counter.grams(hashes, rows)
                llr = np.bincount(of, shared.value[found], minlength=n) / np.maximum(per_row(of, n), 1)
                repeated = per_row(rows[_in_repeats(hashes, rows, counter)], n)
                failed = (counts < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * counts)
                columns = [ids[first:last], counts, chars, symbols, _equal_lines(data, bounds, starts, sums, counter), repeated, failed, llr]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, _SCORED.types, strict=True)], schema=_SCORED)

    scored = _documents(docs).mapInArrow(judge, SCORED)
    if threshold is None:
        threshold = threshold_of(scored, named.filter(held_out))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def _twice(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, the first key least; whether each sorted place equals the one before."""
    order = np.lexsort(keys)
    same = np.ones(len(order), bool)
    same[:1] = False
    for key in keys:
        same[1:] &= key[order][1:] == key[order][:-1]
    return order, same


def _in_repeats(hashes: np.ndarray, rows: np.ndarray, counter: Counter) -> np.ndarray:
    found, at = word_windows(hashes, rows, REPEAT_WORDS, counter.outer)
    order, same = _twice(found, rows[at])
    same[:-1] |= same[1:]
    return covered(len(rows), at[order[same]], REPEAT_WORDS)


def _equal_lines(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, sums: np.ndarray, counter: Counter) -> np.ndarray:
    """Per row, lines with a word that equal an earlier line of the row."""
    breaks = np.flatnonzero(data == 0x0A)
    firsts = distinct(np.concatenate([bounds[:-1], breaks + 1]))
    firsts = firsts[firsts < len(data)]
    # a line ends at its line feed or with its text
    lasts = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, firsts)], bounds[np.searchsorted(bounds, firsts, "right")])
    with_word = np.searchsorted(starts, lasts) > np.searchsorted(starts, firsts)
    firsts, lasts = firsts[with_word], lasts[with_word]
    rows = np.searchsorted(bounds, firsts, "right") - 1
    order, same = _twice(counter.inner.ranges(sums, firsts, lasts), rows)
    return per_row(rows[order[same]], len(bounds) - 1)
