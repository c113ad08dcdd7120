"""Quality classifier of supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, word pairs and character n-grams, and of
two tokens for word pairs that differ and that are equal. A softmax over the mean gives the class. The vectors are fitted by stochastic gradient descent in numpy
on a bounded sample of labelled documents; every document is then scored in full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.text import CODES, WHITE, Rolling, mix, slices, text_of, word_windows, words

#: Labelled documents of each class that the vectors are fitted on, the first by a hash of their doc_id.
SAMPLE_PER_CLASS = 1500
BUCKETS = 1 << 15
DIMENSIONS = 16
WORD_GRAMS = (1, 2)
CHAR_GRAMS = (3, 4)
EPOCHS = 8
RATE = 0.5
#: Predicted as of class 1 from this score.
PREDICTED_FROM = 0.7
#: Documents whose crc32 of doc_id leaves this remainder are held out of the fit.
FOLDS, HELD_OUT = 4, 2

#: Tokens for a word that differs from the one before, and for one that repeats it.
_PAIRS = mix(np.array([1, 2], np.uint64))


class Features:
    """Bucket and row of every feature in slices of texts: words, word pairs, whether a word repeats the one before, character n-grams."""

    def __init__(self, buckets: int = BUCKETS):
        self.inner, self.outer, self.buckets = Rolling(), Rolling(), buckets

    def scan(self, column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for first, last, data, bounds in slices(column):
            codes = CODES[data]
            starts, ends, rows = words(data, bounds, WHITE)
            hashes = self.inner.ranges(self.inner.prefix(codes), starts, ends)
            found, of = [], []
            for n in WORD_GRAMS:
                grams, at = word_windows(hashes, rows, n, self.outer)
                found.append(grams)
                of.append(rows[at])
            pairs = np.flatnonzero(rows[1:] == rows[:-1])
            found.append(_PAIRS[(hashes[pairs] == hashes[pairs + 1]).astype(np.int64)])
            of.append(rows[pairs])
            row_of_byte = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(bounds))
            white = WHITE[data]
            for n in CHAR_GRAMS:
                if len(data) < n:
                    continue
                grams = self.inner.windows(codes, n)
                size = len(grams)
                # white space stands for the edge of a word, so only the first or the last byte may be white
                whole = row_of_byte[:size] == row_of_byte[n - 1 :]
                for k in range(1, n - 1):
                    whole &= ~white[k : k + size]
                found.append(mix(grams[whole]))
                of.append(row_of_byte[:size][whole])
            yield first, last, (np.concatenate(found) % np.uint64(self.buckets)).astype(np.int64), np.concatenate(of).astype(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Class, buckets and counts of the documents to fit on: at most per_class of each class, and at most BUCKETS pairs of each."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter((F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT) & F.col("quality").isin(0, 1)).distinct()
    place = F.xxhash64("doc_id")
    parts = [known.filter(F.col("quality") == q).orderBy(place, "doc_id").limit(per_class) for q in (0, 1)]
    chosen = F.broadcast(parts[0].unionAll(parts[1]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for first, last, found, of in features.scan(batch["text"]):
                keys, counts = np.unique(of * BUCKETS + found, return_counts=True)
                edges = np.searchsorted(keys, np.arange(last - first + 1) * BUCKETS)
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"][first:last], batch["quality"][first:last],
                    pa.array([(keys[a:b] % BUCKETS).astype(np.int32).tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    pa.array([counts[a:b].astype(np.float32).tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                ], names=["doc_id", "quality", "found", "counts"])

    rows = _documents(docs).join(chosen, "doc_id").select("doc_id", "text", "quality").mapInArrow(count, "doc_id long, quality int, found binary, counts binary")
    sample = [(r["doc_id"], r["quality"], bytes(r["found"]), bytes(r["counts"])) for r in rows.toLocalIterator()]
    return [(q, np.frombuffer(found, np.int32), np.frombuffer(counts, np.float32)) for _, q, found, counts in sorted(sample)]


def fit(sample: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> np.ndarray:
    """What each bucket adds to the logit of class 1: its vector times the difference of the output vectors."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    sample = [(q, found, counts / counts.sum()) for q, found, counts in sample if len(found)]
    steps, done = epochs * len(sample), 0
    for _ in range(epochs):
        for k in random.permutation(len(sample)):
            label, found, weights = sample[k]
            mean = weights @ vectors[found]
            logits = output @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            step = rate * (1 - done / steps)
            back = p @ output
            output -= step * np.outer(p, mean)
            # vectors get the gradient undamped by the length of the text, as each is seen rarely
            vectors[found] -= (step * weights / weights.max())[:, None] * back
            done += 1
    return (vectors @ (output[1] - output[0])).astype(np.float64)


def _scores(features: Features, texts: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for first, last, found, of in features.scan(texts):
        logit = np.bincount(of, weights[found], minlength=last - first) / np.maximum(np.bincount(of, minlength=last - first), 1)
        yield first, last, 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: quality 1 likelier), predicted (1 from a score of 0.7).

    The model learns from labelled documents that aren't held out; of them ``per_class`` of each class.
    Only the text is an input of a score. Null and empty texts score 0.5, as does every text where
    nothing is labelled. Labels other than 0 and 1 are left out, contradictory ones are both learnt; a label without a
    document does nothing. Rows without doc_id are left out, repeated rows each get a score.
    Other columns don't matter. No documents: no rows.
    """
    weights = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, per_class)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, last, scores in _scores(features, batch["text"], weights.value):
                held = [zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids[first:last]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], pa.int64()), pa.array(held, pa.bool_()), pa.array(scores), pa.array((scores >= PREDICTED_FROM).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return _documents(docs).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def of_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of docs that the classifier predicts to be of quality 1, with all their columns, in one pass after the fit.

    Cases as for ``quality_scores``: empty texts go, and so do rows without doc_id.
    """
    weights = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, per_class)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    carried, columns = docs.filter("doc_id is not null").select(row), docs.columns

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for first, last, scores in _scores(features, text_of(batch["row"], columns), weights.value):
                yield batch.slice(first, last - first).filter(pa.array(scores >= PREDICTED_FROM))

    return carried.mapInArrow(choose, carried.schema).select("row.*")
