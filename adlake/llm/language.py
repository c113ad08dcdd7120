"""Language identification by string kernels.

The blended-spectrum kernel of two texts counts the character n-grams (1 to 4 bytes of UTF-8, hashed)
that are present in both, over the geometric mean of their own numbers. Nyström landmarks make it a
finite map: ridge regression, one language against the rest, is solved on the kernel columns of
the landmarks, and a text's scores are its kernel row times the solution.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.text import CODES, LOWER, Rolling, slices
from adlake.session import materialize

#: Training texts of each language, and how many of them are landmarks; the first by a hash of doc_id.
SAMPLE_PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 32
#: Every language is learnt: beyond so many texts or landmarks in all, each language has fewer, down to one text.
SAMPLE_IN_ALL = 12_000
LANDMARKS_IN_ALL = 2048
GRAM_BYTES = (1, 2, 3, 4)
BUCKETS = 1 << 13
RIDGE = 1e-2
#: Texts whose kernel rows are made in one matrix product.
BATCH = 256
#: Documents whose crc32 of doc_id leaves this remainder are held out of the fit.
FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"

_MAYBE_LETTER = re.compile(r"[^\W\d_]")
#: Lower case of A-Z; what is no letter in ASCII becomes a space, so only letters and word edges count.
_FOLDED = LOWER.copy()
_FOLDED[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def has_letter(text: str) -> bool:
    """Whether a character is a letter to Unicode, as \\p{L} is in the sample; numbers such as ½ and ² are none."""
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


class Presence:
    """Which n-gram buckets occur in a text: rows of zeros and ones."""

    def __init__(self):
        self.rolling = Rolling()

    def scan(self, column) -> Iterator[tuple[int, int, np.ndarray]]:
        for first, last, data, bounds in slices(column):
            codes = CODES[_FOLDED[data]]
            row_of_byte = np.repeat(np.arange(last - first, dtype=np.int64), np.diff(bounds))
            keys = []
            for n in GRAM_BYTES:
                grams = self.rolling.windows(codes, n)
                own = row_of_byte[: len(grams)]
                whole = own == row_of_byte[n - 1 : n - 1 + len(grams)]
                keys.append((own * BUCKETS + (grams % np.uint64(BUCKETS)).astype(np.int64))[whole])
            keys = np.concatenate(keys)
            for a in range(0, last - first, BATCH):
                b = min(a + BATCH, last - first)
                present = np.zeros((b - a) * BUCKETS, np.float32)
                present[keys[(keys >= a * BUCKETS) & (keys < b * BUCKETS)] - a * BUCKETS] = 1
                yield first + a, first + b, present.reshape(b - a, BUCKETS)


def kernel(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    norms = [np.maximum(x.sum(axis=1, dtype=np.float32), 1) for x in (some, others)]
    return (some @ others.T) / np.sqrt(norms[0][:, None] * norms[1][None, :])


def _documents(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more).filter("doc_id is not null")


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, int, bytes]]:
    """Language, place and presence row of at most per_language texts of each language, of fewer the more languages there are."""
    learnt = _documents(docs, F.col("lang").cast("string").alias("lang")).filter((F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    per_language = max(1, min(per_language, SAMPLE_IN_ALL // max(1, learnt.select("lang").distinct().count())))
    learnt = learnt.withColumn("mark", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    ids = learnt.select("lang", "doc_id", "mark").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language)
    # at most SAMPLE_IN_ALL rows, or one a language; texts are fetched for these alone, and equal rows once a place
    ids = learnt.join(F.broadcast(materialize(ids, "sample")), ["lang", "doc_id", "mark"]).dropDuplicates(["lang", "place"])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in batches:
            for first, last, rows in presence.scan(batch["text"]):
                bits = pa.array([x.tobytes() for x in np.packbits(rows.astype(bool), axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["lang"][first:last], batch["place"][first:last], bits], names=["lang", "place", "bits"])

    found = ids.select("lang", "place", "text").mapInArrow(present, "lang string, place int, bits binary")
    return sorted((r["lang"], r["place"], bytes(r["bits"])) for r in found.toLocalIterator())


def fit(sample: list[tuple[str, int, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the landmarks' presence rows, and per landmark the weight for each language."""
    names = sorted({lang for lang, _, _ in sample})
    if not sample:
        return names, np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0), np.float32)
    packed = np.frombuffer(b"".join(bits for _, _, bits in sample), np.uint8).reshape(len(sample), BUCKETS // 8)

    def rows(some: np.ndarray) -> np.ndarray:
        return np.unpackbits(some, axis=1).astype(np.float32)

    per_language = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS_IN_ALL // len(names)))
    chosen = [k for k, (_, place, _) in enumerate(sample) if place <= per_language]
    chosen = sorted(sorted(chosen, key=lambda k: zlib.crc32(sample[k][0].encode()))[:LANDMARKS_IN_ALL])
    landmarks = rows(packed[chosen])
    # K_mm^(-1/2) from its eigenvectors, without the directions that rounding makes
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    strong = values > 1e-6 * values.max()
    root = vectors[:, strong] / np.sqrt(values[strong])
    mapped = np.concatenate([kernel(rows(packed[a : a + BATCH]), landmarks).astype(np.float64) @ root for a in range(0, len(sample), BATCH)])
    sums = np.zeros((len(names), mapped.shape[1]))  # of the rows of each language
    np.add.at(sums, np.searchsorted(np.array(names, object), np.array([lang for lang, _, _ in sample], object)), mapped)
    solved = np.linalg.solve(mapped.T @ mapped + RIDGE * np.eye(mapped.shape[1]), sums.T)
    return names, landmarks, (root @ solved).astype(np.float32)


def predicted_languages(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the ridge output of that language, cut to 0 to 1).

    Learnt from texts with a letter and a language whose documents aren't held out. Only the text is
    an input of a prediction. Texts that are null or have no letter, and all texts where nothing can be
    learnt, are ``und`` with score 0. Ties go to the first language by name. Rows without doc_id are
    left out; repeated rows each get a result. Other columns don't matter. No documents: no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, per_language)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, landmarks, weights = model.value
        presence = Presence()
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            for first, last, rows in presence.scan(texts):
                lettered = [t is not None and has_letter(t) for t in texts[first:last].to_pylist()]
                if names:
                    scores = kernel(rows, landmarks) @ weights
                    best = scores.argmax(axis=1)
                    tops = np.clip(scores[np.arange(len(best)), best], 0, 1).astype(float)
                out = [(names[best[k]], float(tops[k])) if ok and names else (UNDETERMINED, 0.0) for k, ok in enumerate(lettered)]
                held = [zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids[first:last]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], pa.int64()), pa.array(held, pa.bool_()), pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return _documents(docs).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
