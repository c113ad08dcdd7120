"""Benchmark decontamination by a broadcast hash set of normalised word n-grams."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.text import CODES, LOWER, NOT_ALNUM, Rolling, covered, member, per_row, slices, text_of, word_windows, words

WINDOW_WORDS = 13
#: Grams that one broadcast may hold, in bytes of their words. Larger benchmarks are taken in blocks.
BLOCK_BYTES = 16 << 20
#: A document is contaminated from one hit word in so many.
CONTAMINATED_ONE_IN = 20

_GRAMS = pa.schema([("item_id", pa.string()), ("size", pa.int32()), ("hash", pa.int64()), ("words", pa.binary())])
_SPANS_DDL = "array<struct<first:bigint,last:bigint>>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


class Scanner:
    """Words and word hashes of slices of texts, lower-cased in A-Z."""

    def __init__(self):
        self.inner, self.outer = Rolling(), Rolling()

    def scan(self, column):
        for first, last, data, bounds in slices(column):
            data = LOWER[data]
            starts, ends, rows = words(data, bounds, NOT_ALNUM)
            yield first, last, data, starts, ends, rows, self.inner.ranges(self.inner.prefix(CODES[data]), starts, ends)


def benchmark_grams(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Every distinct window of each item: item_id, size, hash, words joined by one space.

    An item of fewer words than the window is one window of its own size; items without words have none.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            ids = batch["item_id"].to_pylist()
            for first, last, data, starts, ends, rows, hashes in scanner.scan(batch["text"]):
                counts, raw, out = per_row(rows, last - first), data.tobytes(), set()
                for n in {size, *(int(c) for c in np.unique(counts) if 0 < c < size)}:
                    found, at = word_windows(hashes, rows, n, scanner.outer)
                    for h, k in zip(found.view(np.int64).tolist(), at.tolist(), strict=True):
                        if n == size or counts[rows[k]] == n:
                            out.add((ids[first + rows[k]], n, h, b" ".join(raw[starts[j] : ends[j]] for j in range(k, k + n))))
                yield pa.RecordBatch.from_pylist([dict(zip(_GRAMS.names, x, strict=True)) for x in sorted(out)], _GRAMS)

    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return named.filter("item_id is not null").mapInArrow(grams, "item_id string, size int, hash long, words binary").distinct()


def gram_blocks(benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> Iterator[dict]:
    """The grams as lookup tables of at most about block_bytes each, dealt by hash."""
    grams = benchmark_grams(benchmark, size)
    # 60: what an entry costs besides its words
    total = grams.agg(F.sum(F.octet_length("words") + F.octet_length("item_id") + 60)).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for k in range(count):
        block = grams if count == 1 else grams.filter(F.expr(f"pmod(hash, {count}L) = {k}"))
        items, sizes = defaultdict(set), defaultdict(set)
        for r in block.toLocalIterator():
            items[r["size"], bytes(r["words"])].add(r["item_id"])
            sizes[r["size"]].add(r["hash"])
        yield {
            "items": {key: sorted(ids) for key, ids in items.items()},
            "hashes": {n: np.sort(np.array(list(found), np.int64).view(np.uint64)) for n, found in sizes.items()},
        }


def _hits(column, block: dict, scanner: Scanner):
    """Per text: number of words, hit word ranges, items with a window in it."""
    for first, last, data, starts, ends, rows, hashes in scanner.scan(column):
        n, raw = last - first, None
        gone, items = np.zeros(len(rows), bool), defaultdict(set)
        for size, among in block["hashes"].items():
            found, at = word_windows(hashes, rows, size, scanner.outer)
            true = []
            for k in at[member(found, among)].tolist():
                raw = data.tobytes() if raw is None else raw
                ids = block["items"].get((size, b" ".join(raw[starts[j] : ends[j]] for j in range(k, k + size))))
                if ids:
                    true.append(k)
                    items[int(rows[k])].update(ids)
            gone |= covered(len(rows), np.array(true, np.int64), size)
        counts, hit = per_row(rows, n), per_row(rows[gone], n)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        for k in range(n):
            spans = []
            if hit[k]:
                steps = np.flatnonzero(np.diff(gone[firsts[k] : firsts[k + 1]].astype(np.int8), prepend=0, append=0))
                spans = [(int(a), int(b)) for a, b in steps.reshape(-1, 2)]
            yield int(counts[k]), spans, sorted(items[k]) if k in items else []


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _scanned(docs: DataFrame, benchmark: DataFrame, size: int, block_bytes: int, text: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """docs with found_words, found_spans and found_items; text: the texts of a batch.

    Blocks of grams follow each other on the same batches; nothing is shuffled.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.withColumns({"found_words": F.lit(0).cast("long"), "found_spans": F.array().cast(_SPANS_DDL), "found_items": F.array().cast("array<string>")})

    def scanned_for(frame: DataFrame, block: dict) -> DataFrame:
        shared = context.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = Scanner()
            for batch in batches:
                old = batch.select(["found_spans", "found_items"]).to_pylist()
                counts, spans, items = [], [], []
                for before, (n, ranges, ids) in zip(old, _hits(text(batch), shared.value, scanner), strict=True):
                    ranges = _merged([(x["first"], x["last"]) for x in before["found_spans"]] + ranges)
                    counts.append(n)
                    spans.append([{"first": a, "last": b} for a, b in ranges])
                    items.append(sorted({*before["found_items"], *ids}))
                new = {"found_words": pa.array(counts, pa.int64()), "found_spans": pa.array(spans, _SPANS), "found_items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(n, batch[n]) for n in batch.schema.names], names=batch.schema.names)

        return frame.mapInArrow(find, frame.schema)

    hit = F.aggregate("found_spans", F.lit(0).cast("long"), lambda total, x: total + x["last"] - x["first"])
    return reduce(scanned_for, gram_blocks(benchmark, size, block_bytes), docs).withColumn("found_hit", hit)


def _is_contaminated() -> F.Column:
    return (F.col("found_hit") > 0) & (F.col("found_hit") * CONTAMINATED_ONE_IN >= F.col("found_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of benchmark windows in documents, verified word by word.

    Result, a row per document: doc_id, n_words, n_hit (words inside any occurrence), n_items,
    items_sha256 (of the ids of items with occurring windows, sorted as strings and joined by
    commas), contaminated (n_hit > 0 and 20 * n_hit >= n_words), items, spans (hit word ranges, last exclusive).

    Null or empty texts have no words and no hits; items without words have no windows; equal
    items are each named. Rows without item_id are no items, rows without doc_id no documents. Rows
    that share a doc_id stay apart. Other columns don't matter; no documents give no rows. The
    grams are broadcast in blocks of about ``block_bytes``, and all documents meet every block.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    return _scanned(docs, benchmark, size, block_bytes, lambda batch: batch["text"]).select(
        "doc_id", F.col("found_words").alias("n_words"), F.col("found_hit").alias("n_hit"),
        F.size("found_items").cast("long").alias("n_items"), F.sha2(F.array_join("found_items", ","), 256).alias("items_sha256"),
        _is_contaminated().alias("contaminated"), F.col("found_items").alias("items"), F.col("found_spans").alias("spans"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that aren't contaminated, with all their columns and as they are, in one pass without a shuffle."""
    columns = docs.columns
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    return _scanned(carried, benchmark, size, block_bytes, lambda batch: text_of(batch["row"], columns)).filter(~_is_contaminated()).select("row.*")
