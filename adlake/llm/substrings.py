"""Removal of word windows that an earlier document already holds."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adlake.llm.text import (
    CODES, WHITE, Fingerprints, covered, member, pack, pack_small, per_row, slices, unpack, unpack_small, word_windows, words,
)
from adlake.llm.units import cut, with_units

WINDOW_WORDS = 13

_SENT = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("hashes", pa.binary()), ("ranks", pa.binary()), ("doc_ids", pa.binary())])
_ANSWER = pa.schema([("unit", pa.int64()), ("hashes", pa.binary())])
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept_sha256 string, kept string"
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.string()),
])


def _windows(unit: pa.Table, size: int):
    """Per slice of the unit: its documents' bytes, words, and hash and first word of every window."""
    rolling, inner = Fingerprints(), Fingerprints()
    for first, last, data, bounds in slices(unit["text"]):
        starts, ends, rows = words(data, bounds, WHITE)
        hashes = inner.ranges(inner.prefix(CODES[data]), starts, ends)
        found, at = word_windows(hashes, rows, size, rolling)
        yield first, last, data, bounds, rows, found, at


def _smallest(unit: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window hashes of a unit sorted by doc_id, ascending, and the first document of each."""
    found, rank = [], []
    for first, _, _, _, rows, hashes, at in _windows(unit, size):
        found.append(hashes)
        rank.append((rows[at] + first).astype(np.uint32))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    hashes, places = np.unique(np.concatenate(found), return_index=True)  # the first place: the smallest doc_id
    return hashes, np.concatenate(rank)[places]


def _by_id(unit: pa.Table) -> pa.Table:
    return unit.sort_by([("doc_id", "ascending")])


def _ids(unit: pa.Table) -> np.ndarray:
    return unit["doc_id"].to_numpy().astype(np.int64)


def repeated_windows(docs: DataFrame, size: int = WINDOW_WORDS, whole: bool = True) -> DataFrame:
    """Words of windows whose word sequence also starts in a document with a smaller doc_id.

    Every Rabin-Karp hash of size consecutive words is counted: a unit sends each distinct hash
    with its first document to the hash's bucket, the bucket returns the hashes that a smaller
    doc_id holds, and the unit merges such windows into maximal removal intervals.

    Result: doc_id, n_words, n_removed, spans (removed word ranges, last exclusive), kept_sha256,
    and the kept words joined by one space (null unless ``whole``). Words are runs of bytes
    outside \\x20 and \\x09-\\x0D. A null or empty text has no words. Documents with fewer words than
    the window keep all. Rows that share a doc_id count as one document for "smaller", so they
    don't remove each other's words. Columns other than doc_id and text don't matter. No
    documents: no rows.
    """
    docs, units = with_units(docs)
    buckets = max(1, units // 2)

    def send(unit: pa.Table) -> pa.Table:
        unit_id, unit = unit["unit"][0].as_py(), _by_id(unit)
        hashes, ranks = _smallest(unit, size)
        ids, out = _ids(unit), []
        for bucket, a, b in cut(hashes, buckets):
            used, places = np.unique(ranks[a:b], return_inverse=True)
            out.append((bucket, unit_id, pack(hashes[a:b]), pack_small(places), pack(ids[used].view(np.uint64))))
        return pa.Table.from_pylist([dict(zip(_SENT.names, row, strict=True)) for row in out], _SENT)

    def answer(bucket: pa.Table) -> pa.Table:
        parts, ids, of = [], [], []
        for k in range(bucket.num_rows):
            hashes = unpack(bucket["hashes"][k].as_py())
            parts.append(hashes)
            ids.append(unpack(bucket["doc_ids"][k].as_py()).view(np.int64)[unpack_small(bucket["ranks"][k].as_py())])
            of.append(np.full(len(hashes), k, np.int32))
        hashes, ids, of = np.concatenate(parts), np.concatenate(ids), np.concatenate(of)
        order = np.argsort(hashes, kind="stable")
        hashes, ids, of = hashes[order], ids[order], of[order]
        first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
        counts = np.diff(first, append=len(hashes))
        later = ids > np.repeat(np.minimum.reduceat(ids, first), counts)
        hashes, of = hashes[later], of[later]
        out = [(bucket["unit"][int(k)].as_py(), pack(hashes[of == k])) for k in np.unique(of)]
        return pa.Table.from_pylist([dict(zip(_ANSWER.names, row, strict=True)) for row in out], _ANSWER)

    def remove(unit: pa.Table, answers: pa.Table) -> pa.Table:
        unit = _by_id(unit)
        if not unit.num_rows:
            return _RESULT.empty_table()
        ids = _ids(unit)
        local, ranks = _smallest(unit, size)
        elsewhere = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack(x.as_py()) for x in answers["hashes"])]))
        out = []
        for first, last, data, bounds, rows, hashes, at in _windows(unit, size):
            smallest = ids[ranks[np.searchsorted(local, hashes)]] if len(hashes) else np.zeros(0, np.int64)
            hit = (ids[rows[at] + first] > smallest) | member(hashes, elsewhere)
            gone = covered(len(rows), at[hit], size)
            n = last - first
            counts, removed = per_row(rows, n), per_row(rows[gone], n)
            firsts = np.concatenate([[0], np.cumsum(counts)])
            raw = data.tobytes()
            for k in range(n):
                own = raw[bounds[k] : bounds[k + 1]].split()
                spans = []
                if removed[k]:
                    mask = gone[firsts[k] : firsts[k + 1]]
                    steps = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                    spans = [{"first": int(a), "last": int(b)} for a, b in steps.reshape(-1, 2)]
                    own = compress(own, (~mask).tolist())
                kept = b" ".join(own)
                out.append((int(ids[first + k]), int(counts[k]), int(removed[k]), spans, hashlib.sha256(kept).hexdigest(), kept.decode() if whole else None))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RESULT.types, strict=True)], schema=_RESULT)

    sent = docs.groupBy("unit").applyInArrow(send, "bucket long, unit long, hashes binary, ranks binary, doc_ids binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "unit long, hashes binary")
    return docs.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(remove, RESULT)
