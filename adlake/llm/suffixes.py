"""Removal of byte strings that occur more than once, by distributed prefix doubling.

Ranks are names: equal strings have equal names. The name of 2L bytes at a position is made of
the names of L bytes at the position and at L further on, so each doubling sorts pairs of names.
Names up to half the threshold need no other document and are made inside the tasks. Two rounds
then sort pairs in Spark, and positions whose pair is unique drop out:

1. Ranking every position of the corpus at half the threshold would shuffle sixteen bytes for
   each byte of text. Instead each window of the threshold's length belongs to the position inside
   it with the smallest name of half its length (the leftmost of equals), which equal windows
   share wherever they stand. Neighbouring windows with the same owner form a run. The round
   ranks (owner's name, name of the whole run). A unique owner ends its windows; equal whole
   runs are repeated throughout and go on as one.
2. Each window of the runs that share their owner's name with a different run is ranked by
   its pair (name of the first half, name of the second half).
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adlake.llm.text import CODES, Fingerprints, covered, member, mix, pack, slices, unpack
from adlake.llm.units import cut, with_units

LENGTH = 400

_REPEATED, _SHARED, _SENDS = 1, 2, 4
_TWICE, _ASKS = 1, 2
_PAIR = np.uint64(0xD1B54A32D192ED03)

_SENT = "bucket long, unit long, a binary, b binary, c binary"
_ANSWER = "unit long, round int, a binary, b binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<first:long,last:long>>, kept_sha256 string, kept binary"
_SENT_ARROW = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_ANSWER_ARROW = pa.schema([("unit", pa.int64()), ("round", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary()),
])


class Runs(NamedTuple):
    """Windows of a slice by owner: first and last start, owner's name, run's name; names of half windows at every byte."""

    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    run: np.ndarray
    half: np.ndarray


def _pairs(names: np.ndarray, offset: int) -> np.ndarray:
    n = len(names) - offset
    return mix(names[:n] * _PAIR + names[offset:]) if n > 0 else np.zeros(0, np.uint64)


def names_of(data: np.ndarray, length: int, rolling: Fingerprints) -> np.ndarray:
    """Name of the length bytes from every position, doubled up from short strings."""
    size = length
    while size > 32:
        size = (size + 1) // 2
    names = rolling.windows(CODES[data], size)
    while size < length:
        offset = min(size, length - size)
        names, size = _pairs(names, offset), size + offset
    return names


def _leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value in every run of width values; the leftmost of equals."""
    places, size = np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = values[step:] < values[:-step]
        places = np.where(right, places[step:], places[:-step])
        values = np.minimum(values[step:], values[:-step])
        size += step
    return places


def _runs(data: np.ndarray, bounds: np.ndarray, length: int, rolling: Fingerprints) -> Runs:
    half = length // 2
    width = length - half + 1
    names = names_of(data, half, rolling)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64), names)
    owners = _leftmost_smallest((names >> np.uint64(32)).astype(np.uint32), width)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    whole = np.arange(len(owners)) + length <= ends[: len(owners)]
    change = np.ones(len(owners), bool)
    change[1:] = (owners[1:] != owners[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(owners)) - 1
    first, last = first[whole[first]], last[whole[first]]
    # windows of neighbouring documents never share an owner: the owner lies inside the window
    owner = owners[first].astype(np.int64)
    sums = rolling.prefix(CODES[data])
    run = mix(rolling.ranges(sums, first, last + length) ^ mix((owner - first).astype(np.uint64) + names[owner] * _PAIR))
    return Runs(first, last, names[owner], run, names)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the ranges first to last, and the range it is of."""
    counts = last - first + 1
    of = np.repeat(np.arange(len(first)), counts)
    return first[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts), of


def _join(parts: list, kind=np.uint64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def _bytes(blobs: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint8) for x in blobs]


def _answers(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a unit that go on, ascending, with their marks; repeated windows, ascending."""
    rounds = answers["round"].to_numpy()
    one, two = answers.filter(pa.array(rounds == 1)), answers.filter(pa.array(rounds == 2))
    runs, marks = _join([unpack(x.as_py()) for x in one["a"]]), _join(_bytes(one["b"]), np.uint8)
    order = np.argsort(runs)
    return runs[order], marks[order], np.sort(_join([unpack(x.as_py()) for x in two["a"]]))


def _marks_of(run: np.ndarray, runs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    if not len(runs):
        return np.zeros(len(run), np.uint8)
    at = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
    return np.where(runs[at] == run, marks[at], 0).astype(np.uint8)


def _windows(runs: Runs, chosen: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, run and name of every window of the chosen runs."""
    places, of = _spread(runs.first[chosen], runs.last[chosen])
    half = length // 2
    return places, chosen[of], mix(runs.half[places] * _PAIR + runs.half[places + length - half] + np.uint64(length % 2))


def repeated_substrings(docs: DataFrame, length: int = LENGTH, whole: bool = True) -> DataFrame:
    """Bytes covered by a string of ``length`` bytes that also starts anywhere else, same document included.

    Result: doc_id, n_bytes, n_removed, n_spans, spans (maximal removed byte ranges, last exclusive),
    kept_sha256 and the kept bytes (null unless ``whole``; cuts can fall inside a character).
    Matches overlap freely, are judged on the input and never cross documents. Null and empty texts have no bytes;
    texts shorter than ``length`` keep all. Equal rows, also under one doc_id, are each other's
    repeats. Columns other than doc_id and text don't matter. No documents: no rows.
    """
    docs, units = with_units(docs)
    buckets = max(1, units // 2)

    def rank_runs(unit: pa.Table) -> pa.Table:
        rolling, owners, names = Fingerprints(), [], []
        for _, _, data, bounds in slices(unit["text"]):
            runs = _runs(data, bounds, length, rolling)
            owners.append(runs.owner)
            names.append(runs.run)
        owners, names = _join(owners), _join(names)
        names, places, counts = np.unique(names, return_index=True, return_counts=True)
        order = np.argsort(owners[places], kind="stable")
        owners, names, counts = owners[places][order], names[order], np.minimum(counts[order], 2).astype(np.uint8)
        out = [(k, unit["unit"][0].as_py(), pack(owners[a:b]), names[a:b].tobytes(), counts[a:b].tobytes()) for k, a, b in cut(owners, buckets)]
        return pa.Table.from_pylist([dict(zip(_SENT_ARROW.names, x, strict=True)) for x in out], _SENT_ARROW)

    def judge_runs(bucket: pa.Table) -> pa.Table:
        owners = [unpack(x.as_py()) for x in bucket["a"]]
        of = np.repeat(np.arange(len(owners)), [len(x) for x in owners])
        owners, counts = _join(owners), _join(_bytes(bucket["c"]), np.uint8)
        names = _join([np.frombuffer(x.as_py(), np.uint64) for x in bucket["b"]])
        order = np.lexsort((names, owners))
        owners, names, counts, of = owners[order], names[order], counts[order], of[order]
        new_owner = np.diff(owners, prepend=~owners[:1]) != 0
        new_run = new_owner | (np.diff(names, prepend=~names[:1]) != 0)
        run, owner = np.cumsum(new_run) - 1, np.cumsum(new_owner) - 1
        marks = _REPEATED * (np.bincount(run, counts)[run] >= 2) + _SHARED * (np.bincount(owner, new_run)[owner] >= 2) + _SENDS * new_run
        goes = marks & (_REPEATED | _SHARED) != 0
        names, marks, of = names[goes], marks[goes].astype(np.uint8), of[goes]
        out = []
        for k in np.unique(of):
            own = np.flatnonzero(of == k)
            own = own[np.argsort(names[own])]
            out.append((bucket["unit"][int(k)].as_py(), 1, pack(names[own]), marks[own].tobytes()))
        return pa.Table.from_pylist([dict(zip(_ANSWER_ARROW.names, x, strict=True)) for x in out], _ANSWER_ARROW)

    def rank_windows(unit: pa.Table, answers: pa.Table) -> pa.Table:
        known, marks, _ = _answers(answers)
        if not (marks & _SENDS).any() or not unit.num_rows:
            return _SENT_ARROW.empty_table()
        rolling, names, asks, sent = Fingerprints(), [], [], np.zeros(0, np.uint64)
        for _, _, data, bounds in slices(unit["text"]):
            runs = _runs(data, bounds, length, rolling)
            own = _marks_of(runs.run, known, marks)
            chosen = np.flatnonzero(own & (_SHARED | _SENDS) == _SHARED | _SENDS)
            chosen = chosen[np.unique(runs.run[chosen], return_index=True)[1]]
            chosen = chosen[~member(runs.run[chosen], sent)]  # a run goes once
            sent = np.union1d(sent, runs.run[chosen])
            _, of, found = _windows(runs, chosen, length)
            names.append(found)
            asks.append(own[of] & _REPEATED == 0)
        names, asks = _join(names), _join(asks, bool)
        names, at, counts = np.unique(names, return_inverse=True, return_counts=True)
        bits = (_TWICE * (counts >= 2) + _ASKS * (np.bincount(at, asks, minlength=len(names)) > 0)).astype(np.uint8)
        out = [(k, unit["unit"][0].as_py(), pack(names[a:b]), bits[a:b].tobytes(), None) for k, a, b in cut(names, buckets)]
        return pa.Table.from_pylist([dict(zip(_SENT_ARROW.names, x, strict=True)) for x in out], _SENT_ARROW)

    def judge_windows(bucket: pa.Table) -> pa.Table:
        names = [unpack(x.as_py()) for x in bucket["a"]]
        of = np.repeat(np.arange(len(names)), [len(x) for x in names])
        names, bits = _join(names), _join(_bytes(bucket["b"]), np.uint8)
        order = np.argsort(names, kind="stable")
        names, bits, of = names[order], bits[order], of[order]
        first = np.flatnonzero(np.diff(names, prepend=~names[:1]) != 0)
        counts = np.add.reduceat(1 + (bits & _TWICE).astype(np.int64), first)
        told = (np.repeat(counts, np.diff(first, append=len(names))) >= 2) & (bits & _ASKS != 0)
        names, of = names[told], of[told]
        out = [(bucket["unit"][int(k)].as_py(), 2, pack(names[of == k]), None) for k in np.unique(of)]
        return pa.Table.from_pylist([dict(zip(_ANSWER_ARROW.names, x, strict=True)) for x in out], _ANSWER_ARROW)

    def remove(unit: pa.Table, answers: pa.Table) -> pa.Table:
        if not unit.num_rows:
            return _RESULT_ARROW.empty_table()
        known, marks, repeated = _answers(answers)
        rolling, ids, out = Fingerprints(), unit["doc_id"].to_pylist(), []
        for first, last, data, bounds in slices(unit["text"]):
            gone = np.zeros(len(data), bool)
            if len(known):
                runs = _runs(data, bounds, length, rolling)
                own = _marks_of(runs.run, known, marks)
                every, _ = _spread(*(x[own & _REPEATED != 0] for x in (runs.first, runs.last)))
                places, _, names = _windows(runs, np.flatnonzero(own & (_SHARED | _REPEATED) == _SHARED), length)
                gone = covered(len(data), np.concatenate([every, places[member(names, repeated)]]), length)
            raw = data.tobytes()
            for k in range(last - first):
                a, b = int(bounds[k]), int(bounds[k + 1])
                mask, kept, spans = gone[a:b], raw[a:b], []
                if mask.any():
                    steps = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                    spans = [{"first": int(x), "last": int(y)} for x, y in steps.reshape(-1, 2)]
                    kept = data[a:b][~mask].tobytes()
                out.append((ids[first + k], b - a, b - a - len(kept), len(spans), spans, hashlib.sha256(kept).hexdigest(), kept if whole else None))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RESULT_ARROW.types, strict=True)], schema=_RESULT_ARROW)

    units_of = docs.groupBy("unit")
    runs = units_of.applyInArrow(rank_runs, _SENT).groupBy("bucket").applyInArrow(judge_runs, _ANSWER)
    sent = units_of.cogroup(runs.groupBy("unit")).applyInArrow(rank_windows, _SENT)
    windows = sent.groupBy("bucket").applyInArrow(judge_windows, _ANSWER)
    return units_of.cogroup(runs.unionAll(windows).groupBy("unit")).applyInArrow(remove, RESULT)
