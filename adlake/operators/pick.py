"""Choosing rows: latest rows, bounded samples, single members, top values with ties."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import text_key


def latest_rows(frame: DataFrame, by: str, limit: int, ties: Sequence[str] | None = None) -> DataFrame:
    """The `limit` rows highest in `by`; all other columns break ties, so the answer is fixed."""
    rest = list(ties) if ties is not None else [c for c in frame.columns if c != by]
    return frame.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]).limit(limit)


def row_digest(keys: Sequence[str], *seed: int) -> Column:
    """Hex digest of a key, varied by a seed; the same in every engine that has md5."""
    return F.md5(text_key(*[F.col(f"`{k}`") for k in keys], *[F.lit(s) for s in seed]))


def bounded_sample(frame: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """At most `limit` rows, chosen by key digest: repeatable, whatever the partitioning.

    `keys` should identify rows. Digests are uniform, so a digest ceiling first cuts
    the table to slightly more than `limit` rows on every task; only those are sorted.
    """
    rows = frame.count()
    if rows <= limit:
        return frame
    digest = row_digest(keys)
    share = (limit + 10 * sqrt(limit) + 100) / rows
    chosen = frame.withColumn("_digest", digest)
    if share < 1:
        ceiling = f"{int(share * 16**8):08x}"
        cut = chosen.filter(F.substring("_digest", 1, 8) <= ceiling)
        if cut.count() >= limit:
            chosen = cut
    return chosen.orderBy("_digest", *[F.col(k).asc_nulls_first() for k in keys]).limit(limit).drop("_digest")


def pick_member(dim: DataFrame, key: str, seed: int) -> DataFrame:
    """One member of a dimension, fixed by the seed."""
    return dim.select(key).orderBy(row_digest([key], seed), key).limit(1)


def top_with_ties(frame: DataFrame, by: str, n: int) -> DataFrame:
    """Rows whose value is among the n highest, ties at the edge included.

    The n-th value is found by a top-n and compared as a scalar, so rows are never
    gathered for ranking. With fewer than n values every row stays.
    """
    best = frame.orderBy(F.col(by).desc_nulls_last()).limit(n)
    edge = best.agg(F.when(F.count(by) == n, F.min(by)).alias("edge")).scalar()
    return frame.filter(edge.isNull() | (F.col(by) >= edge))
