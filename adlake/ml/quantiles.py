"""Exact quantiles without gathering a column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 200_000
ACCURACY = 10_000


@dataclass(frozen=True)
class _Search:
    """Search for the rank-th smallest value of a column (0-based).

    The answer lies strictly between ``low`` and ``high`` (None: unbounded), with
    ``below`` values at or under ``low`` and ``inside`` values between.
    """

    column: str
    rank: int
    below: int
    inside: int
    low: object = None
    high: object = None
    answer: object = None

    @property
    def band(self) -> tuple:
        return self.column, self.low, self.high

    def between(self):
        value = F.col(self.column)
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test


def rank_values(
    frame: DataFrame, ranks: Sequence[tuple[str, int, int]], small_rows: int = SMALL_ROWS, accuracy: int = ACCURACY
) -> list:
    """The value at each (column, rank, non-null count), exactly.

    A search range that holds many values is narrowed by approximate quantiles on
    both sides of the rank, then counted exactly; each round shrinks it about
    ``accuracy / 4`` times. Ranges of at most ``small_rows`` values are sorted
    outright. All columns move together: two passes per round.
    """
    searches = [_Search(c, rank, 0, count) for c, rank, count in ranks]
    while any(s.answer is None and s.inside > small_rows for s in searches):
        wide = [s for s in searches if s.answer is None and s.inside > small_rows]
        brackets = _brackets(frame, wide, accuracy)
        sizes = _sizes(frame, brackets)
        searches = [_narrow(s, *brackets[s], *sizes[s]) if s in brackets else s for s in searches]

    rest = list(dict.fromkeys(s for s in searches if s.answer is None))
    if rest:
        values = {
            s.band: F.sort_array(F.collect_list(F.when(s.between(), F.col(s.column)))) for s in rest
        }
        lists = {band: f"l{i}" for i, band in enumerate(values)}
        gathered = frame.agg(*[values[band].alias(name) for band, name in lists.items()])
        found = gathered.select(*[F.get(lists[s.band], F.lit(s.rank - s.below)).alias(f"v{i}") for i, s in enumerate(rest)])
        answers = dict(zip(rest, found.first()))
        searches = [replace(s, answer=answers[s]) if s in answers else s for s in searches]
    return [s.answer for s in searches]


def _brackets(frame: DataFrame, wide: Sequence[_Search], accuracy: int) -> dict[_Search, tuple]:
    """Values close below and above each rank. Searches of one range share one sketch."""
    points: dict[tuple, list[float]] = {}
    spot: dict[_Search, tuple] = {}
    for s in dict.fromkeys(wide):
        asked = points.setdefault(s.band, [])
        spot[s] = (s.band, len(asked))
        share, margin = (s.rank - s.below) / s.inside, 2 / accuracy + 1 / s.inside
        asked += [max(0.0, share - margin), min(1.0, share + margin)]
    by_band = {s.band: s for s in spot}
    found = frame.agg(
        *[
            F.percentile_approx(F.when(by_band[band].between(), F.col(band[0])), asked, accuracy).alias(f"q{i}")
            for i, (band, asked) in enumerate(points.items())
        ]
    ).first()
    sketch = dict(zip(points, found))
    return {s: tuple(sketch[band][at : at + 2]) for s, (band, at) in spot.items()}


def _sizes(frame: DataFrame, brackets: dict[_Search, tuple]) -> dict[_Search, list[int]]:
    """Exact counts within each search range: below, at, between and at its brackets."""
    counted = []
    for s, (left, right) in brackets.items():
        value, inside = F.col(s.column), s.between()
        low, high = F.lit(left), F.lit(right)
        counted += [
            F.count_if(inside & (value < low)),
            F.count_if(inside & (value == low)),
            F.count_if(inside & (value > low) & (value < high)),
            F.count_if(inside & (value == high)),
        ]
    counts = list(frame.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted)]).first())
    return {s: counts[4 * i : 4 * i + 4] for i, s in enumerate(brackets)}


def medians(
    frame: DataFrame, counts: dict[str, int], small_rows: int = SMALL_ROWS, accuracy: int = ACCURACY
) -> dict[str, float | None]:
    """Exact median of each numeric column, given its number of non-null values."""
    ranks = [(c, r, n) for c, n in counts.items() if n for r in ((n - 1) // 2, n // 2)]
    values = iter(rank_values(frame, ranks, small_rows, accuracy))
    pairs = {c: (next(values), next(values)) for c, n in counts.items() if n}
    return {c: (float(pairs[c][0]) + float(pairs[c][1])) / 2 if c in pairs else None for c in counts}


def _narrow(s: _Search, left, right, lt: int, eql: int, mid: int, eqr: int) -> _Search:
    place = s.rank - s.below
    if place < lt:
        return replace(s, high=left, inside=lt)
    if place < lt + eql:
        return replace(s, answer=left)
    if place < lt + eql + mid:
        return replace(s, low=left, high=right, below=s.below + lt + eql, inside=mid)
    above = lt + eql + mid + (eqr if left != right else 0)
    if place < above:
        return replace(s, answer=right)
    return replace(s, low=right, below=s.below + above, inside=s.inside - above)
