"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

One edit changes the letter counts of a word by an L1 distance of two (replaced) or one (inserted, deleted).
For each pair of lengths, words are searched in trees over the counts: a tree prunes every box that is
farther away than that, and what is left is verified letter by letter. The upper levels of the trees deal
words to cells, so that each cell is searched by one task; a word visits the cells whose boxes it can reach.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.session import materialize

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A word's form must occur so many times as often.
FORM_FACTOR = 10
#: One run in so many loses a letter.
TYPO_EVERY = 31
#: Words a cell holds, as estimated from a sample of words that only places the borders of cells; words of the sample a cell needs.
CELL_WORDS = 1 << 14
SAMPLE_WORDS = 1 << 17
CELL_SAMPLE = 32
LEAF_WORDS = 24
#: Distinct words a task counts before it passes them on; pairs verified or dealt at a time.
HELD_WORDS = 1 << 17
PAIRS = 1 << 18
#: Distances computed at a time.
BLOCK = 1 << 15

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_DEALT = "cell long, kind int, word string, n long"
_DEALT_ARROW = pa.schema([("cell", pa.int64()), ("kind", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
_NEAR = "word string, near long, best_n long, best string"
_NEAR_ARROW = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
#: What a word is in a cell: held there, a visitor of the same length, a visitor one letter shorter. All ask for the words held.
HELD, SAME, SHORTER = 0, 1, 2


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: runs of [A-Za-z\\u00C0-\\u00FF] of all texts, A-Z lower-cased, some with a letter deleted by rule; rare and short ones left out."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=_COUNTS)
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                start = zlib.crc32(b"%d:" % doc)
                for word, n in Counter(run.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % TYPO_EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield told()
        yield told()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).filter("doc_id is not null")
    counts = docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def letters(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row each."""
    raw = "".join(words).encode("latin-1")
    return np.frombuffer(raw, np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each of the 256 Latin-1 letters stands in each row."""
    n = len(rows)
    places = np.arange(n)[:, None] * 256 + rows
    return np.bincount(places.ravel(), minlength=256 * n).reshape(n, 256).astype(np.int32)


class Tree:
    """A k-d tree over letter counts. Inner nodes split one letter at a count; leaves are numbered."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.split: list[tuple[int, int, int, int]] = []  # letter, highest count on the left, left and right: a node, or -1 - leaf
        self.leaves: list[np.ndarray] = []
        used = np.flatnonzero(points.max(axis=0) > points.min(axis=0)) if len(points) else np.zeros(0, np.int64)
        narrow = points[:, used]
        self.root = 0
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            own, parent, side = todo.pop()
            at = self._place(narrow, used, own, leaf, todo)
            if parent < 0:
                self.root = at
            else:
                node = list(self.split[parent])
                node[2 + side] = at
                self.split[parent] = tuple(node)

    def _place(self, points: np.ndarray, used: np.ndarray, own: np.ndarray, leaf: int, todo: list) -> int:
        if len(own) > leaf:
            cut = self._cut(points[own])
            if cut is not None:
                low = points[own, cut[0]] <= cut[1]
                self.split.append((int(used[cut[0]]), cut[1], 0, 0))
                node = len(self.split) - 1
                todo += [(own[low], node, 0), (own[~low], node, 1)]
                return node
        self.leaves.append(own)
        return -len(self.leaves)

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that part points most evenly; None if all are equal."""
        best, most = None, 0
        for count in range(int(points.max(initial=0))):
            low = (points <= count).sum(axis=0)
            even = np.minimum(low, len(points) - low)
            letter = int(even.argmax())
            if even[letter] > most:
                best, most = (letter, count), int(even[letter])
            if most == 0 and count and (low == len(points)).all():
                break
        return best

    @classmethod
    def of(cls, root: int, split: list) -> Tree:
        """A tree without points, as it is sent to tasks."""
        tree = cls(np.zeros((0, 256), np.int32), 1)
        tree.root, tree.split = root, split
        return tree

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf whose box holds each point."""
        found = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            at, own = todo.pop()
            if at < 0:
                found[own] = -1 - at
            elif len(own):
                letter, count, left, right = self.split[at]
                low = points[own, letter] <= count
                todo += [(left, own[low]), (right, own[~low])]
        return found

    def within(self, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the points whose L1 distance to its box is at most reach."""
        todo = [(self.root, np.arange(len(points)), np.zeros(len(points), np.int32), {})]
        while todo:
            at, own, far, box = todo.pop()
            if not len(own):
                continue
            if at < 0:
                yield -1 - at, own
                continue
            letter, count, left, right = self.split[at]
            low, high = box.get(letter, (0, 1 << 30))
            own_counts = points[own, letter]
            before = np.maximum(np.maximum(low - own_counts, own_counts - high), 0)
            for node, bounds in ((left, (low, count)), (right, (count + 1, high))):
                now = far - before + np.maximum(np.maximum(bounds[0] - own_counts, own_counts - bounds[1]), 0)
                near = now <= reach
                todo.append((node, own[near], now[near], {**box, letter: bounds}))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of equal length differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows become the rows of one letter more by one inserted letter."""
    front = np.cumprod(short == long[:, :-1], axis=1, dtype=np.uint8).sum(axis=1)
    back = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1)
    return front.astype(np.int64) + back >= short.shape[1]


def near_pairs(held: np.ndarray, asking: np.ndarray, leaf: int = LEAF_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of asking and of held (letters, all of one length each) that are one edit apart."""
    shorter = asking.shape[1] < held.shape[1]
    counts, asked = letter_counts(held), letter_counts(asking)
    used = np.flatnonzero(counts.any(axis=0) | asked.any(axis=0))
    counts, asked = counts[:, used], asked[:, used]
    reach = 1 if shorter else 2
    tree = Tree(counts, leaf)
    # a row a letter, in the smallest integers that hold a distance
    kind = np.int8 if held.shape[1] < 64 else np.int32
    by_letter, asked_by_letter = np.ascontiguousarray(counts.T, kind), np.ascontiguousarray(asked.T, kind)
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    check = one_inserted if shorter else one_replaced
    waiting, size = [], 0

    def verify() -> None:
        nonlocal waiting, size
        if size:
            q, t = (np.concatenate(x) for x in zip(*waiting, strict=True))
            good = check(asking[q], held[t])
            out.append((q[good], t[good]))
        waiting, size = [], 0

    for number, own in tree.within(asked, reach):
        members = tree.leaves[number]
        if len(members):
            held_here = by_letter[:, members]
            own = own[_box_distance(asked_by_letter[:, own], held_here.min(axis=1), held_here.max(axis=1)) <= reach]
        for b in range(0, len(members), BLOCK):
            part = members[b : b + BLOCK]
            there = by_letter[:, part]
            step = max(1, BLOCK // len(part))
            for a in range(0, len(own), step):
                some = own[a : a + step]
                q, t = np.nonzero(_distance(asked_by_letter[:, some], there) == reach)
                waiting.append((some[q], part[t]))
                size += len(q)
                if size >= PAIRS:
                    verify()
    verify()
    q, t = (np.concatenate(x) for x in zip(*out, strict=True))
    return q, t


def _box_distance(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of every column of a to a box."""
    return np.abs(a - np.clip(a, low[:, None], high[:, None])).sum(axis=0, dtype=np.int32)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """L1 distance of every column of a to every column of b."""
    far = np.zeros((a.shape[1], b.shape[1]), a.dtype)
    for x, y in zip(a, b, strict=True):
        far += np.abs(x[:, None] - y)
    return far


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    groups = defaultdict(list)
    for k, word in enumerate(words):
        groups[len(word)].append(k)
    return {n: np.array(own) for n, own in groups.items()}


def cell_trees(words: DataFrame, cell_words: int = CELL_WORDS, sample_words: int = SAMPLE_WORDS) -> dict[int, Tree]:
    """For each length of a sample of about ``sample_words``, chosen by hash, the tree whose leaves are cells. It decides only which task searches what."""
    total = words.count()
    share = min(1.0, sample_words / max(total, 1))
    sample = [r.word for r in words.filter(F.expr(f"pmod(xxhash64(word), 1000000) < {math.ceil(share * 1e6)}")).select("word").collect()]
    leaf = max(CELL_SAMPLE, math.floor(cell_words * len(sample) / max(total, 1)))
    trees = {}
    for n, own in _by_length(sample).items():
        trees[n] = Tree(letter_counts(letters([sample[k] for k in own])), leaf)
    return trees


def dealt_words(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """cell, kind, word, n: each word in its own cell, and in the cells it can reach: later ones of its length and all of one letter more."""
    shared = words.sparkSession.sparkContext.broadcast({n: (tree.root, tree.split) for n, tree in trees.items()})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, nothing = {n: Tree.of(*sent) for n, sent in shared.value.items()}, Tree.of(-1, [])
        for batch in batches:
            texts, counts = batch["word"].to_pylist(), batch["n"].to_numpy()
            for n, own in _by_length(texts).items():
                points = letter_counts(letters([texts[k] for k in own]))
                home = trees.get(n, nothing).leaf_of(points)
                parts = [(n, HELD, home, np.arange(len(own)))]
                for size, reach, kind in ((n, 2, SAME), (n + 1, 1, SHORTER)):
                    for leaf, some in trees.get(size, nothing).within(points, reach):
                        if kind == SAME:
                            some = some[home[some] < leaf]  # the words of that leaf don't come back
                        parts.append((size, kind, np.full(len(some), leaf), some))
                cells = np.concatenate([(np.int64(size) << 32) + leaf for size, _, leaf, _ in parts])
                kinds = np.concatenate([np.full(len(some), kind, np.int32) for _, kind, _, some in parts])
                rows = own[np.concatenate([some for *_, some in parts])]
                for a in range(0, len(rows), PAIRS):
                    b = slice(a, a + PAIRS)
                    yield pa.RecordBatch.from_arrays([pa.array(cells[b]), pa.array(kinds[b]), pa.array([texts[k] for k in rows[b]], pa.string()), pa.array(counts[rows[b]])], schema=_DEALT_ARROW)

    return words.mapInArrow(deal, _DEALT)


def _search(cell: pa.Table) -> pa.Table:
    """What the words of a cell and its visitors learn there: near words, and the most frequent of them."""
    kinds, n = cell["kind"].to_numpy(), cell["n"].to_numpy()
    words = np.array(cell["word"].to_pylist(), object)
    held = np.flatnonzero(kinds == HELD)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(held):
        rows = letters(words[held].tolist())
        for kind in (HELD, SAME, SHORTER):
            asking = np.flatnonzero(kinds == kind)
            if len(asking):
                q, t = near_pairs(rows, letters(words[asking].tolist()))
                us.append(asking[q])
                vs.append(held[t])
                if kind != HELD:  # held words find each other from both sides
                    us.append(held[t])
                    vs.append(asking[q])
    u, v = np.concatenate(us), np.concatenate(vs)
    if not len(u):
        return _NEAR_ARROW.empty_table()
    place = np.zeros(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[v], -n[v], u))
    u, v = u[order], v[order]
    first = np.flatnonzero(np.diff(u, prepend=-1))
    near = np.diff(first, append=len(u))
    return pa.Table.from_arrays([pa.array(words[u[first]], pa.string()), pa.array(near), pa.array(n[v[first]]), pa.array(words[v[first]], pa.string())], schema=_NEAR_ARROW)


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word and root of every word with a form. n grows tenfold with each step, which bounds the doublings."""
    steps = max(1, math.floor(math.log(max(most, 1), FORM_FACTOR)) + 1)
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        found = materialize(found, "roots")
        later = found.select(F.col("word").alias("root"), F.col("root").alias("_root"))
        found = found.join(later, "root", "left").select("word", F.coalesce("_root", "root").alias("root"))
    return found


def spelling_variants(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Words with the more frequent word that each may be a misspelling of.

    Result: word, form (its near word of largest n, ties: smallest in code-point order, if that n is at least 10 times
    the word's; else null), root (the last of the forms of forms, the word itself without one), n, n_near
    (words one inserted, deleted or replaced letter away, 0 if none), form_n (null without a form).

    Words are runs of [A-Za-z\\u00C0-\\u00FF] in A-Z lower case of at least 7 letters that occur at least twice. Where 31
    divides h, the crc32 of ``<doc_id>:<run>``, the run loses its letter number h % length. A null or
    empty text has no words; rows without doc_id are left out; repeated rows count each. Other columns don't
    matter. No documents: no rows.
    """
    words = materialize(word_counts(docs), "words")
    dealt = dealt_words(words, cell_trees(words, cell_words))
    near = dealt.groupBy("cell").applyInArrow(_search, _NEAR)
    own = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    best = F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    both = own.unionByName(near.withColumn("n", F.lit(None).cast("long")))
    merged = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min(best).alias("b"))
    is_form = -F.col("b.less") >= FORM_FACTOR * F.col("n")
    merged = merged.select("word", "n", "n_near", F.when(is_form, F.col("b.form")).alias("form"), F.when(is_form, -F.col("b.less")).alias("form_n"))
    merged = materialize(merged, "variants")
    roots = _roots(merged.filter("form is not null"), merged.agg(F.max("n")).first()[0] or 1)
    return merged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
