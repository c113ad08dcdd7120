"""Token files: a wavelet matrix per shard.

The token ids of a shard are stored as bit planes, the highest bit first. In each plane the ids
stand in the order that the planes above leave: zeros first, then ones, both in their old order. With the
number of ones before every block of a plane, one walk down the planes answers which id is at a place,
how often an id occurs before a place, and where its k-th occurrence is. Documents of a shard follow each
other by ascending doc_id.

A file is a Parquet file of Spark with a row per shard, compressed as a whole; Spark's commit keeps
the output of lost or repeated tasks away.
"""

from __future__ import annotations

import os
import string
import sys
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.llm.text import distinct, gathered, looked_up, pieces_of, slices, strings
from adlake.llm.units import text_bytes
from adlake.session import shared_folder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1 << 20
RANGE_BYTES = 16 << 20
BLOCK_BITS = 512
#: Texts are encoded, and shards end, after runs of about so many bytes.
SLICE_BYTES = 1 << 21
#: Pieces are handed to the tokenizer in runs of about so many bytes.
RUN_BYTES = 1 << 16
#: Pieces of text whose ids a worker remembers.
MEMORY_PIECES = 3 << 18
#: Module in which a worker keeps its encoders.
_KEPT = "adlake_llm_encoders"

SHARDS = "part int, shard int, n_tokens long, bits int, doc_ids binary, lengths binary, planes binary, ranks binary, zeros binary"
_SHARDS = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("bits", pa.int32()), ("doc_ids", pa.binary()),
    ("lengths", pa.binary()), ("planes", pa.binary()), ("ranks", pa.binary()), ("zeros", pa.binary()),
])


class WaveletMatrix:
    """Succinct sequence of ids. Places and occurrences count from 0."""

    def __init__(self, n: int, planes: np.ndarray, ranks: np.ndarray, zeros: np.ndarray):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n, ids = len(ids), ids.astype(np.uint16 if bits <= 16 else np.uint32)
        width = -(-n // BLOCK_BITS) * BLOCK_BITS // 8
        planes, ranks, zeros = np.zeros((bits, width), np.uint8), [], np.zeros(bits, np.int64)
        for level in range(bits):
            ones = ids & ids.dtype.type(1 << (bits - 1 - level)) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[level, : len(packed)] = packed
            counts = np.bitwise_count(planes[level].view(np.uint64)).reshape(-1, BLOCK_BITS // 64).sum(axis=1, dtype=np.int64)
            ranks.append(np.cumsum(counts) - counts)
            ids = np.concatenate([ids.compress(~ones), ids.compress(ones)])
            zeros[level] = n - int(counts.sum())
        return cls(n, planes, np.array(ranks, np.uint32).reshape(bits, -1), zeros)

    @classmethod
    def read(cls, shard: dict) -> WaveletMatrix:
        bits = shard["bits"]
        planes = np.frombuffer(shard["planes"], np.uint8).reshape(bits, -1)
        return cls(shard["n_tokens"], planes, np.frombuffer(shard["ranks"], np.uint32).reshape(bits, -1), np.frombuffer(shard["zeros"], np.int64))

    def _ones(self, level: int, place: int) -> int:
        """Ones of a plane before a place."""
        if place >= self.n:
            return self.n - int(self.zeros[level])
        block, rest = divmod(place, BLOCK_BITS)
        start = block * BLOCK_BITS // 8
        tail = int.from_bytes(self.planes[level, start : start + BLOCK_BITS // 8].tobytes(), "little") & ((1 << rest) - 1)
        return int(self.ranks[level, block]) + tail.bit_count()

    def _bit(self, level: int, place: int) -> int:
        return int(self.planes[level, place >> 3]) >> (place & 7) & 1

    def access(self, place: int) -> int:
        """The id at a place."""
        found = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, place), self._ones(level, place)
            place = int(self.zeros[level]) + ones if bit else place - ones
            found = found << 1 | bit
        return found

    def rank(self, token: int, place: int) -> int:
        """Occurrences of an id before a place."""
        return self._range(token, place)[1]

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _range(self, token: int, place: int) -> tuple[int, int]:
        """Where the id's occurrences begin below the last plane, and how many there are before place."""
        if token < 0 or token >> len(self.planes):
            return 0, 0
        first, last = 0, place
        for level in range(len(self.planes)):
            a, b = self._ones(level, first), self._ones(level, last)
            if token >> (len(self.planes) - 1 - level) & 1:
                first, last = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                first, last = first - a, last - b
        return first, last - first

    def select(self, token: int, occurrence: int) -> int:
        """Place of an occurrence of an id; -1 where there are fewer."""
        first, count = self._range(token, self.n)
        if not 0 <= occurrence < count:
            return -1
        place = first + occurrence
        for level in reversed(range(len(self.planes))):
            one = place >= int(self.zeros[level])
            place = self._place_of(level, place - int(self.zeros[level]) if one else place, one)
        return place

    def _place_of(self, level: int, k: int, one: bool) -> int:
        """Place of the k-th one or zero of a plane."""
        before = self.ranks[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, k, "right")) - 1
        start = block * BLOCK_BITS // 8
        own = np.unpackbits(self.planes[level, start : start + BLOCK_BITS // 8], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(own == one)[k - int(before[block])])

    def ids(self) -> np.ndarray:
        """All ids in order."""
        found = np.zeros(self.n, np.uint32)
        for level in reversed(range(len(self.planes))):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(found)
            above[~ones] = found[: self.zeros[level]]
            above[ones] = found[self.zeros[level] :] | np.uint32(1 << (len(self.planes) - 1 - level))
            found = above
        return found


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps what it has learnt for the tasks after this one."""
    kept = sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class Encoder:
    """Token ids of texts, each distinct piece of text encoded once.

    The tokenizer never joins text across a white space that follows other text, nor a letter with a sign that follows
    it, so ids of a text are those of its pieces, cut before such white space and such signs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(added[i].encode()) if i in added else len(token)
        self.kind = "<u2" if len(self.sizes) <= 1 << 16 else "<u4"
        self.signs = np.zeros(256, bool)  # that no special token holds
        self.signs[[ord(c) for c in set(string.punctuation).difference(*added.values())]] = True
        self.known: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Ids of new pieces. Pieces that begin with a white space and end without one are encoded in runs, others alone."""
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        data, last = np.frombuffer(b"".join(new), np.uint8), np.cumsum(sizes)
        plain = np.isin(data[last - sizes], (0x20, 0x0A)) & _safe_ends(data, last)
        alone, many, sizes = [new[k] for k in np.flatnonzero(~plain)], list(compress(new, plain.tolist())), sizes[plain]
        run = np.cumsum(sizes) // RUN_BYTES
        edges = np.flatnonzero(np.diff(run, prepend=-1)).tolist()  # none where no piece is plain
        for a, b in zip(edges, [*edges[1:], len(many)][: len(edges)], strict=True):
            found = self._encode([b"".join(many[a:b]).decode()])[0]
            ends, wanted = np.cumsum(self.sizes[found]), np.cumsum(sizes[a:b])
            at = np.searchsorted(ends, wanted)
            if at[-1] != len(found) - 1 or (ends[at] != wanted).any():
                raise ValueError("the tokenizer joins text across white space")
            self.known.update(zip(many[a:b], pieces_of(found.tobytes(), found.itemsize * (at + 1)), strict=True))
        self.known.update(zip(alone, (x.tobytes() for x in self._encode([piece.decode() for piece in alone])), strict=True))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice one after another, and the number of ids of each text."""
        n = len(bounds) - 1
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(n, np.int64)
        white = np.flatnonzero((data[1:] == 0x20) | (data[1:] == 0x0A)) + 1
        signs = np.flatnonzero(self.signs[data[1:]]) + 1
        first = distinct(np.concatenate([bounds[:-1][np.diff(bounds) > 0], white[_safe_ends(data, white)], signs[_letter_ends(data, signs)]]))
        pieces, of = strings(data, np.append(first, len(data)))
        if len(self.known) > MEMORY_PIECES:
            self.known.clear()
        ids, counts = gathered(looked_up(self.known, pieces, self._learn), of, self.kind)
        rows = np.searchsorted(bounds, first, "right") - 1
        return ids, np.bincount(rows, counts, minlength=n).astype(np.int64)


def _safe_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end is surely no white space: ASCII from ! to ~, or U+00C0 to U+07FF."""
    one, two = data[ends - 1], data[np.maximum(ends - 2, 0)]
    return ((one > 0x20) & (one < 0x7F)) | ((one >= 0x80) & (two >= 0xC3) & (two <= 0xDF) & (ends >= 2))


def _letter_ends(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end is surely a letter: A to Z in either case, or U+00C0 to U+00FF but for the two signs there."""
    one, two = data[ends - 1], data[np.maximum(ends - 2, 0)]
    return ((one | 0x20) - np.uint8(0x61) < 26) | ((one >= 0x80) & (two == 0xC3) & (one != 0x97) & (one != 0xB7) & (ends >= 2))


def encoded_shards(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row per shard. Tasks hold ranges of ascending doc_id and cut them into shards of whole documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("doc_id is not null")
    parts = max(1, -(-text_bytes(docs) // RANGE_BYTES))

    def shard(part: int, number: int, ids: list, lengths: list, doc_ids: list, bits: int) -> pa.RecordBatch:
        sequence = np.concatenate(ids)
        matrix = WaveletMatrix.of(sequence, bits)
        row = (part, number, matrix.n, bits, np.concatenate(doc_ids).tobytes(), np.concatenate(lengths).tobytes(), matrix.planes.tobytes(), matrix.ranks.tobytes(), matrix.zeros.tobytes())
        return pa.RecordBatch.from_pylist([dict(zip(_SHARDS.names, row, strict=True))], _SHARDS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, encoder = TaskContext.get().partitionId(), 0, None
        ids, lengths, doc_ids, size = [], [], [], 0
        for batch in batches:
            encoder = encoder or worker_encoder(tokenizer)
            bits = max(1, int(max(len(encoder.sizes) - 1, end_id)).bit_length())
            keys = batch["doc_id"].to_numpy().astype(np.int64)
            for first, last, data, bounds in slices(batch["text"], SLICE_BYTES):
                found, counts = encoder.encode(data, bounds)
                ends = np.cumsum(counts)
                ids.append(np.insert(found.astype(np.uint32), ends, end_id))
                lengths.append(counts + 1)
                doc_ids.append(keys[first:last])
                size += len(ids[-1])
                if size >= shard_tokens:
                    yield shard(part, number, ids, lengths, doc_ids, bits)
                    number, ids, lengths, doc_ids, size = number + 1, [], [], [], 0
        if ids:
            yield shard(part, number, ids, lengths, doc_ids, bits)

    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(encode, SHARDS)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Token files of all documents, in ascending order of doc_id.

    Each text is encoded whole, without special tokens, and followed by ``end_id``. A null text is an empty one.
    Rows without doc_id are left out; rows that share one follow each other. Other columns don't
    matter. No documents: an empty table of shards.
    """
    shards = encoded_shards(docs, tokenizer or public_tokenizers.path(TOKENIZER), end_id, shard_tokens)
    shards.write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard and the number of ids before the shard. Sums of parts are added up first, then shards within their part."""
    sizes = shards.select("part", "shard", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return sizes.withColumn("within", within).join(before, "part").select("part", "shard", (F.col("before") + F.col("within")).alias("start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and shard of every document in the token files at path.

    start: ids of all documents before it. ids_crc32: unsigned crc32 of the document's ids as little-endian unsigned
    32-bit integers, its end id included.
    """
    shards = read_shards(spark, path)

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {name: batch[name][row].as_py() for name in batch.schema.names}
                raw = WaveletMatrix.read(shard).ids().astype("<u4").tobytes()
                lengths = np.frombuffer(shard["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(shard["doc_ids"], np.int64)), pa.array(np.full(n, shard["part"], np.int32)), pa.array(np.full(n, shard["shard"], np.int32)),
                    pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64()),
                ], names=["doc_id", "part", "shard", "place", "n_tokens", "ids_crc32"])

    found = shards.mapInArrow(unfold, "doc_id long, part int, shard int, place long, n_tokens long, ids_crc32 long")
    return found.join(shard_starts(shards), ["part", "shard"]).select("doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """part, shard, token, count: how often each token occurs in each shard, from rank alone."""
    return _asked(spark, path, "token long, count long", lambda m: [(t, m.count(t)) for t in tokens])


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """part, shard, place of every occurrence of a token, from select alone."""
    return _asked(spark, path, "place long", lambda m: [(m.select(token, k),) for k in range(m.count(token))])


def _asked(spark: SparkSession, path: str, columns: str, ask) -> DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {name: batch[name][row].as_py() for name in batch.schema.names}
                rows = ask(WaveletMatrix.read(shard))
                kinds = [pa.int32(), pa.int32(), *[pa.int64()] * len(names)]
                columns = zip(*[(shard["part"], shard["shard"], *x) for x in rows], strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "shard", *names])

    return read_shards(spark, path).mapInArrow(answer, f"part int, shard int, {columns}")


def token_path(spark: SparkSession, label: str) -> str:
    """A new place for token files in the shared folder."""
    return f"{shared_folder(spark)}/tokens/{label}-{uuid.uuid4().hex}"


def tokenized(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The documents' digest after they are written as token files to the shared folder and read back."""
    path = token_path(docs.sparkSession, "documents")
    write_tokens(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
