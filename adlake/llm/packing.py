"""Best-fit packing of documents into sequences by hierarchical residuals.

Documents become pieces of at most a sequence's tokens. Pieces are dealt by hash to nodes, and each
node packs its own by best fit. Bins that are nearly full are emitted there. What is left goes up a
tree: a group of nodes takes their underfull bins as items and packs them by best fit again, until
one group is left.

What a node passes up is bounded without losing a merge. Two bins above half never join. Best fit leaves
a node at most one bin of half or less, so the nodes of one group bring at most as many of those as the
group has members, and need at most as many hosts for them. A node therefore passes its one small bin
and its roomiest others, a group's size of them for each level above.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from itertools import compress
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.text import LOWER, WHITE, gathered, looked_up, pieces_of, slices, strings, words
from adlake.session import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEQUENCE_TOKENS = 4096
#: Pieces a node packs, and nodes a group merges.
NODE_PIECES = 1 << 13
GROUP_NODES = 64
#: Room, in tokens, up to which a bin counts as nearly full.
NEARLY_FULL = 16
#: Words and parts of words a worker keeps the ids of, before it forgets all and takes in a chunk more.
KNOWN_WORDS = 1 << 19
KNOWN_PARTS = 1 << 19
CHUNK_BYTES = 1 << 21
#: Texts go through in runs of about so many bytes.
SLICE_BYTES = 1 << 21

_BLANK = re.compile(rb"[ \t-\r]")
_KEPT_HERE = "_adlake_worker_words"
#: Kind of every byte of plain words in lower case: other sign, letter, digit.
_DIGIT = 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KINDS[0x30:0x3A] = _DIGIT
#: A node's bins are numbered from the node's number shifted by so many bits.
_BIN_BITS = 24

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_IDS = pa.field("ids", pa.binary())


class WordIds:
    """Ids of texts, each distinct word encoded once.

    This tokenizer drops white space and never joins what stands on both sides of it, so the ids of a
    text are those of its words one after another. A word of plain letters, digits and signs is cut further as the
    tokenizer does; any other word goes to the tokenizer whole. Ids are kept as little-endian unsigned 32-bit integers,
    until there are too many.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a part
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, new: list[bytes]) -> None:
        """Ids of parts not known yet, encoded in one run and cut where parts end."""
        ids = self._ids([b" ".join(new).decode()])[0]
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) != len(new) or at[-1] != len(ids):
            raise ValueError("the tokenizer cuts parts of words further")
        self.parts.update(zip(new, pieces_of(ids.tobytes(), 4 * at), strict=True))

    def _learn(self, new: list[bytes]) -> None:
        """Ids of words not known yet."""
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        data = np.frombuffer(b"".join(new), np.uint8)
        plain = _plain(data, ends)
        whole = [new[k] for k in np.flatnonzero(~plain).tolist()]
        if whole:
            self.words.update(zip(whole, (x.tobytes() for x in self._ids([word.decode("utf-8", "replace") for word in whole])), strict=True))
        if not plain.any():
            return
        sizes = np.diff(ends, prepend=0)
        data, ends = data[np.repeat(plain, sizes)], np.cumsum(sizes[plain])
        data, starts = _parts(data, ends)
        distinct, of = strings(data, np.append(starts, len(data)))
        ids, counts = gathered(looked_up(self.parts, distinct, self._learn_parts), of, "<u4")
        at = np.cumsum(counts)[np.searchsorted(starts, ends) - 1]
        self.words.update(zip(compress(new, plain.tolist()), pieces_of(ids.tobytes(), 4 * at), strict=True))

    def encode_texts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice one after another, and the number of ids of each; a long one goes through in chunks that end before white space."""
        found, n_ids, at = [], np.zeros(len(bounds) - 1, np.int64), 0
        while at < len(data):
            cut = _BLANK.search(data, at + CHUNK_BYTES)
            end = cut.start() if cut else len(data)
            chunk, edges = data[at:end], np.clip(bounds, at, end) - at
            starts, ends, rows = words(chunk, edges, WHITE)
            at = end
            if not len(starts):
                continue
            if len(self.words) > KNOWN_WORDS:
                self.words.clear()
            if len(self.parts) > KNOWN_PARTS:
                self.parts.clear()
            distinct, of = strings(chunk[~WHITE[chunk]], np.append(0, np.cumsum(ends - starts)))
            ids, counts = gathered(looked_up(self.words, distinct, self._learn), of, "<u4")
            found.append(ids)
            n_ids += np.bincount(rows, counts, minlength=len(n_ids)).astype(np.int64)
        return np.concatenate([np.zeros(0, "<u4"), *found]), n_ids

    def encode(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        return self.encode_texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tobytes()


def _plain(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words are of ! to ~ and of U+00C0 to U+00FF but for the two signs there, without the begin of a special token."""
    starts = np.append(0, ends[:-1])
    lead, tail = data == 0xC3, (data >= 0x80) & (data < 0xC0)
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = lead[:-1], tail[1:]
    before[starts], after[ends - 1] = False, False
    good = ((data > 0x20) & (data < 0x7F)) | (lead & after) | (tail & before & (data != 0x97) & (data != 0xB7))
    good[:-1] &= (data[:-1] != 0x3C) | (data[1:] != 0x7C)
    return np.logical_and.reduceat(good, starts)


def _parts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Plain words in lower case, and where the parts begin into which the tokenizer cuts them.

    Fixed rule: 's 't 're 've 'm 'll 'd where a part begins, else a run of letters, one digit, or a run of other signs.
    """
    low = LOWER[data]
    low[1:][(data[:-1] == 0xC3) & (data[1:] <= 0x9E)] += 0x20  # these bytes are above 0x7F
    kind = _KINDS[low]
    begins = kind == _DIGIT
    begins[0] = True
    begins[1:] |= kind[1:] != kind[:-1]
    begins[ends[:-1]] = True
    at = np.flatnonzero(begins & (low == 0x27))
    room = ends[np.searchsorted(ends, at, "right")] - at
    padded = np.append(low, [0, 0])
    one, two = padded[at + 1], padded[at + 2]
    short = (room > 1) & np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (room > 2) & (((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C)))
    begins[at[short | long] + 1] = False
    rest = np.concatenate([at[short] + 2, at[long] + 3])
    begins[rest[rest < len(low)]] = True
    return low, np.flatnonzero(begins)


def worker_words(path: str) -> WordIds:
    """The ids known to this Python worker, which keeps them for the tasks after this one."""
    kept = sys.modules.setdefault(_KEPT_HERE, ModuleType(_KEPT_HERE)).__dict__
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def document_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, size: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; with_ids adds the ids themselves.

    Every text is encoded whole, without special tokens, and followed by ``end_id``. Only documents
    longer than ``size`` tokens are cut. A null text is an empty one: its end id alone.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    schema = _PIECES_ARROW.append(_IDS) if with_ids else _PIECES_ARROW
    width = 4 * size

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_words(path)
        for batch in batches:
            docs = batch["doc_id"].to_pylist()
            for first, last, data, bounds in slices(batch["text"], SLICE_BYTES):
                out: list[list] = [[] for _ in schema]
                found, counts = known.encode_texts(data, bounds)
                ends = np.cumsum(counts)
                raw, ends = np.insert(found, ends, end_id).tobytes(), (4 * (ends + np.arange(1, len(ends) + 1))).tolist()
                for doc, begin, end in zip(docs[first:last], [0, *ends[:-1]], ends, strict=True):
                    for k, a in enumerate(range(begin, end, width)):
                        ids = raw[a : min(a + width, end)]
                        for column, value in zip(out, (doc, k, (a - begin) // 4, len(ids) // 4, zlib.crc32(ids), ids), strict=False):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).filter("doc_id is not null")
    return docs.mapInArrow(encode, _PIECES + (", ids binary" if with_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and what each bin holds. Items go in the order given, each to the fullest bin it fits."""
    bins, offsets, rooms = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    of_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r: some bin has room r
    for k, size in enumerate(sizes.tolist()):
        fits = free >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            chosen = of_room[room].pop()
            if not of_room[room]:
                free ^= 1 << room
        else:
            chosen, room = len(rooms), capacity
            rooms.append(room)
        bins[k], offsets[k] = chosen, capacity - room
        rooms[chosen] = room = room - size
        if room:
            of_room[room].append(chosen)
            free |= 1 << room
    return bins, offsets, capacity - np.array(rooms, np.int64)


def _open_bins(used: np.ndarray, capacity: int, nearly_full: int, hosts: int) -> np.ndarray:
    """Which bins a node passes up: those of half or less, and of the others that aren't nearly full the ``hosts`` roomiest."""
    keep = np.zeros(len(used), bool)
    if hosts:
        small = 2 * used <= capacity
        others = np.flatnonzero(~small & (capacity - used > nearly_full))
        keep[small] = True
        keep[others[np.argsort(used[others], kind="stable")[:hosts]]] = True
    return keep


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS, node_pieces: int = NODE_PIECES, group_nodes: int = GROUP_NODES, nearly_full: int = NEARLY_FULL) -> DataFrame:
    """All columns of written pieces (each of length 1 to size) with sequence_id and offset.

    Pieces are dealt by their place in the written table, so that no key makes a large node.
    """
    nodes = max(1, -(-pieces.count() // node_pieces))
    levels = 0
    while group_nodes**levels < nodes:
        levels += 1
    columns = pieces.columns
    sent = pieces.withColumn("node", F.expr(f"pmod(xxhash64(monotonically_increasing_id()), {nodes}L)"))

    def pack(node: pa.Table) -> pa.Table:
        lengths = node["length"].to_numpy()
        order = np.lexsort([node[c].to_numpy() for c in ("ids_crc32", "piece", "doc_id")] + [-lengths])
        node, lengths = node.take(pa.array(order)), lengths[order]
        bins, offsets, used = best_fit(lengths, size)
        keep = _open_bins(used, size, nearly_full, group_nodes * levels)
        first = (node["node"][0].as_py() << _BIN_BITS) if node.num_rows else 0
        left = np.where((offsets == 0) & keep[bins], used[bins], 0)
        return node.append_column("bin", pa.array(first + bins)).append_column("offset", pa.array(offsets)).append_column("left", pa.array(left))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sent.schema)
    packed = materialize(sent.groupBy("node").applyInArrow(pack, f"{schema}, bin long, offset long, left long"), "packed")
    moved = _merge(packed.filter("left > 0").select("bin", "node", F.col("left").alias("used")), levels, size, group_nodes, nearly_full)
    if moved is not None:
        packed = packed.join(moved, "bin", "left")
    else:
        packed = packed.withColumns({"head": F.lit(None).cast("long"), "shift": F.lit(None).cast("long")})
    return packed.select(*columns, F.coalesce("head", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def _merger(size: int, nearly_full: int, hosts: int) -> Callable[[pa.Table], pa.Table]:
    """Best fit of the bins of one group. Rows: bins that moved into another, with used 0, and bins that go up, with what they hold."""

    def merge(group: pa.Table) -> pa.Table:
        names, used = group["bin"].to_numpy(), group["used"].to_numpy()
        order = np.lexsort([names, -used])
        names, used = names[order], used[order]
        bins, shifts, total = best_fit(used, size)
        keep = _open_bins(total, size, nearly_full, hosts)[bins]
        heads = np.zeros(len(total), np.int64)
        heads[bins[shifts == 0]] = names[shifts == 0]
        told = (shifts > 0) | keep
        left = np.where((shifts == 0) & keep, total[bins], 0)
        node = np.full(len(names), group["node"][0].as_py() if group.num_rows else 0)
        out = [pa.array(x[told]) for x in (names, heads[bins], shifts, left, node)]
        return pa.Table.from_arrays(out, names=["bin", "head", "shift", "used", "node"])

    return merge


def _merge(items: DataFrame, levels: int, size: int, group_nodes: int, nearly_full: int) -> DataFrame | None:
    """bin, head, shift of every underfull bin that was merged into another: the bin it is now part of, and where there."""
    schema = "bin long, head long, shift long, used long, node long"
    moved = None
    for level in range(1, levels + 1):
        dealt = items.withColumn("node", F.expr(f"node div {group_nodes}L"))
        merged = dealt.groupBy("node").applyInArrow(_merger(size, nearly_full, group_nodes * (levels - level)), schema)
        found = materialize(merged, "merged")
        new = found.filter("shift > 0").select("bin", "head", "shift")
        if moved is None:
            moved = new
        else:
            again = new.select(F.col("bin").alias("head"), F.col("head").alias("_head"), F.col("shift").alias("_shift"))
            later = moved.join(again, "head", "left").select("bin", F.coalesce("_head", "head").alias("head"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift"))
            moved = materialize(later.unionAll(new), "moves")
        items = found.filter("used > 0").select("bin", "node", "used")
    return moved


def packed_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, size: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence that holds them and their place there.

    Result: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32, sequence_id, offset;
    with_ids adds the ids. Sequences hold at most ``size`` tokens without gaps. A null or empty text is
    its end id alone. Repeated rows are each packed. Rows without doc_id are left out. Other columns don't matter. No
    documents: no rows.
    """
    pieces = materialize(document_pieces(docs, tokenizer, end_id, size, with_ids), "pieces")
    return pack_pieces(pieces, size)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (little-endian unsigned 32-bit) and doc_starts (offset of every piece) of pieces packed with their ids."""

    def join(sequence: pa.Table) -> pa.Table:
        offsets = sequence["offset"].to_numpy()
        order = np.argsort(offsets)
        ids = b"".join(sequence["ids"][int(k)].as_py() for k in order)
        out = {"sequence_id": sequence["sequence_id"][0].as_py(), "n_tokens": len(ids) // 4, "ids": ids, "doc_starts": offsets[order].tolist()}
        return pa.Table.from_pylist([out], schema)

    schema = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("doc_starts", pa.list_(pa.int64()))])
    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, n_tokens long, ids binary, doc_starts array<long>")
