"""Rows as blocks of bytes, which tasks read as NumPy arrays.

A block is a row of a table: its cells hold some thousand rows, a column after the other. Many passes over the same rows, as training needs
them, then cost little more than their arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from adlake.session import materialize

#: Blocks are read again and again, so they are stored in what is fastest to read, and in row groups of a few blocks.
STORED = {"compression": "lz4_raw", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 8, "parquet.page.size.row.check.min": 2}
#: Setting of how many rows a task's batch has, and how many blocks: with Spark's usual 10,000 it would be all blocks of a task.
BLOCKS_AT_ONCE = ("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
#: Numbers and categories, a row each, target and fold.
Arrays = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_RAW = "numbers binary, categories binary, target binary, fold binary"


@dataclass(frozen=True)
class Rows:
    """Blocks of numbers (NaN where missing), numbered categories, target and fold."""

    table: DataFrame
    numbers: Sequence[str]
    categories: Sequence[str]

    def reader(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[Arrays]]:
        """What tasks read the blocks with."""
        wide, named = len(self.numbers), len(self.categories)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Arrays]:
            for batch in batches:
                for cells in zip(*batch.columns, strict=True):
                    numbers, categories, target, fold = (c.as_buffer() for c in cells)
                    values = np.frombuffer(target, np.float64)
                    found = np.frombuffer(categories, np.int32).reshape(named, len(values))
                    yield np.frombuffer(numbers, np.float64).reshape(wide, len(values)), found, values, np.frombuffer(fold, np.int32)

        return read


def rows_of(frame: DataFrame, numbers: dict[str, Column], categories: dict[str, Column], target: Column, fold: Column) -> Rows:
    """A frame's rows, written once. Numbers are double, categories count from 0."""

    wide = len(numbers)
    kinds = [*[np.float64] * (1 + wide), *[np.int32] * (1 + len(categories))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cells = [c.astype(k, copy=False).tobytes() for c, k in zip(columns, kinds, strict=True)]
            own = [b"".join(cells[1 : 1 + wide]), b"".join(cells[2 + wide :]), cells[0], cells[1 + wide]]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in own], ["numbers", "categories", "target", "fold"])

    chosen = [target.cast("double"), *[c.cast("double") for c in numbers.values()], fold.cast("int"), *[c.cast("int") for c in categories.values()]]
    given = frame.select(*[c.alias(f"_{i}") for i, c in enumerate(chosen)])
    return Rows(materialize(given.mapInArrow(pack, _RAW), "rows", **STORED), list(numbers), list(categories))
