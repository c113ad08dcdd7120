"""Table layout for data skipping."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clustered(frame: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The same rows in `files` partitions, each a sorted range of the columns.

    A hash of the whole row ends the range, so rows of one hot value fill several partitions. The
    frame is read twice, for the bounds of the ranges and for the rows: write down what is dear first.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns])
    return frame.repartitionByRange(files, *columns, spread).sortWithinPartitions(*columns)


def file_count(rows: int, cores: int, rows_per_file: int = 1_000_000, least_rows: int = 50_000) -> int:
    """Files for a table: sized by rows, and no fewer than the cores while they stay worthwhile."""
    return max(1, ceil(rows / rows_per_file), min(cores, rows // least_rows))


def file_ranges(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and per-column minimum and maximum of each file behind a table."""
    return (
        frame.select(F.input_file_name().alias("file"), *columns)
        .groupBy("file")
        .agg(
            F.count("*").alias("rows"),
            *[F.min(c).alias(f"min_{c}") for c in columns],
            *[F.max(c).alias(f"max_{c}") for c in columns],
        )
    )
