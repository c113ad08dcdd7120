"""Scans of lake folders and catalog tables, and literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan(spark: SparkSession, name: str, root: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Read ``{root}/{name}`` as Parquet, or the catalog table `name` without a root.

    Naming columns keeps the scan narrow: only those reach the reader.
    """
    frame = spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(name)
    return frame.select(*columns) if columns else frame


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | Sequence[str]) -> DataFrame:
    """Hand-made rows as a frame; an explicit schema verifies types and nulls."""
    return spark.createDataFrame(list(rows), schema=schema if isinstance(schema, T.StructType) else list(schema))
