"""JSON documents, landed files and typed record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.fixed import CATALOG_SOURCE, CATALOG_TYPES
from adlake.sources.tables import batch_stamp


def explode_records(
    spark: SparkSession, path: str | Sequence[str], field: str, record: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """One row per record of the list `field` in each JSON document under `path`.

    With ``multi_line`` a file is one document; otherwise each line is one, and
    large files split over tasks.
    """
    kind = f"struct<{record}>" if isinstance(record, str) else record.simpleString()
    document = f"`{field}` array<{kind}>"
    documents = spark.read.schema(document).option("multiLine", multi_line).json(path)
    return documents.select(F.explode(field).alias("r")).select("r.*")


def parse_records(frame: DataFrame, column: str, record: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Expand a JSON text column into the record's fields, next to the kept columns."""
    parsed = frame.select(*keep, F.from_json(column, record).alias("r"))
    return parsed.select(*keep, "r.*")


def landed_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Raw landed files: path, modification time, length and content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def select_or_null(frame: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Select the named fields; a field the frame lacks becomes a typed null."""
    present = set(frame.columns)
    return frame.select(
        *[F.col(f"`{n}`") if n in present else F.lit(None).cast(t).alias(n) for n, t in fields.items()]
    )


def coerce(frame: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns to types; a value that does not fit becomes null.

    Returns the typed frame, and one row per source row with at least one value
    lost: the source columns plus ``bad_columns``.
    """
    cast = {n: F.col(f"`{n}`").try_cast(t) for n, t in types.items()}
    typed = frame.select(*[cast[n].alias(n) if n in cast else F.col(f"`{n}`") for n in frame.columns])
    lost = F.array_compact(
        F.array(*[F.when(F.col(f"`{n}`").isNotNull() & c.isNull(), F.lit(n)) for n, c in cast.items()])
    )
    rejects = frame.withColumn("bad_columns", lost).filter(F.size("bad_columns") > 0)
    return typed, rejects


def typed_catalog(records: DataFrame, ingestion_utc: str) -> DataFrame:
    """Product records reduced to the governed fields, typed, and stamped for the load."""
    typed, _ = coerce(select_or_null(records, CATALOG_TYPES), CATALOG_TYPES)
    return batch_stamp(typed.withColumn("source_system", F.lit(CATALOG_SOURCE)), ingestion_utc)
