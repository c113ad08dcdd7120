"""Catalog tables, aligned appends and catalog housekeeping."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.fixed import BATCH_STAMP_FORMAT
from adlake.session import OPEN_FILES, OPEN_FILES_SETTING, setting

_VERSION, _METRIC = "adlake.table", "adlake.metric."
ROWS = "rows"


class CheckFailed(ValueError):
    """A written table breaks a check; it was dropped and what the name answered to before still stands."""


class TableStore:
    """Named tables of the session catalog, with their files under one root.

    A name is ``folder/table``; every folder is a schema of the catalog, located under the root. The name itself is a
    view of the table's newest version. A write makes a version of its own, checks it, and only then turns the view to it,
    which is one change of the catalog: readers see the old rows or the new ones, whenever a job fails. Versions
    no view shows, such as those of broken jobs, go with the next write. Rows of a failed append are never seen.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = f"lake_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"

    def _parts(self, name: str) -> tuple[str, str, str]:
        folder, _, table = name.rpartition("/")
        folder = re.sub(r"\W", "_", folder) or "bronze"
        return f"{self.schema}_{folder}", table, f"{self.root}/{folder}"

    def table(self, name: str) -> str:
        """The name under which the catalog knows the table."""
        schema, table, _ = self._parts(name)
        return f"{schema}.{table}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def _properties(self, name: str) -> dict[str, str]:
        return dict(self.spark.sql(f"SHOW TBLPROPERTIES {self.table(name)}").collect())

    def metrics(self, name: str) -> dict[str, int]:
        """What was counted while the table's rows were written, ``rows`` among it. Nothing is read."""
        if not self.exists(name):
            raise KeyError(f"no table {name!r} under {self.root}")
        return {k.removeprefix(_METRIC): int(v) for k, v in self._properties(name).items() if k.startswith(_METRIC)}

    def write(
        self,
        frame: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        keep_schema: bool = False,
        metrics: Mapping[str, str] | None = None,
        expected: Mapping[str, int] | None = None,
        unique: Sequence[str] = (),
    ) -> dict[str, int]:
        """Replace a table; its schema travels along unless ``keep_schema`` asks for the old one.

        metrics: names and SQL counts, found in the same pass that writes the rows and kept with the table; they must add up
        over rows. expected: values that some of them must have. unique: columns that must name a row. Where a check fails
        the table stays as it was. Returns the metrics.
        """
        if keep_schema and self.exists(name):
            require_schema(frame, self.read(name).schema)
        schema, table, place = self._parts(name)
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{place}'")
        version = f"{table}__{uuid.uuid4().hex[:12]}"
        counted = {ROWS: "count(*)", **(metrics or {})}
        observed, found = _observed(frame, counted)
        with setting(self.spark, OPEN_FILES_SETTING, OPEN_FILES if partition_by else 0):
            observed.write.format("parquet").option("compression", "zstd").partitionBy(*partition_by).saveAsTable(f"{schema}.{version}")
        values = found.get
        problems = [f"{n} is {values[n]}, not {v}" for n, v in (expected or {}).items() if values[n] != v]
        if unique and not problems:
            again = self.spark.table(f"{schema}.{version}").groupBy(*unique).count().filter("count > 1").count()
            problems = [f"{again} values of {', '.join(unique)} name several rows"] * bool(again)
        if problems:
            self.spark.sql(f"DROP TABLE {schema}.{version}")
            raise CheckFailed(f"{name}: {'; '.join(problems)}")
        kept = {_VERSION: version, **{_METRIC + n: v for n, v in values.items()}}
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} TBLPROPERTIES ({properties}) AS SELECT * FROM {schema}.{version}")
        self._drop_versions(schema, table, version)
        return values

    def show(self, name: str, of: str, columns: Sequence[str], where: str) -> None:
        """Make a name answer with some rows and columns (in SQL) of another table of the store, as that is at any time."""
        schema, table, place = self._parts(name)
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{place}'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT {', '.join(columns)} FROM {self.table(of)} WHERE {where}")

    def _drop_versions(self, schema: str, table: str, shown: str) -> None:
        """Drop the versions of a table that its view doesn't show, and the files of versions that never became tables."""
        context = self.spark.sparkContext
        listed = self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{table}__*'").collect()
        for row in listed:
            if row.tableName != shown.lower() and _is_version(row.tableName, table.lower()):
                self.spark.sql(f"DROP TABLE IF EXISTS {schema}.{row.tableName}")
        place = context._jvm.org.apache.hadoop.fs.Path(self.spark.sql(f"DESCRIBE SCHEMA {schema}").filter("info_name = 'Location'").first().info_value)
        files = place.getFileSystem(context._jsc.hadoopConfiguration())
        for status in files.listStatus(place) if files.exists(place) else []:
            folder = status.getPath().getName()
            if folder.lower() != shown.lower() and _is_version(folder.lower(), table.lower()):
                files.delete(status.getPath(), True)

    def append(self, frame: DataFrame, name: str) -> None:
        """Add rows to a table, aligned to its schema. Its row count goes on; other metrics are those of a whole write and go."""
        rows = align_to_schema(frame, self.read(name).schema)
        schema, table, _ = self._parts(name)
        properties = self._properties(name)
        observed, found = _observed(rows, {ROWS: "count(*)"})
        observed.write.insertInto(f"{schema}.{properties[_VERSION]}")
        total = int(properties[_METRIC + ROWS]) + found.get[ROWS]
        others = [f"'{k}'" for k in properties if k.startswith(_METRIC) and k != _METRIC + ROWS]
        self.spark.sql(f"ALTER VIEW {schema}.{table} SET TBLPROPERTIES ('{_METRIC}{ROWS}' = '{total}')")
        if others:
            self.spark.sql(f"ALTER VIEW {schema}.{table} UNSET TBLPROPERTIES ({', '.join(others)})")

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise KeyError(f"no table {name!r} under {self.root}")
        return self.spark.table(self.table(name))


def _observed(frame: DataFrame, metrics: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """The frame with counts that its next run finds on the side."""
    found = Observation()
    return frame.observe(found, *[F.coalesce(F.expr(sql).cast("bigint"), F.lit(0)).alias(n) for n, sql in metrics.items()]), found


def _is_version(name: str, table: str) -> bool:
    return re.fullmatch(re.escape(table) + "__[0-9a-f]{12}", name) is not None


def require_schema(frame: DataFrame, expected: T.StructType) -> None:
    """Raise unless names, types and order equal the expected schema."""
    actual = [(f.name, f.dataType) for f in frame.schema]
    wanted = [(f.name, f.dataType) for f in expected]
    if actual != wanted:
        raise ValueError(f"schema differs: expected {wanted}, got {actual}")


def align_to_schema(frame: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns in its order: cast, null where missing, extras dropped."""
    present = set(frame.columns)
    return frame.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def batch_stamp(frame: DataFrame, ingestion_utc: str) -> DataFrame:
    """Stamp a load with one fixed time and the batch id spelled from it."""
    moment = F.to_timestamp_ntz(F.lit(ingestion_utc))
    return frame.withColumns(
        {"ingestion_utc": moment, "batch_id": F.date_format(moment.cast("timestamp"), BATCH_STAMP_FORMAT)}
    )


def ensure_schemas(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def retire_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop tables; a store's view goes with the version it shows."""
    for name in names:
        if not spark.catalog.tableExists(name):
            continue
        if spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            continue
        version = dict(spark.sql(f"SHOW TBLPROPERTIES {name}").collect()).get(_VERSION)
        spark.sql(f"DROP VIEW {name}")
        if version:
            spark.sql(f"DROP TABLE IF EXISTS {name.rpartition('.')[0]}.{version}")


def missing_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """The names, of those given, that no table answers to."""
    return [name for name in names if not spark.catalog.tableExists(name)]
