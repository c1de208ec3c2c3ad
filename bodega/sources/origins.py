"""Where ingest reads from: a relational database, files, or DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bodega.operators.ingest import rows_after
from bodega.schemas import TABLES
from bodega.sources.tables import read_csv, read_table


class Source(Protocol):
    """Anything that gives the rows of a named table."""

    def load(self, spark: SparkSession, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileSource:
    """One folder or file per table below ``base``, named like the table in lower case."""

    base: str
    fmt: str = "parquet"
    suffix: str = ""

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        path, schema = f"{self.base}/{table.lower()}{self.suffix}", TABLES[table].schema
        if self.fmt == "csv":
            return read_csv(spark, path, schema)
        return read_table(spark, path, self.fmt, schema)


@dataclass(frozen=True)
class FrameSource:
    """Tables given as DataFrames."""

    frames: Mapping[str, DataFrame]

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        if table not in self.frames:
            raise KeyError(f"no source table {table}")
        return self.frames[table]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a relational database, read in parallel by ranges of the key.

    The bounds come from one min/max/count row of the rows that will be read, so an incremental load
    is cut as finely as a full one. Rows outside the bounds are still read.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schema: str = "dbo"
    rows_a_task: int = 500_000
    most_tasks: int = 64  # connections the database is asked for at a time
    fetch_size: int = 10_000

    def relation(self, table: str, condition: str = "") -> str:
        where = f" WHERE {condition}" if condition else ""
        return f"(SELECT * FROM {self.schema}.{table}{where}) src"

    def bounds(self, spark: SparkSession, table: str, key: str, condition: str = "") -> tuple | None:
        where = f" WHERE {condition}" if condition else ""
        row = spark.read.jdbc(
            self.url,
            f"(SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT(*) AS n FROM {self.schema}.{table}{where}) bounds",
            properties=dict(self.properties),
        ).first()
        # databases differ in the case of aliases, so by position
        return None if row is None or row[0] is None else (row[0], row[1], row[2])

    def load(self, spark: SparkSession, table: str, condition: str = "") -> DataFrame:
        key = TABLES[table].key
        options = {**self.properties, "fetchsize": str(self.fetch_size)}
        bounds = self.bounds(spark, table, key, condition)
        if bounds is None:
            return spark.read.jdbc(self.url, self.relation(table, condition), properties=options)
        tasks = min(self.most_tasks, max(1, -(-int(bounds[2]) // self.rows_a_task)))
        return spark.read.jdbc(
            self.url, self.relation(table, condition), column=key, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=tasks, properties=options)

    def load_after(self, spark: SparkSession, table: str, column: str, last: str, inclusive: bool = False) -> DataFrame:
        """The rows above a watermark and those without a value, selected and cut by the database."""
        bound = f"'{last.replace(chr(39), chr(39) * 2)}'"
        return self.load(spark, table, f"{column} {'>=' if inclusive else '>'} {bound} OR {column} IS NULL")


def read_full(spark: SparkSession, source: Source, table: str) -> DataFrame:
    return source.load(spark, table)


def read_incremental(spark: SparkSession, source: Source, table: str, column: str, last: str | None,
                     inclusive: bool = False) -> DataFrame:
    return rows_after(load_after(spark, source, table, column, last, inclusive), column, last, inclusive)


def load_after(spark: SparkSession, source: Source, table: str, column: str | None, last: str | None,
               inclusive: bool = False) -> DataFrame:
    """At least the rows above the watermark and those without a value: those alone where the source can select, else all."""
    if last is not None and column and hasattr(source, "load_after"):
        return source.load_after(spark, table, column, last, inclusive)
    return source.load(spark, table)


def load_csv_to_jdbc(spark: SparkSession, path: str, schema: T.StructType, url: str, table: str,
                     properties: Mapping[str, str] | None = None, chunk: int = 5_000,
                     writers: int = 8, column_types: str | None = None) -> None:
    """Replace a database table by the rows of a CSV, inserted in chunks.

    ``writers`` bounds the connections; the file is still read by as many tasks as it has splits.
    """
    writer = read_csv(spark, path, schema).repartition(writers).write.mode("overwrite").option(
        "batchsize", chunk)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties or {}))
