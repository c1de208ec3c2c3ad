"""Lake tables: read, write, export, register, measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bodega.session import folder_bytes


# Formats that keep schema and partitions in a log of their own: nothing to declare or repair.
SELF_DESCRIBED = ("delta", "iceberg", "hudi")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Read a table by path; a schema keeps partition values such as month=01 as text."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt not in SELF_DESCRIBED:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), rebalance: bool = False, dynamic: bool = False) -> None:
    """Write a table, whole or partitioned.

    ``rebalance`` shuffles by the partition columns and lets adaptive execution split a hot
    partition and merge small ones into even files. ``dynamic`` overwrites only the partitions
    that occur in ``df``. The path must not be read by ``df`` itself.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if mode == "overwrite" and partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_partitioned(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet") -> None:
    write_table(df, path, fmt, mode="append", partition_by=columns)


def export_table(df: DataFrame, path: str, formats: Sequence[str] = ("csv", "parquet")) -> dict[str, str]:
    """Write the same rows once per format below ``path``; returns the folder of each."""
    folders = {fmt: f"{path}/{fmt}" for fmt in formats}
    for fmt, folder in folders.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.options(header="true", nullValue="", escape='"')
        writer.save(folder)
    return folders


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and an explicit schema: one pass, and codes keep their leading zeros.

    Empty text and null are the same in the file; both are read as null.
    """
    return spark.read.schema(schema).options(
        header="true", nullValue="", escape='"', mode="FAILFAST", enforceSchema="false").csv(path)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(bytes) of all files of a table, from the file system's listing; no file is opened."""
    return spark.createDataFrame([(folder_bytes(spark, path),)], "bytes bigint")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Make the table at ``path`` known as ``schema.table`` in the session catalog.

    An entry that points elsewhere, or has other columns, is replaced; partitions added since are picked up. With a
    schema nothing is inferred from the files.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if spark.catalog.tableExists(name) and (
            _location(spark, name) != path.rstrip("/").removeprefix("file:")
            or schema is not None and set(spark.table(name).columns) != set(schema.names)):
        spark.sql(f"DROP TABLE {name}")  # external: only the entry goes, the files stay
    declared = schema is not None and fmt not in SELF_DESCRIBED
    columns = f"({schema.toDDL()})" if declared else ""
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if declared and partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING {fmt} {partitions} LOCATION '{path}'")
    if fmt not in SELF_DESCRIBED and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].removeprefix("file:").rstrip("/") if rows else ""
