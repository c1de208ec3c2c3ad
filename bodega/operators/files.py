"""The files of a stored table: compaction of small ones, and a zone map that picks files before a scan."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.session import path_exists, remove_path
from bodega.sources.tables import SELF_DESCRIBED, read_table

TARGET_BYTES = 256 << 20  # of a compacted file
SMALL = 0.25              # share of the target below which a file is small
FULL = 0.9                # share of the target that a group of small files fills at most
STAGING = "_compaction"   # readers pass over names with an underscore in front


def listed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(path, bytes, folder) of all data files of a table. Listed in parallel; no file is opened."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=f"*.{fmt}").load(path)
    at = F.col("_metadata.file_path")
    return files.select(at.alias("path"), F.col("_metadata.file_size").alias("bytes"),
                        F.regexp_replace(at, "/[^/]*$", "").alias("folder"))


def _place(path: str) -> str:
    """The file system's name of a path that Spark reports, in which some characters are escaped."""
    return unquote(path)


# ---------------------------------------------------------------- compaction

def plan_groups(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """(path, folder, bytes, group) of the small files that are to become one file per folder and group.

    Small files of a folder are laid end to end and cut at equal lengths, so a group is at most ``FULL`` of the
    target, and at least large enough not to be small itself. A file that would be alone stays as it is.
    """
    room = int((FULL - SMALL) * target)
    order = Window.partitionBy("folder").orderBy("bytes", "path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(order), F.lit(0))
    grouped = files.where(F.col("bytes") < int(SMALL * target)).withColumn(
        "group", F.floor(before / F.lit(max(room, 1))).cast("long"))
    members = F.count("*").over(Window.partitionBy("folder", "group"))
    return grouped.withColumn("_members", members).where("_members > 1").drop("_members")


@dataclass(frozen=True)
class Compaction:
    """What a call did: small files that are gone, files written in their stead."""

    rewritten: int
    written: int


def compact(spark: SparkSession, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = (),
            fmt: str = "parquet", target: int = TARGET_BYTES) -> Compaction:
    """Rewrite a table's small files into files of up to ``target`` bytes; larger ones are not touched.

    Only the small files are read: a filter on file size prunes the listing. The new files are
    written aside, then the list of files they replace, and only then is anything moved or deleted; a call that
    died after that is completed by the next one, one that died before leaves the table as it was. While files are
    moved a reader may see rows twice, so compact when a table is not read, or a version nobody reads yet.
    """
    if fmt in SELF_DESCRIBED:
        raise ValueError(f"{fmt} tables are compacted by their own format")
    finish_compactions(spark, path, fmt)
    aside = f"{path}/{STAGING}/{uuid.uuid4().hex}"
    planned = plan_groups(listed(spark, path, fmt), target)
    planned.write.parquet(f"{aside}/plan")
    plan = spark.read.schema(planned.schema).parquet(f"{aside}/plan")
    small = plan.agg(F.count("*").alias("n"), F.count_distinct("folder", "group").alias("groups")).first()
    if not small["n"]:
        remove_path(spark, f"{path}/{STAGING}")
        return Compaction(0, 0)
    rows = read_table(spark, path, fmt, schema)
    columns = rows.columns
    place = [F.col("_metadata.row_index").alias("_row")] if fmt == "parquet" else []
    rows = rows.where(F.col("_metadata.file_size") < int(SMALL * target)).select(
        "*", F.col("_metadata.file_path").alias("_file"), *place)
    # a task of its own for each group, however they would hash: numbered over the list of groups
    numbered = plan.select("folder", "group").distinct().withColumn(
        "_task", F.row_number().over(Window.orderBy("folder", "group")) - 1)
    groups = plan.join(numbered, ["folder", "group"]).select(F.col("path").alias("_file"), F.col("group").alias("_group"), "_task")
    merged = rows.join(groups, "_file").repartitionById(small["groups"], "_task").sortWithinPartitions(
        *partition_by, "_group", "_file", *(["_row"] if place else []))
    merged.select(*columns, "_group").write.format(fmt).partitionBy(*partition_by, "_group").save(f"{aside}/rows")
    plan.select("path").write.parquet(f"{aside}/replaced")
    finish_compactions(spark, path, fmt)
    return Compaction(small["n"], small["groups"])


def finish_compactions(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Complete compactions whose new files are all written; discard the others.

    Every step can be repeated: a file that is already in its place, or already gone, is passed over.
    """
    root = f"{path}/{STAGING}"
    if not path_exists(spark, root):
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(at):
        aside = status.getPath().toString()
        if path_exists(spark, f"{aside}/replaced/_SUCCESS"):
            name = aside.rsplit("/", 1)[-1]
            for row in listed(spark, f"{aside}/rows", fmt).select("path").toLocalIterator():
                source = _place(row["path"])
                folder, group, file = source[source.index(f"{name}/rows") + len(f"{name}/rows"):].rsplit("/", 2)
                target = hadoop.Path(f"{path}{folder}/compact-{name}-{group.split('=')[1]}-{file}")
                if not fs.exists(target) and not fs.rename(hadoop.Path(source), target):
                    raise OSError(f"cannot move {source} to {target}")
            for row in spark.read.schema("path string").parquet(f"{aside}/replaced").toLocalIterator():
                fs.delete(hadoop.Path(_place(row["path"])), False)
        fs.delete(status.getPath(), True)
    fs.delete(at, True)
    spark.catalog.refreshByPath(path)


# ---------------------------------------------------------------- zone map

def _zones_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    measures = [m for c in columns for m in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    return rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count("*").alias("rows"), *measures)


def zone_schema(table: T.StructType, columns: Sequence[str]) -> T.StructType:
    parts = [T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("rows", T.LongType())]
    for c in columns:
        parts += [T.StructField(f"{c}_min", table[c].dataType), T.StructField(f"{c}_max", table[c].dataType),
                  T.StructField(f"{c}_nulls", T.LongType())]
    return T.StructType(parts)


def read_files(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of some files of a table; partition columns come from the folders below ``path``."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load([_place(f) for f in files])


@dataclass(frozen=True)
class ZoneMap:
    """Least and greatest value per file and column, stored beside a table.

    Readers compare the ranges they ask for with it and open only files that can hold such rows. Files that the
    map does not know yet are always read, and entries of files that are gone are passed over, so an old map
    costs time but never rows. Files are never changed in place (a name written anew has another size or is unknown).
    """

    path: str
    zones: str
    schema: T.StructType
    columns: tuple[str, ...]
    fmt: str = "parquet"

    def read(self, spark: SparkSession) -> DataFrame:
        schema = zone_schema(self.schema, self.columns)
        if not path_exists(spark, self.zones):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.zones).dropDuplicates(["path", "bytes"])

    def refresh(self, spark: SparkSession) -> int:
        """Add the files that the map lacks; only those are scanned, and of them only the map's columns."""
        missing = listed(spark, self.path, self.fmt).join(self.read(spark), ["path", "bytes"], "left_anti")
        new = [r["path"] for r in missing.select("path").toLocalIterator()]
        if new:
            zones = _zones_of(read_files(spark, self.path, new, self.schema, self.fmt), self.columns)
            zones.select(zone_schema(self.schema, self.columns).names).coalesce(
                max(1, len(new) // 10_000)).write.mode("append").parquet(self.zones)
        return len(new)

    def files(self, spark: SparkSession, ranges: Mapping[str, tuple]) -> DataFrame:
        """(path) of files that may hold rows with each column of ``ranges`` between its low and high (None: open)."""
        known = self.read(spark).withColumn("_known", F.lit(True))
        hit: Column = F.lit(True)
        for column, (low, high) in ranges.items():
            if low is not None:
                hit = hit & (F.col(f"{column}_max") >= F.lit(low))
            if high is not None:
                hit = hit & (F.col(f"{column}_min") <= F.lit(high))
            hit = hit & F.col(f"{column}_min").isNotNull()
        there = listed(spark, self.path, self.fmt).join(known, ["path", "bytes"], "left")
        return there.where(F.col("_known").isNull() | hit).select("path")

    def scan(self, spark: SparkSession, ranges: Mapping[str, tuple]) -> DataFrame:
        """The rows within all ``ranges``, from the files that can hold some.

        The driver holds the names of these files, as it does for any scan.
        """
        unknown = set(ranges) - set(self.columns)
        if unknown:
            raise ValueError(f"no zones of {', '.join(sorted(unknown))}")
        picked = [r["path"] for r in self.files(spark, ranges).toLocalIterator()]
        rows = read_files(spark, self.path, picked, self.schema, self.fmt)
        for column, (low, high) in ranges.items():
            if low is not None:
                rows = rows.where(F.col(column) >= F.lit(low))
            if high is not None:
                rows = rows.where(F.col(column) <= F.lit(high))
            if low is None and high is None:
                rows = rows.where(F.col(column).isNotNull())
        return rows
