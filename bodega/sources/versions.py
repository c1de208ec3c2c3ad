"""Overwrites that never leave a gap: every overwrite is a new version, readers see the newest finished one.

A table's folder holds one folder per version. A version counts once Spark has written its ``_SUCCESS`` file, the last
step of a job, so a job that dies midway leaves the version before it in force, for readers by path and by name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.session import path_exists, remove_path
from bodega.sources.tables import SELF_DESCRIBED, read_table, write_table

_NAME = re.compile(r"version=(\d{10})")
KEPT = 2  # the version in force and the one before, which running readers may still hold


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all versions, finished or not, ascending. One listing of one folder."""
    if not path_exists(spark, root):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    statuses = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    found = (_NAME.fullmatch(s.getPath().getName()) for s in statuses)
    return sorted(int(m.group(1)) for m in found if m)


def version_path(root: str, number: int) -> str:
    return f"{root}/version={number:010d}"


def finished(spark: SparkSession, root: str) -> list[int]:
    return [n for n in _numbers(spark, root) if path_exists(spark, f"{version_path(root, n)}/_SUCCESS")]


def current_path(spark: SparkSession, root: str) -> str:
    """Folder of the version in force; the table's own folder where it has none (a table written in place)."""
    done = finished(spark, root)
    return version_path(root, done[-1]) if done else root


def has_version(spark: SparkSession, root: str) -> bool:
    return bool(finished(spark, root))


def read_current(spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, current_path(spark, root), fmt, schema)


def overwrite(df: DataFrame, root: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
              name: str | None = None, keep: int = KEPT) -> str:
    """Write ``df`` as the table's next version; returns its folder.

    ``df`` may read the table itself: nothing it reads is touched. With a ``name`` the catalog entry is
    pointed to the new version once that is finished, in one step. Older versions beyond ``keep`` are deleted
    last; so are the remains of jobs that died.
    """
    spark = df.sparkSession
    if fmt in SELF_DESCRIBED:
        raise ValueError(f"{fmt} tables have versions of their own")
    numbers = _numbers(spark, root)
    path = version_path(root, numbers[-1] + 1 if numbers else 1)
    write_table(df, path, fmt, mode="errorifexists", partition_by=partition_by)
    if name:
        point(spark, name, path, df.schema, fmt)
    done = finished(spark, root)
    for number in numbers:
        if number not in done or number in done[:-keep]:
            remove_path(spark, version_path(root, number))
    return path


def replace_partitions(df: DataFrame, root: str, partition_by: Sequence[str], schema: T.StructType, fmt: str = "parquet",
                       name: str | None = None) -> str:
    """The next version, in which the partitions that occur in ``df`` hold its rows and all others are as they were.

    The kept partitions are copied, since a version is one folder: use it where few are kept or the table is of
    moderate size, and ``write_table(dynamic=True)`` where a gap on failure can be borne.
    """
    spark = df.sparkSession
    if not has_version(spark, root):
        return overwrite(df.select(schema.names), root, fmt, partition_by, name)
    touched = df.select(*partition_by).distinct()
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"n.{c}")) for c in partition_by]
    kept = read_current(spark, root, fmt, schema).alias("t").join(touched.alias("n"), same, "left_anti")
    return overwrite(kept.select(schema.names).unionByName(df.select(schema.names)), root, fmt, partition_by, name)


def point(spark: SparkSession, name: str, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Make ``name`` a view of the table at ``path``. Replacing a view is one step of the catalog: whoever asks for the
    name gets the rows of the version before or of this one."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {fmt}.`{path}`")
