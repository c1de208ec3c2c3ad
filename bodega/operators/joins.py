"""Equi-joins that stay balanced when single keys hold a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.session import folder_bytes, remove_path, scratch_path
from bodega.sources.tables import read_table

# Rows of one key that one task may join.
TASK_ROWS = 4_000_000
# Tasks a hot key is spread over where its rows have not been counted.
UNCOUNTED_SALTS = 64


def heavy_keys(df: DataFrame, key: str, share: float = 0.01, limit: int = 100) -> dict:
    """Non-null keys holding at least ``share`` of the rows, at most ``limit`` of them, with their rows.

    One pass over one column; the sketch state and the result have a fixed size. The counts (never
    too low) only steer the salting of ``skew_join``, never its result.
    """
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(key).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {limit}, {limit * 100})").alias("top"),
    ).first()
    return {item["item"]: item["count"] for item in row["top"] or [] if item["count"] >= share * row["n"]}


def absent_keys(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, most_bytes: int) -> DataFrame | None:
    """(_absent): the non-null keys of ``df`` that ``lookup`` lacks, stored; None where they take more than ``most_bytes``.

    Only keys are shuffled, each once per task however often it occurs, so a hot key needs no salt. Where they are
    few, as they are behind a foreign key, rows are told from them by a join that moves no row of ``df``.
    """
    spark = df.sparkSession
    keys = df.select(F.col(key).alias("_absent")).where(F.col("_absent").isNotNull()).distinct()
    known = lookup.select(F.col(lookup_key).alias("_key"))
    path = scratch_path(spark, "absent")
    found = keys.join(known, F.col("_absent") == F.col("_key"), "left_anti")
    found.write.parquet(path)
    if folder_bytes(spark, path) > most_bytes:
        remove_path(spark, path)
        return None
    return read_table(spark, path, schema=found.schema)


def salts_of(rows: int) -> int:
    """Tasks that a key with so many rows is spread over."""
    return max(2, math.ceil(rows / TASK_ROWS))


def _counted(hot: Mapping | Iterable | None) -> dict:
    if isinstance(hot, Mapping):
        return dict(hot)
    return {key: UNCOUNTED_SALTS * TASK_ROWS for key in hot or ()}


def _row_hash(df: DataFrame) -> Column:
    # deterministic, unlike rand(): a retried task sends each row to the same place
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _salts(key: Column, hot: Mapping) -> Column:
    """Number of salts of a key; 1 for the keys that are not hot."""
    pairs = [item for k, rows in hot.items() for item in (F.lit(k), F.lit(salts_of(rows)))]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(1)) if pairs else F.lit(1)


def _repeated(salts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), salts - 1))


def _spread(df: DataFrame, salts: Column) -> Column:
    return F.pmod(_row_hash(df), salts.cast("long")).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot_left: Mapping | Iterable | None = None,
    hot_right: Mapping | Iterable | None = None,
) -> DataFrame:
    """Left outer equi-join, ``left.left_key = right.right_key``, salted for hot keys.

    Keys in ``hot_left`` (key: rows) are spread over as many tasks as their rows ask for, by a hash of
    the left row, and the matching right rows are repeated once per salt. Keys in ``hot_right`` are
    spread the other way round, if ``right`` has them at all. A key in both uses a grid of salts. Null
    keys match nothing and are spread freely. Keys given without rows are spread over ``UNCOUNTED_SALTS``
    tasks. Rows of other keys are untouched. The column names
    of the two sides must differ.
    """
    l_key, r_key = F.col(left_key), F.col(right_key)
    hot_left, hot_right = _counted(hot_left), _counted(hot_right)
    if hot_right:  # a left row of a hot key is repeated below, which needs a partner to tell copies by
        there = {r[0] for r in right.where(r_key.isin(list(hot_right))).select(r_key).distinct().collect()}
        hot_right = {k: n for k, n in hot_right.items() if k in there}

    # a: salt of left rows, repeated on the right; b: salt of right rows, repeated on the left
    right = right.withColumn("_ra", _repeated(_salts(r_key, hot_left)) if hot_left else F.lit(0))
    left = left.withColumn(
        "_la", F.when(l_key.isNull(), F.pmod(_row_hash(left), F.lit(1 << 20)).cast("int"))
        .otherwise(_spread(left, _salts(l_key, hot_left)) if hot_left else 0))
    right = right.withColumn("_rb", _spread(right, _salts(r_key, hot_right)) if hot_right else F.lit(0))
    left = left.withColumn("_lb", _repeated(_salts(l_key, hot_right)) if hot_right else F.lit(0))

    joined = left.join(
        right,
        (l_key == r_key) & (F.col("_la") == F.col("_ra")) & (F.col("_lb") == F.col("_rb")),
        "left",
    )
    if hot_right:
        # a repeated left row finds its partners under some salts only; a hot right key has
        # at least one partner, so the empty copies are artefacts of the repetition
        repeated = F.coalesce(l_key.isin(list(hot_right)), F.lit(False))
        joined = joined.where(~repeated | F.col("_rb").isNotNull())
    return joined.drop("_la", "_lb", "_ra", "_rb")
