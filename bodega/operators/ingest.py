"""Incremental selection, audit columns and watermarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform_types(df: DataFrame, schema: T.StructType, dated: str | None = None) -> DataFrame:
    """The columns of ``schema`` in its types, whatever types the source gives them in.

    Dates kept as text and money kept as floats are converted. Columns the source lacks are null.
    ``_misfit`` names the columns whose value does not fit its type (null where all fit); those
    columns are null, and ``_raw`` holds such a row as it came, as JSON. ``_digest`` tells
    rows apart that do not fit or have nothing in the column ``dated``; other rows need none.
    """
    given = {c.lower(): c for c in df.columns}
    cast, misfits, known = [], [], F.lit(True)
    for field in schema:
        name = given.get(field.name.lower())
        if name is None:
            cast.append(F.lit(None).cast(field.dataType).alias(field.name))
            known = F.lit(False) if field.name == dated else known
            continue
        raw = F.col(f"`{name}`")
        value = raw if df.schema[name].dataType == field.dataType else raw.try_cast(field.dataType)
        cast.append(value.alias(field.name))
        known = value.isNotNull() if field.name == dated else known
        if df.schema[name].dataType != field.dataType:
            misfits.append(F.when(raw.isNotNull() & value.isNull(), F.lit(field.name)))
    bad = F.concat_ws(",", *misfits) if misfits else F.lit("")
    return df.select(*cast, F.nullif(bad, F.lit("")).alias("_misfit"),
                     F.when(bad != "", F.to_json(F.struct(*df.columns))).alias("_raw"), F.when((bad != "") | ~known, row_digest(df)).alias("_digest"))


def rows_after(df: DataFrame, column: str, last: str | None, inclusive: bool = False) -> DataFrame:
    """Rows with ``column`` above the last watermark; everything when there is none.

    The watermark is cast to the column's type, so the comparison is typed and reaches the
    source as a pushed filter. ``inclusive`` reads rows equal to the watermark again; the
    caller then deduplicates by key.
    """
    if last is None:
        return df
    bound = F.lit(last).cast(df.schema[column].dataType)
    return df.where(F.col(column) >= bound if inclusive else F.col(column) > bound)


def add_audit_columns(df: DataFrame, source_system: str, batch_id: str, run_ts: dt.datetime) -> DataFrame:
    """Ingestion time, source, batch and the date parts used as partitions."""
    stamp = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)
    return df.withColumns({
        "ingestion_timestamp": F.lit(stamp),
        "source_system": F.lit(source_system),
        "batch_id": F.lit(batch_id),
        "year": F.lit(f"{run_ts:%Y}"),
        "month": F.lit(f"{run_ts:%m}"),
        "day": F.lit(f"{run_ts:%d}"),
    })


def batch_watermark(batch: DataFrame, column: str, cap: str | None = None) -> DataFrame:
    """(record_count, last_watermark) of a batch; ``cap`` limits dates lying in the future.

    Rows beyond the cap are read again by later runs; they need the per-key dedup of silver.
    """
    latest = F.max(column)
    if cap is not None:
        latest = F.least(latest, F.lit(cap).cast(batch.schema[column].dataType))
    return batch.agg(F.count("*").alias("record_count"), latest.cast(T.StringType()).alias("last_watermark"))


def latest_watermarks(store: DataFrame) -> DataFrame:
    """The watermark in force per table: the one of its newest version."""
    return store.where(F.col("last_watermark").isNotNull()).groupBy("table_name").agg(
        F.max_by("last_watermark", "version").alias("last_watermark"))


def advance_watermark(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store after a batch: the table's old row is replaced by the new one.

    With an append-only store that is a union; ``latest_watermarks`` lets the newest version win.
    """
    return latest_watermarks(store.unionByName(new))


def committed_rows(bronze: DataFrame, store: DataFrame, table: str) -> DataFrame:
    """Rows of batches that reached the watermark store.

    A run that dies between data and watermark leaves rows of an unknown batch behind; its
    successor reads them again. The store has one short row per run and table, so Spark broadcasts it, and where batches
    are stored as partitions the join prunes them before the scan; the plan does not grow with the runs.
    """
    done = store.where(F.col("table_name") == table).select("batch_id").distinct()
    return bronze.join(done, "batch_id", "left_semi").select(*bronze.columns)


def row_digest(df: DataFrame) -> Column:
    """SHA-256 over all columns of a row as it came; equal rows have equal digests whatever the run."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
