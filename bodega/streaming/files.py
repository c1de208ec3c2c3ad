"""Incremental ingest of arriving files: Spark's own log replaces the watermark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from bodega.operators.ingest import add_audit_columns
from bodega.plans.bronze import BronzeRun, commit_batch, read_watermarks
from bodega.schemas import STORED_PARTITIONS, TABLES


def stream_to_bronze(spark: SparkSession, table: str, landing: str, target: str, log: str,
                     source_system: str, batch_id: str, run_ts: dt.datetime,
                     files_per_step: int = 1_000) -> StreamingQuery:
    """Append every landed file once, with audit columns, then stop.

    The file sink commits each step exactly once, so a restart neither loses nor repeats a file.
    """
    rows = (
        spark.readStream.schema(TABLES[table].schema)
        .option("maxFilesPerTrigger", files_per_step)
        .parquet(landing)
    )
    return (
        add_audit_columns(rows, source_system, batch_id, run_ts)
        .writeStream.format("parquet")
        .partitionBy(*STORED_PARTITIONS)
        .option("checkpointLocation", log)
        .trigger(availableNow=True)
        .start(target)
    )


def stream_batch(spark: SparkSession, run: BronzeRun, table: str, landing: str, log: str, files_per_step: int = 1_000) -> int:
    """Append all landed files to bronze as one batch of ``run`` and commit it, so that silver sees it.

    Returns the rows of the batch. Called again after a failure it goes on where it stopped; the batch
    is committed once its files are in.
    """
    query = stream_to_bronze(spark, table, landing, run.table_path(table), log, run.source_system, run.batch_id,
                             run.run_ts, files_per_step)
    query.awaitTermination()
    read_watermarks(spark, run)
    return commit_batch(spark, run, table)
