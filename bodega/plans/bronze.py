"""Bronze run: every source table, incrementally, each failing on its own."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bodega.operators.files import compact
from bodega.operators.ingest import add_audit_columns, committed_rows, conform_types, latest_watermarks, rows_after
from bodega.plans.side_by_side import AT_ONCE, run_steps
from bodega.schemas import (
    LOG_SCHEMA,
    STORED_PARTITIONS,
    TABLES,
    WATERMARK_SCHEMA,
    bronze_schema,
)
from bodega.session import folder_bytes, folder_files, path_exists
from bodega.sources.origins import Source, load_after
from bodega.sources.tables import append_partitioned, read_table

NO_NEW_ROWS = "Sin nuevos registros"
MISFIT_REASON = "VALUE_DOES_NOT_FIT_TYPE"
MISFIT_SCHEMA = "row string, row_digest string, error_columns string, error_reason string, batch_id string"
UNDATED_SCHEMA = "row_digest string, batch_id string"
STORE_FILES = 200  # small files that the watermark store may have before they are made one
_store = threading.Lock()  # two writes into one folder would clear away each other's unfinished files


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class BronzeRun:
    """Where a bronze run writes, and its identity."""

    root: str
    source_system: str = "RETAIL_SOURCE"
    fmt: str = "parquet"
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: dt.datetime = field(default_factory=_utc_now)
    max_date: str | None = None
    inclusive: bool = False
    at_once: int = AT_ONCE  # tables that are read at the same time

    def table_path(self, table: str) -> str:
        return f"{self.root}/{table.lower()}"

    def misfit_path(self, table: str) -> str:
        """Rows with a value that does not fit the declared type, as they came."""
        return f"{self.root}/misfits/{table.lower()}"

    def undated_path(self, table: str) -> str:
        """Digests of stored rows without a value in the incremental column: no watermark tells them apart."""
        return f"{self.root}/undated/{table.lower()}"

    @property
    def watermark_path(self) -> str:
        return f"{self.root}/watermarks"

    @property
    def log_path(self) -> str:
        return f"{self.root}/logs"


@dataclass(frozen=True)
class LogRow:
    table_name: str
    record_count: int
    file_size_bytes: int
    duration_seconds: float
    batch_id: str
    status: str
    error_message: str | None


def read_watermarks(spark: SparkSession, run: BronzeRun) -> DataFrame:
    """The append-only store; created empty on the first run."""
    if not path_exists(spark, run.watermark_path):
        spark.createDataFrame([], WATERMARK_SCHEMA).write.format(run.fmt).mode("append").save(run.watermark_path)
    return read_table(spark, run.watermark_path, run.fmt, WATERMARK_SCHEMA)


def _append_row(spark: SparkSession, row: tuple, run: BronzeRun) -> None:
    with _store:
        spark.createDataFrame([row], WATERMARK_SCHEMA).coalesce(1).write.format(run.fmt).mode("append").save(
            run.watermark_path)


def read_bronze(spark: SparkSession, run: BronzeRun, table: str) -> DataFrame:
    return read_table(spark, run.table_path(table), run.fmt, bronze_schema(table))


def read_misfits(spark: SparkSession, run: BronzeRun, table: str) -> DataFrame:
    """Rows kept apart so far; none where no run found any."""
    if not path_exists(spark, run.misfit_path(table)):
        return spark.createDataFrame([], MISFIT_SCHEMA)
    return read_table(spark, run.misfit_path(table), run.fmt, spark.createDataFrame([], MISFIT_SCHEMA).schema)


def _seen_undated(spark: SparkSession, run: BronzeRun, table: str) -> DataFrame:
    """Digests of rows without a readable date that a committed batch, or the misfits, hold already."""
    kept = read_misfits(spark, run, table).select("row_digest")
    if path_exists(spark, run.undated_path(table)):
        stored = read_table(spark, run.undated_path(table), run.fmt, spark.createDataFrame([], UNDATED_SCHEMA).schema)
        kept = kept.unionByName(committed_rows(stored, read_watermarks(spark, run), table).select("row_digest"))
    return kept.withColumnRenamed("row_digest", "_digest").distinct()


def ingest_table(spark: SparkSession, source: Source, table: str, run: BronzeRun,
                 last: str | None) -> tuple[int, int]:
    """Append the new rows of one table; returns (rows, stored bytes).

    Values are converted to the declared types; rows in which one does not fit are kept apart, with
    the columns named, in ``misfit_path``.

    Rows without a date, or with one that cannot be read, are above no watermark: every run sees them, and
    takes those whose digest no earlier one stored. Equal rows share a digest, so copies that come later are not new.

    The source is read once (again if rows do not fit or have no date): count and watermark are observed on the write
    itself. Observing happens in the stage that writes, where a retried task is counted once. Data first, then the
    digests, then the watermark row, which commits the batch.
    """
    spec = TABLES[table]
    typed = conform_types(load_after(spark, source, table, spec.incremental, last, run.inclusive), spec.schema,
                          spec.incremental)
    dated = F.col(spec.incremental).isNotNull() if spec.incremental else F.lit(True)
    if spec.incremental and last is not None:
        undated = typed.where(~dated).join(_seen_undated(spark, run, table), "_digest", "left_anti")
        typed = rows_after(typed, spec.incremental, last, run.inclusive).unionByName(undated)
    seen = Observation(f"{table}-{run.batch_id}")
    fits = F.col("_misfit").isNull()
    measures = [F.count_if(fits).alias("n"), F.count_if(~fits).alias("unfit"), F.count_if(fits & ~dated).alias("undated")]
    if spec.incremental:
        latest = F.max(F.when(fits, F.col(spec.incremental)))
        if run.max_date is not None:
            latest = F.least(latest, F.lit(run.max_date).cast(typed.schema[spec.incremental].dataType))
        measures.append(latest.cast("string").alias("last"))
    rows = typed.observe(seen, *measures).where(fits).drop("_misfit", "_raw", "_digest")
    audited = add_audit_columns(rows, run.source_system, run.batch_id, run.run_ts)
    append_partitioned(audited, run.table_path(table), STORED_PARTITIONS, run.fmt)
    if seen.get.get("unfit", 0):
        kept = typed.where(~fits).select(
            F.col("_raw").alias("row"), F.col("_digest").alias("row_digest"), F.col("_misfit").alias("error_columns"),
            F.lit(MISFIT_REASON).alias("error_reason"), F.lit(run.batch_id).alias("batch_id"))
        kept.write.format(run.fmt).mode("append").save(run.misfit_path(table))
    if seen.get.get("undated", 0):
        stored = typed.where(fits & ~dated).select(F.col("_digest").alias("row_digest"), F.lit(run.batch_id).alias("batch_id"))
        stored.distinct().write.format(run.fmt).mode("append").save(run.undated_path(table))
    count = seen.get.get("n", 0)
    if count == 0:
        return 0, 0
    _append_row(spark, (table, seen.get.get("last"), run.batch_id, run.run_ts), run)
    return count, folder_bytes(spark, run.table_path(table))


def compact_store(spark: SparkSession, run: BronzeRun, most: int = STORE_FILES) -> None:
    """Make the watermark store's files one when there are many: every table of every run adds one."""
    if folder_files(spark, run.watermark_path) > most:
        compact(spark, run.watermark_path, WATERMARK_SCHEMA, fmt=run.fmt)


def commit_batch(spark: SparkSession, run: BronzeRun, table: str) -> int:
    """Commit rows that a stream appended under the run's batch id; returns their number.

    Silver reads only committed batches. The watermark lets later incremental runs go on from there.
    """
    spec = TABLES[table]
    rows = read_bronze(spark, run, table).where(F.col("batch_id") == run.batch_id)
    measures = [F.count(F.lit(1)).alias("n")]
    if spec.incremental:
        measures.append(F.max(spec.incremental).cast("string").alias("last"))
    found = rows.agg(*measures).first().asDict()
    if found["n"]:
        _append_row(spark, (table, found.get("last"), run.batch_id, run.run_ts), run)
    return found["n"]


def ingest_all(spark: SparkSession, source: Source, run: BronzeRun,
               tables: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Ingest all tables, some at the same time; one failing table is logged and does not stop the rest.

    Returns the log of this run, in the order of ``tables``, which is also appended to the log table.
    """
    read_watermarks(spark, run)
    compact_store(spark, run)
    marks = {r["table_name"]: r["last_watermark"] for r in latest_watermarks(read_watermarks(spark, run)).collect()}

    def step(table: str):
        return lambda: ingest_table(spark, source, table, run, marks.get(table))

    log = []
    for table, done in run_steps(spark, {t: step(t) for t in tables}, at_once=run.at_once).items():
        rows, size = done.value or (0, 0)
        status, message = ("SUCCESS", None if rows else NO_NEW_ROWS) if done.ok else ("FAILED", str(done.error))
        log.append(LogRow(table, rows, size, round(done.seconds, 2), run.batch_id, status, message))
    return write_ingest_log(spark, log, run)


def write_ingest_log(spark: SparkSession, log: Sequence[LogRow], run: BronzeRun) -> DataFrame:
    frame = spark.createDataFrame([tuple(vars(row).values()) for row in log], LOG_SCHEMA).coalesce(1)
    frame.write.format(run.fmt).mode("append").save(run.log_path)
    return frame
