"""Silver run: conform every table once, accepted and rejected rows from the same pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bodega.operators.conform import ACCEPTED, REASON, accepted, conform, rejected
from bodega.operators.ingest import committed_rows
from bodega.operators.joins import absent_keys, heavy_keys
from bodega.operators.quality import quality_report, run_summary
from bodega.plans.bronze import BronzeRun, read_bronze, read_watermarks
from bodega.plans.side_by_side import AT_ONCE, run_steps
from bodega.schemas import TABLES, TableSpec, bronze_schema
from bodega.session import broadcast_limit, folder_bytes, path_exists, sized_shuffles
from bodega.sources.tables import read_table, register_table, write_table


SUMMARY_SCHEMA = ("table_name string, original_count bigint, dedup_count bigint, final_count bigint, rejected_count bigint, "
                  "fk_rejected_count bigint, duration_seconds double, batch_id string")


@dataclass(frozen=True)
class SilverRun:
    """Where silver lives. One folder per table, one subfolder per reject cause."""

    root: str
    bronze: BronzeRun
    fmt: str = "parquet"
    newest_per_key: bool | None = None  # None: where a table's rows are read again by later runs
    broadcast_bytes: int | None = None  # None: the session's threshold
    catalog: str | None = None
    at_once: int = AT_ONCE  # tables that are conformed at the same time

    def keeps_newest(self, spec: TableSpec) -> bool:
        """Whether only the newest row of each key stays.

        Later runs read rows again when a table is loaded in full every time, when rows equal to the
        watermark are included, and when a cap keeps dates in the future from moving it.
        """
        if self.newest_per_key is not None:
            return self.newest_per_key
        return not spec.incremental or self.bronze.inclusive or self.bronze.max_date is not None

    def tagged_path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].silver}"

    def path(self, table: str) -> str:
        """Folder of the accepted rows: the silver table proper."""
        return f"{self.tagged_path(table)}/{REASON}={ACCEPTED}"

    @property
    def quality_path(self) -> str:
        return f"{self.root}/quality_reports"

    @property
    def summary_path(self) -> str:
        return f"{self.root}/run_summaries"


def tagged_schema(spark: SparkSession, run: SilverRun, table: str) -> StructType:
    """Schema of a silver table with its reject cause; nothing is inferred from files, which an empty
    table does not have."""
    empty = spark.createDataFrame([], bronze_schema(table))
    spec = TABLES[table]
    parent = spark.createDataFrame([], bronze_schema(spec.foreign_key.parent)) if spec.foreign_key else None
    return conform(empty, spec, parent).schema


def read_silver(spark: SparkSession, run: SilverRun, table: str) -> DataFrame:
    """Accepted rows; none where a run accepted none."""
    return accepted(read_table(spark, run.tagged_path(table), run.fmt, tagged_schema(spark, run, table)))


def read_rejects(spark: SparkSession, run: SilverRun, table: str) -> DataFrame:
    return rejected(read_table(spark, run.tagged_path(table), run.fmt, tagged_schema(spark, run, table)))


def large(spark: SparkSession, path: str, limit: int | None = None) -> bool:
    """Whether a stored table is beyond the broadcast limit, by the size of its files."""
    return folder_bytes(spark, path) > (broadcast_limit(spark) if limit is None else limit)


def unmatched(spark: SparkSession, rows: DataFrame, key: str, lookup: DataFrame, lookup_path: str,
              limit: int | None = None) -> tuple[dict | None, DataFrame | None]:
    """How rows find whether ``lookup`` has their key: (hot keys, absent keys), either of them None.

    Both are None where the lookup is small enough to be broadcast. A larger one is asked once per key, and the keys it
    lacks are broadcast; only where those are too many are the rows themselves shuffled, with their hot keys salted.
    """
    if not large(spark, lookup_path, limit):
        return None, None
    absent = absent_keys(rows, key, lookup, key, broadcast_limit(spark) if limit is None else limit)
    return (heavy_keys(rows, key), None) if absent is None else (None, absent)


def conform_table(spark: SparkSession, run: SilverRun, table: str) -> tuple[DataFrame, DataFrame]:
    """Conform one table; returns its quality report and summary (both lazy).

    The tagged rows are written once, partitioned by reject cause: the reports read the stored
    table instead of running the deduplication again, and old rejects never outlive a run.
    """
    spec = TABLES[table]
    bronze = committed_rows(read_bronze(spark, run.bronze, table), read_watermarks(spark, run.bronze), table)
    parent, hot, absent = None, None, None
    if spec.foreign_key and path_exists(spark, run.tagged_path(spec.foreign_key.parent)):
        parent = read_silver(spark, run, spec.foreign_key.parent)
        hot, absent = unmatched(spark, bronze, spec.foreign_key.key, parent, run.tagged_path(spec.foreign_key.parent),
                                run.broadcast_bytes)
    keys = [spec.key] if run.keeps_newest(spec) else None
    tagged = conform(bronze, spec, parent, keys, hot, absent)
    with sized_shuffles(spark, folder_bytes(spark, run.bronze.table_path(table))):
        write_table(tagged, run.tagged_path(table), run.fmt, partition_by=[REASON])
    if run.catalog:
        if path_exists(spark, run.path(table)):
            register_table(spark, f"{run.catalog}.{spec.silver}", run.path(table), run.fmt,
                           tagged.drop(REASON).schema)
    stored = read_table(spark, run.tagged_path(table), run.fmt, tagged.schema)
    original = bronze.count()
    return (quality_report(stored, table, original, run.bronze.batch_id),
            run_summary(stored, table, original))


def conform_all(spark: SparkSession, run: SilverRun, tables: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Conform all tables that bronze has, some at the same time, children after their parents; appends the
    reports and the summaries (with seconds), returns the summaries.

    A table that bronze never loaded is passed over; its children keep all their rows, as there is
    no parent to check them against. The first failure is raised once all other tables have ended;
    children of a table that failed are left as they were.
    """
    tables = [t for t in tables if path_exists(spark, run.bronze.table_path(t))]
    needs = {t: [TABLES[t].foreign_key.parent] for t in tables if TABLES[t].foreign_key}

    def step(table: str):
        def conformed():
            report, summary = conform_table(spark, run, table)
            return report.schema, report.collect(), summary.first()  # a row per column of the table, and one
        return conformed

    # one number of shuffles for all: the setting is the session's, which the tables share
    with sized_shuffles(spark, max((folder_bytes(spark, run.bronze.table_path(t)) for t in tables), default=0)):
        done = run_steps(spark, {t: step(t) for t in tables}, needs, run.at_once)
    for outcome in done.values():
        if outcome.error:
            raise outcome.error
    if done:
        schema = next(iter(done.values())).value[0]
        reports = spark.createDataFrame([row for outcome in done.values() for row in outcome.value[1]], schema)
        reports.coalesce(1).write.format(run.fmt).mode("append").save(run.quality_path)
    summaries = [(*outcome.value[2], round(outcome.seconds, 2), run.bronze.batch_id) for outcome in done.values()]
    frame = spark.createDataFrame(summaries, SUMMARY_SCHEMA).coalesce(1)
    frame.write.format(run.fmt).mode("append").save(run.summary_path)
    return frame
