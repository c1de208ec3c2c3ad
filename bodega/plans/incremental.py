"""Silver kept up to date batch by batch: only new batches and the key ranges they touch are read and written.

The newest row of each key lies in one of a fixed number of buckets by the hash of its key. A run reads the batches that
bronze has committed since the last one, compares their keys with the buckets they fall in, and writes these buckets as new
versions; all others stay as they are. Stored rows are not shuffled: those that stay are written as they are read. One ledger row, written last, commits the run: it names the
batches it took in and the buckets it replaced, so a run that dies leaves the table as it was and is repeated
by the next one. Results equal those of a full run that keeps the newest row of each key.

Rejects lie beside accepted rows, told apart by ``error_reason``. When members come or go, the sales whose verdict that
changes are found by the changed keys alone and their buckets written again.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators.conform import ACCEPTED, REASON, accepted, dedup, rejected, standardise, tag_rows
from bodega.operators.joins import heavy_keys
from bodega.plans.bronze import BronzeRun, read_watermarks
from bodega.schemas import PARTITION_COLUMNS, TABLES, TableSpec, bronze_schema
from bodega.session import folder_bytes, materialize, open_writers, path_exists, remove_path, sized_shuffles
from bodega.sources.tables import read_table, write_table

BUCKETS = 64
PART_BYTES = 32 << 20  # stored bytes of new rows that one task merges
LEDGER_SCHEMA = ("table_name string, version bigint, parent_version bigint, buckets int, batches array<string>, "
                 "touched array<int>, read_rows bigint")
_LAYOUT = ("key_bucket", "version")


@dataclass(frozen=True)
class IncrementalSilver:
    """Where the state lives. ``buckets`` holds for a table from its first run on."""

    root: str
    bronze: BronzeRun
    fmt: str = "parquet"
    buckets: int = BUCKETS

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].silver}"

    def changes_path(self, table: str) -> str:
        """Keys that began or ceased to be accepted, by version."""
        return f"{self.root}/changes/{TABLES[table].silver}"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"


def read_ledger(spark: SparkSession, run: IncrementalSilver) -> DataFrame:
    if not path_exists(spark, run.ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return read_table(spark, run.ledger_path, run.fmt, spark.createDataFrame([], LEDGER_SCHEMA).schema)


@dataclass(frozen=True)
class _State:
    """A table's ledger summed up; its size is that of the buckets."""

    version: int
    parent_version: int | None
    buckets: int
    current: dict[int, int]  # bucket -> version in force


def _state(spark: SparkSession, run: IncrementalSilver, table: str) -> _State:
    ledger = read_ledger(spark, run).where(F.col("table_name") == table)
    last = ledger.agg(F.max("version"), F.max_by("parent_version", "version"), F.max_by("buckets", "version")).first()
    current = ledger.select("version", F.explode("touched").alias("bucket")).groupBy("bucket").agg(F.max("version").alias("v"))
    return _State(last[0] or 0, last[1], last[2] or run.buckets, {r["bucket"]: r["v"] for r in current.collect()})


def _new_batches(spark: SparkSession, run: IncrementalSilver, table: str) -> list[Row]:
    """(batch_id, version) of committed batches that no run has taken in: as many as bronze runs since the last."""
    taken = read_ledger(spark, run).where(F.col("table_name") == table).select(F.explode("batches").alias("batch_id"))
    committed = read_watermarks(spark, run.bronze).where(F.col("table_name") == table)
    return committed.join(taken, "batch_id", "left_anti").groupBy("batch_id").agg(F.max("version").alias("version")).collect()


def _batch_folder(run: IncrementalSilver, table: str, batch: Row) -> str:
    stamp: dt.datetime = batch["version"]
    parts = zip(PARTITION_COLUMNS, (f"{stamp:%Y}", f"{stamp:%m}", f"{stamp:%d}"))
    return "/".join([run.bronze.table_path(table), *(f"{k}={v}" for k, v in parts), f"batch_id={batch['batch_id']}"])


def _bucket(spec: TableSpec, columns: Sequence[str], buckets: int) -> Column:
    """Bucket of a row: by its key, or by the whole row where it has none."""
    key = F.col(spec.key)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return F.pmod(F.when(key.isNotNull(), F.xxhash64(key)).otherwise(whole), F.lit(buckets)).cast("int")


def _clean_schema(spark: SparkSession, table: str) -> T.StructType:
    return standardise(spark.createDataFrame([], bronze_schema(table)), TABLES[table]).schema


def _stored(spark: SparkSession, run: IncrementalSilver, table: str, current: dict[int, int]) -> DataFrame:
    """Rows of the buckets given, each in the version given, from their folders alone."""
    fields = [*_clean_schema(spark, table), T.StructField(REASON, T.StringType()),
              T.StructField("key_bucket", T.IntegerType()), T.StructField("version", T.LongType())]
    schema = T.StructType(fields)
    folders = [f"{run.path(table)}/key_bucket={b}/version={v}" for b, v in sorted(current.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(run.fmt).schema(schema).option("basePath", run.path(table))
    return reader.load(folders)


def read_current(spark: SparkSession, run: IncrementalSilver, table: str) -> DataFrame:
    """All rows in force with their ``error_reason``."""
    return _stored(spark, run, table, _state(spark, run, table).current).drop(*_LAYOUT)


def read_accepted(spark: SparkSession, run: IncrementalSilver, table: str) -> DataFrame:
    return accepted(read_current(spark, run, table))


def read_rejected(spark: SparkSession, run: IncrementalSilver, table: str) -> DataFrame:
    return rejected(read_current(spark, run, table))


def current_buckets(spark: SparkSession, run: IncrementalSilver, table: str) -> dict[int, int]:
    """The version in force of each bucket."""
    return _state(spark, run, table).current


def read_buckets(spark: SparkSession, run: IncrementalSilver, table: str, versions: dict[int, int]) -> DataFrame:
    """Rows of the buckets given in the versions given, with ``error_reason``, ``key_bucket`` and ``version``."""
    return _stored(spark, run, table, versions)


def changed_buckets(spark: SparkSession, run: IncrementalSilver, table: str,
                    since: int) -> tuple[int, dict[int, int] | None, dict[int, int]]:
    """The table's version now; of the buckets written after version ``since``, the versions in force then and now.

    None instead of the former where some of it has been pruned.
    """
    ledger = read_ledger(spark, run).where(F.col("table_name") == table).select("version", "touched")
    each = ledger.select("version", F.explode("touched").alias("bucket")).groupBy("bucket").agg(
        F.max("version").alias("now"), F.max(F.when(F.col("version") <= since, F.col("version"))).alias("then"))
    changed = each.where(F.col("now") > since).collect()
    then = {r["bucket"]: r["then"] for r in changed if r["then"] is not None}
    kept = all(path_exists(spark, f"{run.path(table)}/key_bucket={b}/version={v}") for b, v in then.items())
    last = ledger.agg(F.max("version")).first()[0] or 0
    return last, then if kept else None, {r["bucket"]: r["now"] for r in changed}


def batches_since(spark: SparkSession, run: IncrementalSilver, table: str, since: int) -> list[str] | None:
    """Batches taken in after version ``since``, if nothing else can have changed a row or its verdict; else None."""
    ledger = read_ledger(spark, run).where((F.col("table_name") == table) & (F.col("version") >= since))
    entries = ledger.select("version", "parent_version", "batches").collect()
    if since not in {e["version"] for e in entries} or len({e["parent_version"] for e in entries}) > 1:
        return None
    return [b for e in entries if e["version"] > since for b in e["batches"]]


def in_buckets(spark: SparkSession, run: IncrementalSilver, table: str, chosen: Sequence[int]) -> Column:
    """Whether a row with a key lies in one of some buckets."""
    buckets = _state(spark, run, table).buckets
    return F.pmod(F.xxhash64(TABLES[table].key), F.lit(buckets)).cast("int").isin(list(chosen))


def _changed_verdicts(spark: SparkSession, run: IncrementalSilver, table: str, state: _State) -> tuple[set[int], bool]:
    """Buckets holding rows whose parent came or went since the table's last run, and whether there is a parent."""
    key = TABLES[table].foreign_key
    parent = _state(spark, run, key.parent)
    if not parent.version:
        return set(), False
    if state.parent_version is None:  # nothing has been checked yet
        return set(state.current), True
    if parent.version == state.parent_version or not path_exists(spark, run.changes_path(key.parent)):
        return set(), True
    changes = read_table(spark, run.changes_path(key.parent), run.fmt).where(
        (F.col("version") > state.parent_version) & (F.col("version") <= parent.version))
    net = changes.groupBy("_key").agg(F.max_by("appeared", "version").alias("appeared"))
    rows = _stored(spark, run, table, state.current).select(F.col(key.key).alias("_key"), REASON, "key_bucket")
    moved = ((F.col(REASON) == key.reason) & F.col("appeared")) | ((F.col(REASON) == ACCEPTED) & ~F.col("appeared"))
    hit = rows.where(F.col(REASON).isin(ACCEPTED, key.reason)).join(net, "_key").where(moved)
    return {r[0] for r in hit.select("key_bucket").distinct().collect()}, True


def _write_changes(run: IncrementalSilver, table: str, old: DataFrame, new: DataFrame, version: int) -> None:
    """Keys whose rows became accepted or ceased to be; children of the table look them up."""
    key = TABLES[table].key
    before = accepted(old).select(F.col(key).alias("_key")).distinct()
    after = accepted(new).select(F.col(key).alias("_key")).distinct()
    came = after.join(before, "_key", "left_anti").withColumn("appeared", F.lit(True))
    went = before.join(after, "_key", "left_anti").withColumn("appeared", F.lit(False))
    changes = came.unionByName(went).withColumn("version", F.lit(version).cast("long"))
    write_table(changes, run.changes_path(table), run.fmt, partition_by=["version"], dynamic=True)


def _newest_of(old: DataFrame, raw: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows that no new row replaces, and new rows but for those of keys whose stored row is newer.

    Only keys and stamps meet; few keys are in both, so the rows themselves stay where they are. Two batches are never
    equally new: their ids differ.
    """
    stamp = F.struct("ingestion_timestamp", "batch_id")
    given = raw.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(stamp).alias("_new"))
    both = old.select(key, stamp.alias("_old")).join(given, key)
    both = materialize(both.select(key, (F.col("_new") >= F.col("_old")).alias("_came")), "contested")
    came = both.groupBy("_came").count().collect()
    gone, late = ({r["_came"] for r in came} & {c} for c in (True, False))
    kept = old.join(both.where("_came").select(key), key, "left_anti") if gone else old
    won = raw.join(both.where("NOT _came").select(key), key, "left_anti").select(raw.columns) if late else raw
    return kept, won


def _one_per_key(raw: DataFrame, key: str, buckets: int, size: int) -> DataFrame:
    """The newest row of each key (chosen before anything is hashed or filled, as in a full run), where its bucket is written.

    One shuffle brings the rows of a key together and into few buckets a task; a bucket is several tasks' work where
    it has more than ``PART_BYTES``. Keys with very many copies are combined before it.
    """
    if heavy_keys(raw, key):
        raw = dedup(raw, [key])
    parts = buckets * max(1, math.ceil(size / (PART_BYTES * buckets)))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
    part = F.pmod(F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(whole), F.lit(parts)).cast("int")
    return dedup(raw.withColumn("_part", part).repartitionById(parts, "_part"), [key, "_part"]).drop("_part")


def conform_new(spark: SparkSession, run: IncrementalSilver, table: str) -> Row:
    """Take in a table's new batches; returns the ledger row (of which nothing is stored when nothing was new)."""
    spec = TABLES[table]
    state = _state(spark, run, table)
    batches = _new_batches(spark, run, table)
    recheck, parent = set(), None
    if spec.foreign_key:
        recheck, checked = _changed_verdicts(spark, run, table, state)
        if checked:
            parent = read_accepted(spark, run, spec.foreign_key.parent)
    parent_version = _state(spark, run, spec.foreign_key.parent).version if parent is not None else None
    raw = spark.createDataFrame([], bronze_schema(table))
    if batches:
        reader = spark.read.format(run.bronze.fmt).schema(bronze_schema(table)).option("basePath", run.bronze.table_path(table))
        raw = reader.load([_batch_folder(run, table, b) for b in batches]).select(bronze_schema(table).names)
    columns = standardise(raw, spec).columns
    bucket = _bucket(spec, columns, state.buckets)
    hit = {r[0] for r in standardise(raw, spec).select(bucket).distinct().collect()} if batches else set()
    touched = sorted(hit | recheck)
    entry = (table, state.version + 1, parent_version, state.buckets, [b["batch_id"] for b in batches], touched,
             raw.count() if batches else 0)
    row = spark.createDataFrame([entry], LEDGER_SCHEMA)
    if not touched:
        if batches or parent_version != state.parent_version:
            row.coalesce(1).write.format(run.fmt).mode("append").save(run.ledger_path)
        return row.first()
    replaced = {b: v for b, v in state.current.items() if b in set(touched)}
    old = _stored(spark, run, table, replaced)
    kept, won = (old, raw) if not batches or not replaced else _newest_of(old, raw, spec.key)
    # stored rows lie in their buckets, so they are written again as they are read; a verdict changes with the parents alone
    kept = kept.select(*columns, REASON, "key_bucket")
    if recheck:
        kept = tag_rows(kept.drop(REASON), spec, parent).select(*columns, REASON, "key_bucket")
    merged = kept
    if batches:
        size = sum(folder_bytes(spark, _batch_folder(run, table, b)) for b in batches)
        tagged = tag_rows(standardise(_one_per_key(won, spec.key, state.buckets, size), spec), spec, parent)
        merged = kept.unionByName(tagged.withColumn("key_bucket", bucket))
    folders = [f"{run.path(table)}/key_bucket={b}/version={v}" for b, v in replaced.items()]
    folders += [_batch_folder(run, table, b) for b in batches]
    with sized_shuffles(spark, sum(folder_bytes(spark, f) for f in folders)), open_writers(spark, state.buckets):
        write_table(merged.withColumn("version", F.lit(entry[1]).cast("long")), run.path(table), run.fmt,
                    partition_by=_LAYOUT, dynamic=True)  # over what a dead run left
    if any(s.foreign_key and s.foreign_key.parent == table for s in TABLES.values()):
        _write_changes(run, table, old, _stored(spark, run, table, dict.fromkeys(touched, entry[1])), entry[1])
    row.coalesce(1).write.format(run.fmt).mode("append").save(run.ledger_path)
    return row.first()


def conform_all_new(spark: SparkSession, run: IncrementalSilver, tables: Sequence[str] = tuple(TABLES)) -> list[Row]:
    """All tables that bronze has, parents before children; one ledger row each."""
    return [conform_new(spark, run, t) for t in tables if path_exists(spark, run.bronze.table_path(t))]


def prune(spark: SparkSession, run: IncrementalSilver, table: str) -> int:
    """Delete versions of buckets that are no longer in force, those of runs that died included; returns their number."""
    if not path_exists(spark, run.path(table)):
        return 0
    state, gone = _state(spark, run, table), 0
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(run.path(table)).getFileSystem(spark._jsc.hadoopConfiguration())
    for bucket in fs.globStatus(hadoop.Path(f"{run.path(table)}/key_bucket=*/version=*")):
        path = bucket.getPath().toString()
        number, version = (int(part.rsplit("=", 1)[1]) for part in path.rsplit("/", 2)[1:])
        if state.current.get(number) != version:
            remove_path(spark, path)
            gone += 1
    return gone
