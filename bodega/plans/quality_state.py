"""Column report and data rules from counts kept per bucket: a report reads no table again.

A bucket of incremental silver is written whole, as a new version. Its counts are taken once, when that version is new,
and stored; whatever a report needs is a sum over the counts of the versions in force. Equal rows share a key and so
a bucket, so even the number of repeated rows is a sum over buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.functions.measures import percent
from bodega.operators.conform import ACCEPTED, REASON, accepted
from bodega.operators.quality import Rule, duplicate_rows
from bodega.plans.incremental import IncrementalSilver, current_buckets, read_buckets, read_ledger
from bodega.schemas import NULL_REASON
from bodega.session import folder_bytes, materialize, path_exists, sized_shuffles
from bodega.sources.tables import read_table, write_table

STATE_SCHEMA = "key_bucket int, version bigint, kind string, name string, value bigint"
_LAYOUT = ("key_bucket", "version", REASON)


@dataclass(frozen=True)
class QualityState:
    """Where the counts live. ``rules`` and ``duplicates`` (the name of the rule that no row occurs twice) are
    checked on accepted rows; a rule added later counts from the next version of a bucket on, so it needs a new ``root``."""

    root: str
    silver: IncrementalSilver
    rules: dict[str, Sequence[Rule]] = field(default_factory=dict)
    duplicates: dict[str, str] = field(default_factory=dict)
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root}/{table.lower()}"


def read_state(spark: SparkSession, state: QualityState, table: str) -> DataFrame:
    """Counts of the versions in force."""
    empty = spark.createDataFrame([], STATE_SCHEMA)
    if not path_exists(spark, state.path(table)):
        return empty
    current = spark.createDataFrame(list(current_buckets(spark, state.silver, table).items()), "key_bucket int, version bigint")
    return read_table(spark, state.path(table), state.fmt, empty.schema).join(current, ["key_bucket", "version"], "left_semi")


def measure_new(spark: SparkSession, state: QualityState, table: str) -> dict[int, int]:
    """Count the buckets whose version in force has no counts yet; returns these versions.

    One aggregate over them, and one more where repeated rows are looked for. The counts are
    written as one partition per version of a bucket, so counting twice leaves one set of counts.
    """
    known = {tuple(r) for r in read_state(spark, state, table).select("key_bucket", "version").distinct().collect()}
    new = {b: v for b, v in current_buckets(spark, state.silver, table).items() if (b, v) not in known}
    if not new:
        return {}
    rows = read_buckets(spark, state.silver, table, new)
    ok = F.col(REASON) == ACCEPTED
    rules = state.rules.get(table, ())
    columns = [c for c in rows.columns if c not in _LAYOUT]
    counted = {("rows", "accepted"): ok, ("rows", "null_rejected"): F.col(REASON) == NULL_REASON,
               ("rows", "fk_rejected"): ~F.col(REASON).isin(ACCEPTED, NULL_REASON)}
    counted |= {("nulls", c): ok & F.col(f"`{c}`").isNull() for c in columns}
    counted |= {("rule", r.name): ok & r.violation for r in rules}
    wide = rows.groupBy("key_bucket", "version").agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(counted.values())])
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(f"c{i}").alias("value"))
                        for i, (kind, name) in enumerate(counted)])
    found = wide.select("key_bucket", "version", F.explode(entries).alias("e")).select("key_bucket", "version", "e.*")
    if table in state.duplicates:
        surplus = _copies(accepted(rows)).groupBy("key_bucket", "version").agg(F.sum(F.col("copies") - 1).alias("value"))
        found = found.unionByName(surplus.select("key_bucket", "version", F.lit("rule").alias("kind"),
                                                 F.lit(state.duplicates[table]).alias("name"), "value"))
    folders = [f"{state.silver.path(table)}/key_bucket={b}/version={v}" for b, v in new.items()]
    with sized_shuffles(spark, sum(folder_bytes(spark, f) for f in folders)):
        write_table(found.coalesce(1), state.path(table), state.fmt, partition_by=["key_bucket", "version"], dynamic=True)
    return new


def _copies(rows: DataFrame) -> DataFrame:
    """``duplicate_rows``, for which only hashes are shuffled: rows whose hash comes twice are then compared in full."""
    code = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    twice = materialize(duplicate_rows(rows.select(code.alias("_hash"))).select("_hash"), "twice")
    return duplicate_rows(rows.join(twice, code == F.col("_hash"), "left_semi"))


def _totals(spark: SparkSession, state: QualityState, table: str) -> DataFrame:
    return read_state(spark, state, table).groupBy("kind", "name").agg(F.sum("value").alias("value"))


def merged_report(spark: SparkSession, state: QualityState, table: str, batch_id: str) -> DataFrame:
    """The column report of all rows in force, in the form of ``quality_report``.

    Rows read are those of the ledger: all that bronze committed, before copies and older rows were left out.
    """
    totals = _totals(spark, state, table)
    def of(name: str) -> Column:
        return F.coalesce(F.max(F.when((F.col("kind") == "rows") & (F.col("name") == name), F.col("value"))), F.lit(0))
    facts = totals.agg(of("accepted").alias("_total"), of("null_rejected").alias("rejected_records"), of("fk_rejected").alias("fk_rejected"))
    read = read_ledger(spark, state.silver).where(F.col("table_name") == table).agg(F.sum("read_rows").alias("_read"))
    nulls = totals.where("kind = 'nulls'").select(F.col("name").alias("column_name"), F.col("value").alias("null_count"))
    return nulls.join(facts.join(read, F.lit(True)), F.lit(True)).select(
        F.lit(table).alias("table_name"), "column_name", "null_count",
        percent(F.col("null_count"), F.col("_total")).alias("null_percentage"), "rejected_records", "fk_rejected",
        percent(F.col("_total"), F.col("_read")).alias("conform_percentage"), F.lit(batch_id).alias("batch_id"))


def merged_rules(spark: SparkSession, state: QualityState, table: str) -> DataFrame:
    """(test_name, violations) of the table's rules over all accepted rows in force."""
    names = [r.name for r in state.rules.get(table, ())] + ([state.duplicates[table]] if table in state.duplicates else [])
    named = spark.createDataFrame([(n,) for n in names], "test_name string")
    broken = _totals(spark, state, table).where("kind = 'rule'").select(F.col("name").alias("test_name"), "value")
    return named.join(broken, "test_name", "left").select("test_name", F.coalesce("value", F.lit(0)).alias("violations"))
