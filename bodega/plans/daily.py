"""Sales fact and marts kept up to date by date: a run works out which days (or months) changed and writes only those.

Incremental silver tells which key buckets were written since the last run. Comparing them with the versions they
replaced gives the sales that came, went or changed, and these give the periods. The fact's partitions of those periods are
read, corrected and replaced, without a shuffle of the rows that stay; silver has each id once, so marts count ids as they are. The marts of those periods are computed again from the fact. An
article that changes its category touches the periods in which it was sold, in the mart that shows categories.

A ledger row, written last, commits the run. A run that dies is repeated by the next one, with the same result:
taking out the changed ids before the present rows are put in can be done twice. Partitions are replaced one by one, so a
reader meets old and new periods side by side while a run commits. The periods of a run go through the driver: as
many as the calendar has, whatever the number of sales.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators import marts, model
from bodega.operators.conform import REASON, accepted
from bodega.plans.incremental import IncrementalSilver, batches_since, changed_buckets, in_buckets, read_accepted, read_buckets
from bodega.session import folder_bytes, materialize, open_writers, path_exists, remove_path, sized_shuffles
from bodega.sources import versions
from bodega.sources.tables import read_table, write_table

SALES, MEMBERS = "TRANS_VENTAS", "CRM_MIEMBROS"
FACT, BY_CATEGORY, KPIS = "fact_ventas", "agg_ventas_diarias", "kpi_ejecutivo_diario"
PERIOD = "periodo"  # partition column
FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
FEW = 10  # up to one in so many rows moved is looked up by id
OPEN_PERIODS = 24  # partitions that a task writes side by side before it sorts
CATEGORY_SCHEMA = "art_id bigint, id_categ_n1 string"
LEDGER_SCHEMA = "run bigint, sales_version bigint, periods array<string>, category_periods array<string>"


@dataclass(frozen=True)
class DailyGold:
    """Where the dated tables live, and whether a partition is a day or a month."""

    root: str
    silver: IncrementalSilver
    period: str = "day"
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    @property
    def category_path(self) -> str:
        """The categories that the mart was last computed with."""
        return f"{self.root}/categories"


def read_ledger(spark: SparkSession, run: DailyGold) -> DataFrame:
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    return read_table(spark, run.ledger_path, run.fmt, empty.schema) if path_exists(spark, run.ledger_path) else empty


def _dated(run: DailyGold, df: DataFrame) -> DataFrame:
    return df.withColumn(PERIOD, F.date_format("fec_venta", FORMATS[run.period]))


def _fact(run: DailyGold, sales: DataFrame, members: DataFrame) -> DataFrame:
    return _dated(run, model.fact_sales(sales.drop("key_bucket", "version", REASON), members))


def _schema(spark: SparkSession, run: DailyGold, table: str) -> T.StructType:
    sales, members = (accepted(read_buckets(spark, run.silver, t, {})) for t in (SALES, MEMBERS))
    fact = _fact(run, sales, members)
    if table == FACT:
        return fact.schema
    if table == KPIS:
        return _dated(run, marts.executive_kpis(fact)).schema
    return _dated(run, marts.daily_sales(fact, spark.createDataFrame([], CATEGORY_SCHEMA))).schema


def read_daily(spark: SparkSession, run: DailyGold, table: str) -> DataFrame:
    """A table with its partition column ``periodo``."""
    return read_table(spark, run.path(table), run.fmt, _schema(spark, run, table))


def _in(periods: Sequence[str | None]) -> Column:
    known = [p for p in periods if p is not None]
    return F.col(PERIOD).isin(known) | (F.col(PERIOD).isNull() if len(known) < len(periods) else F.lit(False))


def _periods(df: DataFrame) -> list[str | None]:
    return sorted((r[0] for r in df.select(PERIOD).distinct().collect()), key=lambda p: p or "")


def _replace(spark: SparkSession, run: DailyGold, table: str, rows: DataFrame, periods: list) -> None:
    """Let the partitions of ``periods`` hold ``rows``, which lie in these periods, and nothing else.

    Rows may be read from the partitions they replace: these go once all new files are written.
    """
    if not periods:
        return
    seen = Observation(f"{table}-{uuid.uuid4().hex}")
    rows = rows.observe(seen, F.collect_set(F.coalesce(PERIOD, F.lit(NO_DATE))).alias("present"))
    with open_writers(spark, OPEN_PERIODS):
        write_table(rows, run.path(table), run.fmt, partition_by=[PERIOD], dynamic=True)
    for period in {p or NO_DATE for p in periods} - set(seen.get.get("present") or ()):
        remove_path(spark, f"{run.path(table)}/{PERIOD}={period}")


def _by_period(rows: DataFrame) -> DataFrame:
    return rows.hint("rebalance", PERIOD)


def _moved(run: DailyGold, old: DataFrame, new: DataFrame, batches: list[str] | None = None) -> DataFrame:
    """(id_trans, stored, periods) of sales that are in one of two sets of accepted rows only, or differ: at most two periods each.

    A batch has one row of a key and is never changed, so rows with the same stamps are equal. ``batches``: where rows
    differ by these batches alone, only ids that they hold are looked up.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        period = F.date_format(F.to_date("fec_trans"), FORMATS[run.period]).alias(PERIOD)
        return df.select("id_trans", F.struct(period, "ingestion_timestamp", "batch_id").alias(name))
    old = accepted(old)
    if batches is not None:
        new = new.where(F.col("batch_id").isin(batches))
        old = old.join(new.select("id_trans").distinct(), "id_trans", "left_semi")
    both = side(old, "_old").join(side(accepted(new), "_new"), "id_trans", "full_outer")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        "id_trans", F.col("_old").isNotNull().alias("stored"), F.array_distinct(F.array_compact(F.array(
            *[F.when(F.col(s).isNotNull(), F.struct(F.col(f"{s}.{PERIOD}").alias(PERIOD))) for s in ("_old", "_new")]))).alias("periods"))


def _recategorised(spark: SparkSession, run: DailyGold, categories: DataFrame) -> DataFrame | None:
    """Articles whose category is another than at the last run; None where none is."""
    before = versions.read_current(spark, run.category_path, run.fmt, categories.schema)
    same = F.col("b.id_categ_n1").eqNullSafe(F.col("n.id_categ_n1"))
    both = before.alias("b").join(categories.alias("n"), F.col("b.art_id") == F.col("n.art_id"), "full_outer")
    other = both.where(~same).select(F.coalesce("b.art_id", "n.art_id").alias("art_id"))
    return None if other.isEmpty() else other


def refresh_daily(spark: SparkSession, run: DailyGold, products: DataFrame) -> Row:
    """Bring fact and marts up to the present silver sales and ``products`` (art_id, id_categ_n1); returns the ledger row.

    The first run, and one that finds the versions it would compare with pruned, writes everything.
    A run that finds nothing changed writes nothing and returns a row without periods.
    """
    last, since = read_ledger(spark, run).agg(F.max("run"), F.max_by("sales_version", "run")).first()
    version, then, now = changed_buckets(spark, run.silver, SALES, since or 0)
    categories = model.one_per_key(products.select("art_id", "id_categ_n1"), "art_id", ["id_categ_n1"])
    members = read_accepted(spark, run.silver, MEMBERS)
    whole = last is None or then is None
    with sized_shuffles(spark, folder_bytes(spark, run.silver.path(SALES))):
        if whole:
            fact = _fact(run, read_accepted(spark, run.silver, SALES), members)
            write_table(fact, run.path(FACT), run.fmt, partition_by=[PERIOD], rebalance=True)
            stored = read_daily(spark, run, FACT)
            write_table(_dated(run, marts.executive_kpis(stored, unique=True)), run.path(KPIS), run.fmt, partition_by=[PERIOD], rebalance=True)
            write_table(_dated(run, marts.daily_sales(stored, categories, unique=True)), run.path(BY_CATEGORY), run.fmt, partition_by=[PERIOD], rebalance=True)
            periods = category_periods = _periods(stored)
            other = categories
        else:
            periods = _replace_changed(spark, run, since, then, now, members) if now else []
            stored = read_daily(spark, run, FACT)
            _replace(spark, run, KPIS, _by_period(_dated(run, marts.executive_kpis(stored.where(_in(periods)), unique=True))), periods)
            other = _recategorised(spark, run, categories)
            category_periods = list(periods)
            if other is not None:
                sold = _periods(stored.select(PERIOD, "art_id").join(other, "art_id", "left_semi"))
                category_periods += [p for p in sold if p not in set(periods)]
            _replace(spark, run, BY_CATEGORY, _by_period(_dated(run, marts.daily_sales(
                stored.where(_in(category_periods)), categories, unique=True))), category_periods)
    if other is not None:
        versions.overwrite(categories, run.category_path, run.fmt)
    row = spark.createDataFrame([((last or 0) + 1, version, periods, category_periods)], LEDGER_SCHEMA)
    if whole or other is not None or version != since:
        row.coalesce(1).write.format(run.fmt).mode("append").save(run.ledger_path)
    return row.first()


def _replace_changed(spark: SparkSession, run: DailyGold, since: int, then: dict[int, int], now: dict[int, int],
                     members: DataFrame) -> list[dt.date | None]:
    """Correct the fact by the sales that differ between two states of the same buckets; returns the periods concerned."""
    new = read_buckets(spark, run.silver, SALES, now)
    batches = batches_since(spark, run.silver, SALES, since)
    moved = materialize(_moved(run, read_buckets(spark, run.silver, SALES, then), new, batches), "moved")
    periods = _periods(moved.select(F.explode("periods").alias("p")).select(f"p.{PERIOD}"))
    if periods:
        kept = read_daily(spark, run, FACT).where(_in(periods))
        if moved.count() * FEW <= new.count():
            kept = kept.join(moved.where("stored").select("id_trans"), "id_trans", "left_anti")
            came = _fact(run, accepted(new).join(moved.select("id_trans"), "id_trans", "left_semi"), members)
        else:  # all rows of the buckets anew: no join by id is needed to tell them from the others
            kept = kept.where(~in_buckets(spark, run.silver, SALES, list(now)))
            came = _fact(run, accepted(new), members).where(_in(periods))
        # kept rows lie in their periods already, so only the others are shuffled
        _replace(spark, run, FACT, kept.unionByName(_by_period(came)), periods)
    return periods
