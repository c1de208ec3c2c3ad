"""Gold run: dimensions, facts, segments and marts in their final layout, then the data rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from bodega.functions.measures import AsOf
from bodega.operators import marts, model, rfm
from bodega.operators.conform import dedup
from bodega.operators.joins import heavy_keys
from bodega.operators.files import TARGET_BYTES, Compaction, ZoneMap, compact
from bodega.operators.layout import cluster
from bodega.operators.quality import (
    check_rules,
    check_table,
    in_range,
    not_null,
    rule_results,
)
from bodega.plans.silver import SilverRun, large, read_silver, unmatched
from bodega.schemas import TABLES
from bodega.session import folder_bytes, path_exists, sized_shuffles
from bodega.sources import versions
from bodega.sources.tables import SELF_DESCRIBED, read_table, register_table, write_table

# Tables with a clustered layout, and the columns their readers filter on.
CLUSTERED = {
    "fact_ventas": ("canal_venta", "art_id", "id_tienda"),
    "fact_inventario": ("art_id", "id_tienda"),
    "fact_rfm_clientes": ("grupo_valor",),
}
GOLD_TABLES = ("dim_clientes", "dim_tiendas", "dim_productos", "fact_ventas", "fact_inventario", "fact_devoluciones",
               "rfm_metrics", "fact_rfm_clientes", "agg_ventas_diarias", "agg_devoluciones_categoria", "kpi_ejecutivo_diario")
PARTITIONED = {"fact_ventas": ("fec_venta",)}


@dataclass(frozen=True)
class GoldRun:
    """Where gold lives and the date everything is relative to (None: today).

    ``staged``: every overwrite is a new version, and the one before stays in force until it is finished. Formats that
    keep versions themselves are overwritten in place.
    """

    root: str
    silver: SilverRun
    as_of: AsOf = None
    fmt: str = "parquet"
    catalog: str | None = None
    score_order: str = "reference"
    broadcast_bytes: int | None = None  # None: the session's threshold
    staged: bool = True

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def has_versions(self) -> bool:
        return self.staged and self.fmt not in SELF_DESCRIBED

    def current(self, spark: SparkSession, table: str) -> str:
        """The folder that holds the table's rows now."""
        return versions.current_path(spark, self.path(table)) if self.has_versions() else self.path(table)


class GoldBuilder:
    """Writes the gold tables one after another; later ones read the stored earlier ones."""

    def __init__(self, spark: SparkSession, run: GoldRun):
        self.spark, self.run = spark, run
        self._schemas: dict[str, StructType] = {}
        self._open: dict[str, DataFrame] = {}

    def _silver(self, table: str) -> DataFrame:
        return read_silver(self.spark, self.run.silver, table)

    def _newest(self, table: str) -> DataFrame:
        """Of a master table, the newest row of each key: copies would multiply what joins to them."""
        return dedup(self._silver(table), [TABLES[table].key])

    def _have(self, *tables: str) -> bool:
        """Whether silver has these source tables, and this run has built these gold tables."""
        silver = self.run.silver
        return all(path_exists(self.spark, silver.tagged_path(t)) if t in TABLES else t in self._schemas for t in tables)

    def _path(self, table: str) -> str:
        return self.run.current(self.spark, table)

    def _built(self, table: str) -> DataFrame:
        """A stored gold table; its files are listed once, however many tables read it."""
        if table not in self._open:
            self._open[table] = read_table(
                self.spark, self.run.current(self.spark, table), self.run.fmt, self._schemas.get(table))
        return self._open[table]

    def _write(self, table: str, df: DataFrame, source: str, bounds_from: DataFrame | None = None) -> None:
        """Write a table in its final layout: the clustering is part of the one write.

        ``source`` is the path of the largest table read; its size sets the shuffles.
        """
        partitions = PARTITIONED.get(table, ())
        with sized_shuffles(self.spark, folder_bytes(self.spark, source)):
            if table in CLUSTERED:
                df = cluster(df, CLUSTERED[table], partitions, bounds_from=bounds_from)
            if self.run.has_versions():
                versions.overwrite(df, self.run.path(table), self.run.fmt, partitions,
                                   f"{self.run.catalog}.{table}" if self.run.catalog else None)
            else:
                write_table(df, self.run.path(table), self.run.fmt, partition_by=partitions)
        self._schemas[table] = df.schema
        self._open.pop(table, None)
        if self.run.catalog and not self.run.has_versions():
            register_table(self.spark, f"{self.run.catalog}.{table}", self.run.path(table), self.run.fmt,
                           df.schema, partitions)

    def _hot(self, fact: DataFrame, key: str, lookup_path: str) -> dict | None:
        """Hot keys of a fact if its lookup is too large to be broadcast, else None."""
        run = self.run
        if not large(self.spark, lookup_path, run.broadcast_bytes):
            return None
        return heavy_keys(fact, key)

    def dimensions(self) -> None:
        path = self.run.silver.tagged_path
        if self._have("CRM_MIEMBROS"):
            self._write("dim_clientes", model.dim_customers(self._newest("CRM_MIEMBROS"), self.run.as_of), path("CRM_MIEMBROS"))
        if self._have("MSTR_TIENDAS"):
            self._write("dim_tiendas", model.dim_stores(self._newest("MSTR_TIENDAS")), path("MSTR_TIENDAS"))
        if self._have("MSTR_ARTICULOS", "MSTR_PROVEEDORES"):
            self._write("dim_productos", model.dim_products(
                self._newest("MSTR_ARTICULOS"), self._newest("MSTR_PROVEEDORES")), path("MSTR_ARTICULOS"))

    def facts(self) -> None:
        silver_path = self.run.silver.tagged_path
        products_path = self._path("dim_productos")

        if self._have("TRANS_VENTAS", "dim_clientes"):
            sales = self._silver("TRANS_VENTAS")
            customers = self._built("dim_clientes")
            hot, absent = unmatched(self.spark, sales, "id_miembro", customers, self._path("dim_clientes"),
                                    self.run.broadcast_bytes)
            fact = model.fact_sales(sales, customers, hot, absent)
            self._write("fact_ventas", fact, silver_path("TRANS_VENTAS"), bounds_from=sales)

        if self._have("INV_STOCK_DIARIO", "dim_productos"):
            stock = self._silver("INV_STOCK_DIARIO")
            hot = self._hot(stock, "art_id", products_path)
            fact = model.fact_inventory(stock, self._built("dim_productos"), hot)
            self._write("fact_inventario", fact, silver_path("INV_STOCK_DIARIO"), bounds_from=stock)

        if self._have("POST_DEVOLUCIONES", "fact_ventas", "dim_productos"):
            returns = self._silver("POST_DEVOLUCIONES")
            fact = model.fact_returns(
                returns, self._built("fact_ventas"), self._built("dim_productos"),
                hot_articles=self._hot(returns, "art_id", products_path))
            self._write("fact_devoluciones", fact, silver_path("POST_DEVOLUCIONES"))

    def segments(self) -> None:
        """Customer metrics are a stored table of their own: the tiles read it several times."""
        if not self._have("fact_ventas"):
            return
        self._write("rfm_metrics", rfm.rfm_metrics(self._built("fact_ventas"), self.run.as_of),
                    self._path("fact_ventas"))
        scores = rfm.rfm_scores(self._built("rfm_metrics"), self.run.score_order, stored=True)
        self._write("fact_rfm_clientes", rfm.rfm_groups(rfm.rfm_segments(scores)), self._path("rfm_metrics"))

    def marts(self) -> None:
        path, returns_path = self._path("fact_ventas"), self._path("fact_devoluciones")
        if self._have("fact_ventas", "dim_productos"):
            sales = self._built("fact_ventas")
            hot = self._hot(sales, "art_id", self._path("dim_productos"))
            self._write("agg_ventas_diarias", marts.daily_sales(sales, self._built("dim_productos"), hot), path)
        if self._have("fact_devoluciones"):
            self._write("agg_devoluciones_categoria", marts.returns_by_category(self._built("fact_devoluciones")), returns_path)
        if self._have("fact_ventas"):
            self._write("kpi_ejecutivo_diario", marts.executive_kpis(self._built("fact_ventas")), path)

    def rules(self) -> list[Row]:
        """Results of the rules whose tables this run has built."""
        tables = [self._built(t) if self._have(t) else None for t in ("fact_ventas", "fact_inventario", "fact_rfm_clientes")]
        if not any(t is not None for t in tables):
            return []
        source = self._path("fact_ventas" if tables[0] is not None else "fact_inventario")
        with sized_shuffles(self.spark, folder_bytes(self.spark, source)):
            return gold_rules(*tables).collect()


def gold_rules(sales: DataFrame | None, inventory: DataFrame | None, segments: DataFrame | None) -> DataFrame:
    """(test_name, passed) of the five gold rules, less those of absent tables; one aggregate per table."""
    checks = []
    if sales is not None:
        checks.append(check_table(sales, [
            not_null("fact_ventas_pk_not_null", "id_trans"),
            in_range("ventas_no_negativas", "vr_venta_neto", low=0),
        ], "fact_ventas_no_duplicates"))
    if inventory is not None:
        checks.append(check_rules(inventory, [in_range("stock_no_negativo", "stock_fisico", low=0)]))
    if segments is not None:
        checks.append(check_rules(segments, [not_null("rfm_segmentado", "grupo_valor")]))
    return rule_results(*checks)


def build_gold(spark: SparkSession, run: GoldRun) -> list[Row]:
    """All gold tables in order; returns the five rule results as rows."""
    gold = GoldBuilder(spark, run)
    gold.dimensions()
    gold.facts()
    gold.segments()
    gold.marts()
    return gold.rules()


def read_gold(spark: SparkSession, run: GoldRun, table: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    return read_table(spark, run.current(spark, table), run.fmt).select(*columns)


def zone_map(spark: SparkSession, run: GoldRun, table: str) -> ZoneMap:
    """The zones of a clustered table's present files, kept outside its folder."""
    path = run.current(spark, table)
    schema = read_table(spark, path, run.fmt).schema
    return ZoneMap(path, f"{run.root}/_zones/{table}/{path.rsplit('/', 1)[-1]}", schema, CLUSTERED[table], run.fmt)


def optimize_tables(spark: SparkSession, run: GoldRun, target: int = TARGET_BYTES) -> dict[str, Compaction]:
    """The layout command: small files of the three clustered tables are merged, and their zones brought up to date."""
    done = {}
    for table in CLUSTERED:
        path = run.current(spark, table)
        if not path_exists(spark, path):
            continue
        done[table] = compact(spark, path, read_table(spark, path, run.fmt).schema, PARTITIONED.get(table, ()), run.fmt, target)
        zone_map(spark, run, table).refresh(spark)
    return done
