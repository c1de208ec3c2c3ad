"""Daily sales, returns and executive KPI marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.operators.joins import skew_join
from bodega.operators.model import one_per_key


def _sales_measures(transactions: str, unique: bool = False) -> list[Column]:
    # The one distinct count makes Spark group by (keys, id_trans) first and shuffle on both, so
    # a hot date, channel or store is spread by its transactions before it is combined. Where each id is
    # stored once, they are counted as they are, and combined before the shuffle.
    return [
        F.round(F.sum("vr_venta_neto"), 2).alias("ventas_netas"),
        F.round(F.avg("vr_venta_neto"), 2).alias("ticket_promedio"),
        (F.count if unique else F.count_distinct)("id_trans").alias(transactions),
    ]


def daily_sales(sales: DataFrame, products: DataFrame, hot_articles: Mapping | None = None, unique: bool = False) -> DataFrame:
    """Net sales, mean ticket and transactions by date, channel, store and category. ``unique``: no id comes twice."""
    category = one_per_key(products, "art_id", ["id_categ_n1"]).withColumnRenamed("art_id", "_art")
    sold = sales.select("fec_venta", "canal_venta", "id_tienda", "art_id", "id_trans", "vr_venta_neto")
    if hot_articles is not None:
        joined = skew_join(sold, category, "art_id", "_art", hot_left=hot_articles)
    else:
        joined = sold.join(category, F.col("art_id") == F.col("_art"), "left")
    return joined.groupBy("fec_venta", "canal_venta", "id_tienda", "id_categ_n1").agg(
        *_sales_measures("transacciones", unique))


def returns_by_category(returns: DataFrame) -> DataFrame:
    """Mean return rate by reason, category, supplier and return channel."""
    return returns.groupBy("motivo_desc", "id_categ_n1", "id_proveedor", "canal_devolucion").agg(
        # rates have two digits: summed as decimals the mean does not depend on row order
        F.round(F.avg(F.col("tasa_devolucion").cast("decimal(12,2)")), 2).alias("promedio_devolucion"))


def executive_kpis(sales: DataFrame, unique: bool = False) -> DataFrame:
    """Net sales, mean ticket, transactions and share of discounted sales by date and channel. ``unique``: no id comes twice."""
    return sales.groupBy("fec_venta", "canal_venta").agg(
        *_sales_measures("total_transacciones", unique),
        F.round(F.sum("venta_descuento_flag") * 100 / F.count("venta_descuento_flag"), 2)
        .alias("porcentaje_ventas_descuento"),
    )


def preview(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first rows in key order; a top-n per task, merged."""
    return df.orderBy(*keys).limit(n)
