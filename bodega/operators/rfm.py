"""Recency, frequency, monetary segmentation of customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions import measures as M
from bodega.operators.tiles import TileOrder, ntile_distributed
from bodega.session import materialize

ACTIVE_DAYS = 180
WINDOW_DAYS = 90
TILES = 5


def sales_since(sales: DataFrame, as_of: M.AsOf = None, days: int = WINDOW_DAYS) -> DataFrame:
    """Sales of the last ``days`` days and later; prunes a table partitioned by sale date."""
    return sales.where(F.col("fec_venta") >= F.date_sub(M.as_of_date(as_of), days))


def active_customers(sales: DataFrame, as_of: M.AsOf = None, days: int = ACTIVE_DAYS) -> DataFrame:
    """Customers whose last purchase is at most ``days`` old, with its date.

    The latest date reaches the limit exactly when some date does, so older sales are cut
    before the aggregate instead of after it: same rows, but only recent partitions are read.
    """
    return sales_since(sales, as_of, days).groupBy("id_miembro").agg(
        F.max("fec_venta").alias("ultima_compra"))


def restrict_to(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales of the given customers; never multiplies a sale."""
    return sales.join(customers.select("id_miembro"), "id_miembro", "left_semi").select(*sales.columns)


def rfm_metrics(sales: DataFrame, as_of: M.AsOf = None, days: int = WINDOW_DAYS,
                active_days: int = ACTIVE_DAYS) -> DataFrame:
    """Days since the last purchase, transactions and net value per active customer.

    Equals restricting the window's sales to the active customers first: a customer with sales
    in the window is active by their last date, which the aggregate knows. So one scan of the
    window, one aggregate and no join; a hot customer is spread by transaction and combined.
    """
    recency = F.datediff(M.as_of_date(as_of), F.max("fec_venta"))
    return (
        sales_since(sales, as_of, days)
        .where(F.col("id_miembro").isNotNull())
        .groupBy("id_miembro")
        .agg(
            recency.alias("recency"),
            F.count_distinct("id_trans").alias("frequency"),
            F.round(F.sum("vr_venta_neto"), 2).alias("monetary"),
        )
        .where(F.col("recency") <= active_days)
    )


def rfm_scores(metrics: DataFrame, order: str = "reference", stored: bool = False) -> DataFrame:
    """Quintiles ``r_score``, ``f_score``, ``m_score``; ties by customer id.

    ``order="reference"`` numbers frequency and value from the top, so 1 is the best there and
    5 the best recency; ``order="best_is_5"`` makes 5 the best of all three. ``metrics`` is
    written to the shared folder first unless it is ``stored`` already.
    """
    if order not in ("reference", "best_is_5"):
        raise ValueError(f"unknown order {order!r}")
    table = metrics if stored else materialize(metrics, "rfm-metrics")
    orders = {
        "r_score": TileOrder("recency"),
        "f_score": TileOrder("frequency", descending=True),
        "m_score": TileOrder("monetary", descending=True),
    }
    flipped = ["r_score"] if order == "reference" else list(orders)
    tiled = ntile_distributed(table, orders, "id_miembro", TILES)
    return tiled.withColumns({name: F.lit(TILES + 1) - F.col(name) for name in flipped})


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn(
        "segmento_rfm", M.rfm_label(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def rfm_groups(scores: DataFrame) -> DataFrame:
    return scores.withColumn(
        "grupo_valor", M.rfm_group(F.col("r_score"), F.col("f_score"), F.col("m_score")))
