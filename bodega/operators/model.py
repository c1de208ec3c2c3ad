"""Gold dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions import measures as M
from bodega.operators.joins import skew_join

PRODUCT_COLUMNS = (
    "art_id", "cod_barra", "desc_art", "id_categ_n1", "id_categ_n2", "id_categ_n3", "id_proveedor",
    "nombre_proveedor", "tiempo_repo_dias", "precio_lista", "peso_kg", "unid_medida", "activo",
)
SALE_COLUMNS = (
    "id_trans", "id_miembro", "id_tienda", "art_id", "fec_trans", "hra_trans", "qty_vendida",
    "precio_unitario_venta", "descuento_aplicado", "tipo_pago", "canal_venta",
    "ingestion_timestamp", "source_system", "batch_id", "year", "month", "day",
)
RETURN_COLUMNS = (
    "id_devolucion", "id_trans_origen", "art_id", "id_tienda", "fec_devolucion", "qty_devuelta",
    "motivo_cod", "canal_devolucion", "estado_devolucion", "vr_reembolso",
)


def dim_customers(df: DataFrame, as_of: M.AsOf = None) -> DataFrame:
    """Members with tenure in days, standard gender, default age band, active flag."""
    return df.withColumns({
        "antiguedad_dias": F.datediff(M.as_of_date(as_of), F.to_date("fec_registro")),
        "genero_std": M.gender(F.col("genero")),
        "cliente_activo_flag": M.flag(F.col("activo")),
    }).fillna({"rango_edad": M.DEFAULT_AGE_BAND})


def dim_stores(df: DataFrame) -> DataFrame:
    """Stores with standard type and distribution zone."""
    return df.withColumns({
        "tipo_tienda_std": M.store_type(F.col("tipo_tienda")),
        "zona_distribucion": M.zone(F.col("id_pais")),
    })


def dim_products(articles: DataFrame, suppliers: DataFrame, margin: str = "0.30") -> DataFrame:
    """Articles with supplier name, lead time and the estimated margin."""
    suppliers = suppliers.select(
        F.col("id_proveedor").alias("_supplier"),
        F.col("razon_social").alias("nombre_proveedor"),
        "tiempo_repo_dias",
    )
    share = F.lit(margin).cast("decimal(4,2)")
    return articles.join(suppliers, F.col("id_proveedor") == F.col("_supplier"), "left").select(
        *PRODUCT_COLUMNS,
        (F.col("precio_lista") * share).cast("decimal(14,4)").alias("margen_estimado_categoria"),
    )


def one_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, the smallest in column order: repeatable, so joins cannot fan out."""
    if len(columns) == 1:
        return df.groupBy(key).agg(F.min(columns[0]).alias(columns[0]))
    first = F.min(F.struct(*columns)).alias("_first")
    return df.groupBy(key).agg(first).select(key, "_first.*")


def _lookup(fact: DataFrame, lookup: DataFrame, key: str, hot_keys: Mapping | None) -> DataFrame:
    """Left join to a lookup with one row per key.

    ``hot_keys`` (key: rows) None leaves the join to Spark; a mapping, even an empty one, salts these
    keys and the null keys.
    """
    lookup = lookup.withColumnRenamed(key, "_key")
    if hot_keys is not None:
        return skew_join(fact, lookup, key, "_key", hot_left=hot_keys).drop("_key")
    return fact.join(lookup, F.col(key) == F.col("_key"), "left").drop("_key")


def fact_sales(sales: DataFrame, customers: DataFrame, hot_keys: Mapping | None = None,
               absent: DataFrame | None = None) -> DataFrame:
    """Sales with validated customer, net value, discount flag and sale date.

    Joined to the distinct customer keys: a member stored twice does not double its sales. With ``absent`` (see
    ``absent_keys``) joined to the few keys that the customers lack instead.
    """
    sold = sales.select([c for c in SALE_COLUMNS if c in sales.columns])
    if absent is not None:
        validated = sold.join(absent, F.col("id_miembro") == F.col("_absent"), "left").withColumn(
            "cliente_validado", F.when(F.col("_absent").isNull(), F.col("id_miembro"))).drop("_absent")
    else:
        known = customers.select("id_miembro").distinct().withColumn("cliente_validado", F.col("id_miembro"))
        validated = _lookup(sold, known, "id_miembro", hot_keys)
    return validated.withColumns({
        "cliente_anonimo_flag": M.flag(F.col("cliente_validado").isNull()),
        "vr_venta_neto": M.net_sale(
            F.col("qty_vendida"), F.col("precio_unitario_venta"), F.col("descuento_aplicado")),
        "venta_descuento_flag": M.flag(F.col("descuento_aplicado") > 0),
        "fec_venta": F.to_date("fec_trans"),
    })


def fact_inventory(stock: DataFrame, products: DataFrame, hot_keys: Mapping | None = None) -> DataFrame:
    """Stock snapshots with lead time, 14-day consumption, coverage, stock-out alert."""
    lead_time = one_per_key(products, "art_id", ["tiempo_repo_dias"])
    consumption, coverage = F.col("promedio_consumo_14dias"), F.col("cobertura_dias")
    physical = F.col("stock_fisico")
    return (
        _lookup(stock, lead_time, "art_id", hot_keys)
        .withColumn("promedio_consumo_14dias", F.round(physical / 14, 2))
        .withColumn("cobertura_dias",
                    F.when(consumption > 0, F.round(physical / consumption, 2)).otherwise(F.lit(0.0)))
        .withColumn("alerta_quiebre",
                    M.flag((coverage < F.col("tiempo_repo_dias")) & (consumption > 0)))
        .withColumn("diferencia_stock_min", physical - F.col("stock_minimo_config"))
    )


def stockout_alerts(inventory: DataFrame) -> DataFrame:
    return inventory.where("alerta_quiebre = 1")


def fact_returns(
    returns: DataFrame,
    sales: DataFrame,
    products: DataFrame,
    reasons: Mapping[str, str] | None = None,
    hot_sales: Mapping | None = None,
    hot_returns: Mapping | None = None,
    hot_articles: Mapping | None = None,
) -> DataFrame:
    """Returns with the sale they refer to, category and supplier, reason text, return rate.

    A sale stored more than once yields one row per copy. Few sales are returned, so sales are first
    reduced to the returned ids (a semi-join, for which Spark broadcasts or filters the sales scan);
    hot transaction ids can be salted on either side.
    """
    back = returns.select(*RETURN_COLUMNS)
    returned = back.select(F.col("id_trans_origen").alias("_returned")).where("_returned IS NOT NULL").distinct()
    sold = sales.select(F.col("id_trans").alias("_sale"), "qty_vendida", "precio_unitario_venta").join(
        returned, F.col("_sale") == F.col("_returned"), "left_semi")
    if hot_sales is not None or hot_returns is not None:
        joined = skew_join(back, sold, "id_trans_origen", "_sale", hot_returns, hot_sales)
    else:
        joined = back.join(sold, F.col("id_trans_origen") == F.col("_sale"), "left")
    category = one_per_key(products, "art_id", ["id_categ_n1", "id_proveedor"])
    return _lookup(joined, category, "art_id", hot_articles).select(
        *RETURN_COLUMNS,
        "id_categ_n1",
        "id_proveedor",
        "precio_unitario_venta",
        "qty_vendida",
        M.recode(F.col("motivo_cod"), M.RETURN_REASONS if reasons is None else reasons,
                 M.RETURN_REASON_OTHER).alias("motivo_desc"),
        F.col("precio_unitario_venta").alias("precio_original"),
        M.rate(F.col("qty_devuelta"), F.col("qty_vendida")).alias("tasa_devolucion"),
    )
