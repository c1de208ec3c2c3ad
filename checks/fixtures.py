"""The seven source tables as views over the given tables: one SQL text for both engines.

The remainders below give columns their values and plant defects (repeated rows, null articles,
unknown members, negative stock); every row of the given tables stays in.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from bodega.session import folder_bytes

VIEWS = {
    "trans_ventas": """
        SELECT l_orderkey*10+l_linenumber AS id_trans,
          CASE WHEN l_orderkey % 13 = 5 THEN CAST(999999999 AS BIGINT) ELSE o_custkey END AS id_miembro,
          CAST(l_suppkey % 25 AS BIGINT) AS id_tienda, l_partkey AS art_id, l_shipdate AS fec_trans,
          concat(lpad(CAST(l_orderkey % 24 AS STRING), 2, '0'), ':', lpad(CAST(l_partkey % 60 AS STRING), 2, '0'), ':00') AS hra_trans,
          CAST(l_quantity AS INT) AS qty_vendida,
          CAST(l_extendedprice AS DECIMAL(12,2)) AS precio_unitario_venta,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2))*CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(17,4)) AS descuento_aplicado,
          o_orderpriority AS tipo_pago,
          CASE o_orderstatus WHEN 'F' THEN 'Web' WHEN 'O' THEN 'Mobile' ELSE 'Tienda' END AS canal_venta
        FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey""",
    "crm_miembros": """
        SELECT c_custkey AS id_miembro, CAST('1990-01-01' AS DATE)+CAST(c_custkey % 1500 AS INT) AS fec_registro,
          n_name AS id_ciudad,
          CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS genero,
          CASE c_custkey % 6 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45' WHEN 3 THEN '46-60' WHEN 4 THEN '60+' END AS rango_edad,
          CASE WHEN c_custkey % 20 <> 0 THEN c_mktsegment END AS canal_pref, c_acctbal > 1000 AS activo,
          CAST('1990-01-01' AS DATE)+CAST(c_custkey % 1500 + c_custkey % 700 AS INT) AS fec_ultima_compra
        FROM {customer} JOIN {nation} ON c_nationkey=n_nationkey""",
    "mstr_tiendas": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_tienda, n_name AS nom_tienda,
          CASE n_nationkey % 3 WHEN 0 THEN 'Hipermercado' WHEN 1 THEN 'Supermercado' ELSE 'Conveniencia' END AS tipo_tienda,
          concat('CIUDAD_', CAST(n_nationkey % 7 AS STRING)) AS id_ciudad,
          CASE r_name WHEN 'AFRICA' THEN 'Ecuador' WHEN 'AMERICA' THEN 'Colombia' ELSE r_name END AS id_pais,
          CASE WHEN n_nationkey % 8 <> 0 THEN CAST(n_nationkey*100+100 AS DOUBLE) END AS metros_cuadrados,
          n_nationkey % 10 <> 0 AS activo, CAST('1985-01-01' AS DATE)+CAST(n_nationkey*30 AS INT) AS fec_apertura
        FROM {nation} JOIN {region} ON n_regionkey=r_regionkey""",
    "mstr_proveedores": """
        SELECT s_suppkey AS id_proveedor, s_name AS razon_social, concat('PAIS_', CAST(s_nationkey AS STRING)) AS pais_origen,
          CAST(s_suppkey % 30 + 1 AS INT) AS tiempo_repo_dias,
          CASE WHEN s_suppkey % 20 <> 0 THEN CAST(s_suppkey % 5 + 1 AS DOUBLE) END AS calificacion_calidad,
          s_acctbal > 0 AS activo
        FROM {supplier}""",
    "mstr_articulos": """
        SELECT p_partkey AS art_id, lpad(CAST(p_partkey AS STRING), 13, '0') AS cod_barra, p_name AS desc_art,
          p_type AS id_categ_n1, p_brand AS id_categ_n2, concat('N3-', CAST(p_size AS STRING)) AS id_categ_n3,
          p_partkey % 110 AS id_proveedor, CAST(p_retailprice AS DECIMAL(12,2)) AS precio_lista,
          CAST(p_size AS DOUBLE) AS peso_kg,
          CASE p_partkey % 3 WHEN 0 THEN 'UND' WHEN 1 THEN 'KG' ELSE 'LT' END AS unid_medida,
          true AS activo, CAST('1994-01-01' AS DATE)+CAST(p_partkey % 1000 AS INT) AS fec_alta
        FROM {part}""",
    "inv_stock_diario": """
        SELECT event_id AS id_snapshot, event_id % 2100 AS art_id, CAST(user_id % 25 AS BIGINT) AS id_tienda,
          CAST(ts AS DATE) AS fec_snapshot,
          CASE WHEN event_id % 100 = 0 THEN -10 ELSE CAST(floor(value) AS INT) END AS stock_fisico,
          CAST(user_id % 101 AS INT) AS stock_transito, CAST(user_id % 51 AS INT) AS stock_reservado,
          CAST(user_id % 41 + 10 AS INT) AS stock_minimo_config, CAST(user_id % 901 + 100 AS INT) AS stock_maximo_config
        FROM {events}""",
    "post_devoluciones": """
        SELECT l_orderkey*10+l_linenumber AS id_devolucion, l_orderkey*10+l_linenumber AS id_trans_origen,
          l_partkey AS art_id, CAST(l_suppkey % 25 AS BIGINT) AS id_tienda,
          CAST(l_shipdate AS DATE)+10 AS fec_devolucion, CAST(least(l_quantity, l_partkey % 5 + 1) AS INT) AS qty_devuelta,
          CASE l_partkey % 3 WHEN 0 THEN 'DAM' WHEN 1 THEN 'ERR' ELSE 'OTH' END AS motivo_cod,
          CASE l_linestatus WHEN 'F' THEN 'Web' ELSE 'Tienda' END AS canal_devolucion,
          CASE l_linenumber % 3 WHEN 0 THEN 'Aprobada' WHEN 1 THEN 'Pendiente' ELSE 'Rechazada' END AS estado_devolucion,
          CAST(CAST(least(l_quantity, l_partkey % 5 + 1) AS INT)*CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS vr_reembolso
        FROM {lineitem} WHERE l_returnflag='R'""",
    # all sales, some of them twice, some without an article
    "trans_ventas_raw": """
        SELECT id_trans, id_miembro, id_tienda, CASE WHEN id_trans % 211 <> 0 THEN art_id END AS art_id, fec_trans,
          hra_trans, qty_vendida, precio_unitario_venta, descuento_aplicado, tipo_pago, canal_venta
        FROM {trans_ventas}
        UNION ALL
        SELECT id_trans, id_miembro, id_tienda, CASE WHEN id_trans % 211 <> 0 THEN art_id END AS art_id, fec_trans,
          hra_trans, qty_vendida, precio_unitario_venta, descuento_aplicado, tipo_pago, canal_venta
        FROM {trans_ventas} WHERE id_trans % 97 = 0""",
}


def spread(df: DataFrame, min_bytes: int = 4 << 20) -> DataFrame:
    """Redistribute a stored table that has far fewer splits than the session has cores.

    The given tables are files of one row group, so one task each however large the session; tables
    of real size have splits enough, and the library reads them as they are.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    if sum(folder_bytes(spark, path) for path in df.inputFiles()) < min_bytes:
        return df
    return df.repartition(cores)


def _inputs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a given table, as a DataFrame."""
    if name not in VIEWS:
        return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    return spark.sql(VIEWS[name], **{i: view(spark, sf_dir, i) for i in _inputs(name)})


def sql(body: str) -> str:
    """DuckDB text of a query over ``{view}`` names, with the views as leading CTEs."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for needed in _inputs(name):
                add(needed)
            ordered[name] = VIEWS[name]

    for name in re.findall(r"\{(\w+)\}", body):
        add(name)
    text = re.sub(r"\{(\w+)\}", r"\1", body).strip()
    if not ordered:
        return text
    ctes = ", ".join(f"{name} AS ({re.sub(r'{(\w+)}', r'\1', text_)})" for name, text_ in ordered.items())
    return f"WITH {ctes}, {text[5:]}" if text.upper().startswith("WITH ") else f"WITH {ctes} {text}"
