"""The registered queries as SQL for DuckDB, written from the operators' definitions.

Rounding is spelled out in whole numbers (half away from zero), so no engine's floating-point
rounding takes part.
"""

from __future__ import annotations

from checks.fixtures import sql

AS_OF = "DATE '2001-08-01'"
SPLIT = "TIMESTAMP '1999-06-30 00:00:00'"

SALE = ("id_trans, id_miembro, id_tienda, art_id, CAST(fec_trans AS VARCHAR) AS fec_trans, hra_trans, "
        "CAST(qty_vendida AS BIGINT) AS qty_vendida, CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, "
        "CAST(descuento_aplicado AS DOUBLE) AS descuento_aplicado, tipo_pago, canal_venta")
RETURN = ("id_devolucion, id_trans_origen, art_id, id_tienda, CAST(fec_devolucion AS VARCHAR) AS fec_devolucion, "
          "CAST(qty_devuelta AS BIGINT) AS qty_devuelta, motivo_cod, canal_devolucion, estado_devolucion, "
          "CAST(vr_reembolso AS DOUBLE) AS vr_reembolso")
STOCK = ("id_snapshot, art_id, id_tienda, CAST(fec_snapshot AS VARCHAR) AS fec_snapshot, CAST(stock_fisico AS BIGINT) AS stock_fisico, "
         "CAST(stock_transito AS BIGINT) AS stock_transito, CAST(stock_reservado AS BIGINT) AS stock_reservado, "
         "CAST(stock_minimo_config AS BIGINT) AS stock_minimo_config, CAST(stock_maximo_config AS BIGINT) AS stock_maximo_config")
# of the rows of a key that are equally new, the largest in column order
NEWEST = ("id_miembro DESC, id_tienda DESC, fec_trans DESC, hra_trans DESC, qty_vendida DESC, precio_unitario_venta DESC, "
          "descuento_aplicado DESC, tipo_pago DESC, canal_venta DESC")
MEMBER_TAIL = "CAST(fec_ultima_compra AS VARCHAR) AS fec_ultima_compra"
AUDIT = ("'2001-08-01 06:00:00' AS ingestion_timestamp, 'RETAIL_SOURCE' AS source_system, 'batch-1' AS batch_id, "
         "'2001' AS year, '08' AS month, '01' AS day")


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator to the nearest whole number, halves away from zero."""
    return (f"(sign({numerator}) * ((2 * abs(CAST({numerator} AS HUGEINT)) + CAST({denominator} AS HUGEINT)) "
            f"// (2 * CAST({denominator} AS HUGEINT))))")


def cents(numerator: str, denominator: str) -> str:
    return f"CAST({half_up(numerator, denominator)} AS DOUBLE) / 100"


# vr_venta_neto in 1/10000 units, as a whole number
NET = "CAST((qty_vendida * precio_unitario_venta - descuento_aplicado) * 10000 AS BIGINT)"

FACT = f"""
    fact AS (
      SELECT s.*, m.id_miembro AS cliente_validado, {NET} AS net,
        CASE WHEN descuento_aplicado > 0 THEN 1 ELSE 0 END AS disc, CAST(fec_trans AS DATE) AS fec_venta
      FROM {{trans_ventas}} s LEFT JOIN (SELECT DISTINCT id_miembro FROM {{crm_miembros}}) m ON s.id_miembro = m.id_miembro)"""

PRODUCT = """
    product AS (
      SELECT a.*, p.razon_social AS nombre_proveedor, p.tiempo_repo_dias
      FROM {mstr_articulos} a LEFT JOIN {mstr_proveedores} p ON a.id_proveedor = p.id_proveedor)"""

INVENTORY = PRODUCT + f""",
    inv0 AS (
      SELECT i.*, p.tiempo_repo_dias, {half_up('stock_fisico * 100', '14')} AS prom
      FROM {{inv_stock_diario}} i LEFT JOIN product p ON i.art_id = p.art_id),
    inv1 AS (
      SELECT *, CASE WHEN prom > 0 THEN {half_up('stock_fisico * 10000', 'prom')} ELSE 0 END AS cob FROM inv0),
    inv AS (
      SELECT id_snapshot, art_id, id_tienda, CAST(fec_snapshot AS VARCHAR) AS fec_snapshot,
        CAST(stock_fisico AS BIGINT) AS stock_fisico, CAST(stock_transito AS BIGINT) AS stock_transito,
        CAST(stock_reservado AS BIGINT) AS stock_reservado, CAST(stock_minimo_config AS BIGINT) AS stock_minimo_config,
        CAST(stock_maximo_config AS BIGINT) AS stock_maximo_config, CAST(tiempo_repo_dias AS BIGINT) AS tiempo_repo_dias,
        CAST(prom AS DOUBLE) / 100 AS promedio_consumo_14dias, CAST(cob AS DOUBLE) / 100 AS cobertura_dias,
        CAST(CASE WHEN cob < tiempo_repo_dias * 100 AND prom > 0 THEN 1 ELSE 0 END AS BIGINT) AS alerta_quiebre,
        CAST(stock_fisico - stock_minimo_config AS BIGINT) AS diferencia_stock_min
      FROM inv1)"""

RETURNS_FACT = PRODUCT + f""",
    back AS (
      SELECT d.*, p.id_categ_n1, p.id_proveedor, v.precio_unitario_venta, v.qty_vendida,
        CASE motivo_cod WHEN 'DAM' THEN 'Producto Dañado' WHEN 'ERR' THEN 'Error Cliente' ELSE 'Otros' END AS motivo_desc,
        CASE WHEN v.qty_vendida > 0 THEN {half_up('qty_devuelta * 10000', 'v.qty_vendida')} ELSE 0 END AS tasa
      FROM {{post_devoluciones}} d LEFT JOIN {{trans_ventas}} v ON d.id_trans_origen = v.id_trans
      LEFT JOIN product p ON d.art_id = p.art_id)"""


def metrics(sales: str, days: int = 90, active: int = 180) -> str:
    return f"""
    active AS (
      SELECT id_miembro FROM {sales} GROUP BY id_miembro
      HAVING date_diff('day', max(fec_venta), {AS_OF}) <= {active}),
    metrics AS (
      SELECT id_miembro, CAST(date_diff('day', max(fec_venta), {AS_OF}) AS BIGINT) AS recency,
        count(DISTINCT id_trans) AS frequency, {half_up('sum(net)', '100')} AS money
      FROM {sales} WHERE fec_venta >= {AS_OF} - {days} AND id_miembro IN (SELECT id_miembro FROM active)
      GROUP BY id_miembro)"""


SCORES = """
    scores AS (
      SELECT id_miembro, recency, frequency, CAST(money AS DOUBLE) / 100 AS monetary,
        6 - ntile(5) OVER (ORDER BY recency, id_miembro) AS r_score,
        ntile(5) OVER (ORDER BY frequency DESC, id_miembro) AS f_score,
        ntile(5) OVER (ORDER BY money DESC, id_miembro) AS m_score
      FROM metrics),
    segments AS (
      SELECT *, 'R' || r_score || '-F' || f_score || '-M' || m_score AS segmento_rfm FROM scores),
    groups_ AS (
      SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
        WHEN r_score >= 4 THEN 'Clientes Recientes' WHEN f_score >= 4 THEN 'Frecuentes' ELSE 'Estandar' END AS grupo_valor
      FROM segments)"""

KNOWN = ", known AS (SELECT * FROM fact WHERE cliente_validado IS NOT NULL)"
RFM = FACT + KNOWN + "," + metrics("known") + "," + SCORES

FACT_COLUMNS = (SALE + ", {audit}cliente_validado, CAST(CASE WHEN cliente_validado IS NULL THEN 1 ELSE 0 END AS BIGINT) AS cliente_anonimo_flag, "
                "CAST(net AS DOUBLE) / 10000 AS vr_venta_neto, CAST(disc AS BIGINT) AS venta_descuento_flag, CAST(fec_venta AS VARCHAR) AS fec_venta")


def sales_measures(transactions: str) -> str:
    return (f"{cents('sum(net)', '100')} AS ventas_netas, {cents('sum(net)', '(100 * count(*))')} AS ticket_promedio, "
            f"count(DISTINCT id_trans) AS {transactions}")


KPI = (f"SELECT CAST(fec_venta AS VARCHAR) AS fec_venta, canal_venta, {sales_measures('total_transacciones')}, "
       f"{cents('sum(disc) * 10000', 'count(*)')} AS porcentaje_ventas_descuento FROM {{sales}} GROUP BY fec_venta, canal_venta")

RETURNS_MART = (f"SELECT motivo_desc, id_categ_n1, id_proveedor, canal_devolucion, {cents('sum(tasa)', 'count(*)')} AS promedio_devolucion "
                "FROM back GROUP BY motivo_desc, id_categ_n1, id_proveedor, canal_devolucion")

TAGGED = """
    tagged AS (
      SELECT s.*, CASE WHEN s.id_trans IS NULL OR s.id_miembro IS NULL OR s.art_id IS NULL THEN 'NULL_MANDATORY_FIELD'
        WHEN NOT EXISTS (SELECT 1 FROM {crm_miembros} m WHERE m.id_miembro = s.id_miembro) THEN 'INVALID_CUSTOMER_ID'
        ELSE 'NONE' END AS error_reason
      FROM (SELECT DISTINCT * FROM {trans_ventas_raw}) s)"""

SALE_NAMES = ("id_trans", "id_miembro", "id_tienda", "art_id", "fec_trans", "hra_trans", "qty_vendida",
              "precio_unitario_venta", "descuento_aplicado", "tipo_pago", "canal_venta")

STORE = ("id_tienda, nom_tienda, tipo_tienda, id_ciudad, id_pais, metros_cuadrados, activo, CAST(fec_apertura AS VARCHAR) AS fec_apertura, "
         "CASE WHEN upper(tipo_tienda) LIKE '%HIPER%' THEN 'HIPERMERCADO' WHEN upper(tipo_tienda) LIKE '%SUPER%' THEN 'SUPERMERCADO' ELSE 'OTROS' END AS tipo_tienda_std, "
         "CASE upper(id_pais) WHEN 'ECUADOR' THEN 'NORTE' WHEN 'COLOMBIA' THEN 'SUR' ELSE 'CENTRO' END AS zona_distribucion")

PRODUCT_COLUMNS = ("art_id, cod_barra, desc_art, id_categ_n1, id_categ_n2, id_categ_n3, id_proveedor, nombre_proveedor, "
                   "CAST(tiempo_repo_dias AS BIGINT) AS tiempo_repo_dias, CAST(precio_lista AS DOUBLE) AS precio_lista, peso_kg, unid_medida, activo, "
                   "CAST(CAST(precio_lista * 100 AS BIGINT) * 30 AS DOUBLE) / 10000 AS margen_estimado_categoria")

LOADED = " UNION ALL ".join(
    f"SELECT '{name.upper()}' AS table_name, count(*) AS record_count FROM {{{name}}}"
    for name in ("mstr_articulos", "mstr_proveedores", "mstr_tiendas", "crm_miembros", "trans_ventas",
                 "inv_stock_diario", "post_devoluciones"))

WATERMARKS = ("SELECT 'TRANS_VENTAS' AS table_name, CAST(max(fec_trans) AS VARCHAR) AS last_watermark FROM {trans_ventas} "
              "UNION ALL SELECT 'INV_STOCK_DIARIO', CAST(max(fec_snapshot) AS VARCHAR) FROM {inv_stock_diario} "
              "UNION ALL SELECT 'POST_DEVOLUCIONES', CAST(max(fec_devolucion) AS VARCHAR) FROM {post_devoluciones}")

ARTICLES = ("art_id, cod_barra, desc_art, id_categ_n1, id_categ_n2, id_categ_n3, id_proveedor, CAST(precio_lista AS DOUBLE) AS precio_lista, "
            "peso_kg, unid_medida, activo, CAST(fec_alta AS VARCHAR) AS fec_alta")

SILVER_SALES = "WITH " + TAGGED + f" SELECT {SALE} FROM tagged WHERE error_reason = 'NONE'"
FACT_WITH_AUDIT = "WITH " + FACT + " SELECT " + FACT_COLUMNS.replace("{audit}", AUDIT + ", ") + " FROM fact"
SCORE_COLUMNS = "id_miembro, recency, frequency, monetary, r_score, f_score, m_score"

# the conformed sales of the full run as a fact
SILVER_FACT = TAGGED + f""",
    fact AS (
      SELECT *, {NET} AS net, CASE WHEN descuento_aplicado > 0 THEN 1 ELSE 0 END AS disc,
        CAST(fec_trans AS DATE) AS fec_venta
      FROM tagged WHERE error_reason = 'NONE')"""

IN_A_BATCH = NEWEST.replace("fec_trans", "art_id DESC NULLS LAST, fec_trans")


def merged(again: str) -> str:
    """Sales in force after three runs: the newest row of each key, those of ``again`` sent again with another date."""
    return (
        f"placed AS (SELECT *, {again} AS again, row_number() OVER (PARTITION BY id_trans ORDER BY NOT ({again}) AND fec_trans > "
        f"{SPLIT} DESC, {IN_A_BATCH}) AS place " "FROM {trans_ventas_raw}), "
        "merged AS (SELECT * REPLACE (CASE WHEN again THEN fec_trans + INTERVAL 10 YEARS ELSE fec_trans END AS fec_trans, "
        "CASE WHEN again THEN qty_vendida + 1 ELSE qty_vendida END AS qty_vendida) FROM placed WHERE place = 1), "
        "held AS (SELECT *, CASE WHEN art_id IS NULL THEN 'NULL_MANDATORY_FIELD' "
        "WHEN id_miembro NOT IN (SELECT id_miembro FROM {crm_miembros}) THEN 'INVALID_CUSTOMER_ID' ELSE 'NONE' END AS error_reason FROM merged)")


MERGED = merged("id_trans % 50 = 1")
MERGED_FACT = merged("id_trans % 1000 = 1") + f""",
    fact AS (SELECT *, {NET} AS net, CASE WHEN descuento_aplicado > 0 THEN 1 ELSE 0 END AS disc, CAST(fec_trans AS DATE) AS fec_venta
      FROM held WHERE error_reason = 'NONE'),
    earlier AS (SELECT *, row_number() OVER (PARTITION BY id_trans ORDER BY fec_trans > {SPLIT} DESC, {IN_A_BATCH}) AS place FROM {{trans_ventas_raw}}),
    moved AS (SELECT strftime(fec_trans, '%Y-%m') AS m FROM fact WHERE again UNION SELECT strftime(fec_trans, '%Y-%m') FROM earlier
      WHERE place = 1 AND id_trans % 1000 = 1 AND art_id IS NOT NULL AND id_miembro IN (SELECT id_miembro FROM {{crm_miembros}}))"""

_SQL = {
    "scan_full": "SELECT id_proveedor, razon_social, pais_origen, CAST(tiempo_repo_dias AS BIGINT) AS tiempo_repo_dias, calificacion_calidad, activo FROM {mstr_proveedores}",
    "scan_incremental": f"SELECT {SALE} FROM {{trans_ventas}} v WHERE v.fec_trans > {SPLIT}",
    "scan_incremental_inclusive": f"SELECT {SALE} FROM {{trans_ventas}} v WHERE v.fec_trans >= {SPLIT}",
    "watermark_lookup": WATERMARKS,
    "watermark_advance": (
        "SELECT 'TRANS_VENTAS' AS table_name, CAST(least(max(fec_trans), TIMESTAMP '2001-08-01 00:00:00') AS VARCHAR) AS last_watermark "
        f"FROM {{trans_ventas}} WHERE fec_trans > {SPLIT} "
        "UNION ALL SELECT 'INV_STOCK_DIARIO', CAST(max(fec_snapshot) AS VARCHAR) FROM {inv_stock_diario} "
        "WHERE date_trunc('month', fec_snapshot) <= TIMESTAMP '1999-06-30 00:00:00' HAVING count(*) > 0 "
        "UNION ALL SELECT 'POST_DEVOLUCIONES', CAST(max(fec_devolucion) AS VARCHAR) FROM {post_devoluciones} "
        "WHERE date_trunc('month', fec_devolucion) <= TIMESTAMP '1999-06-30 00:00:00' HAVING count(*) > 0"),
    "audit_columns": f"SELECT {RETURN}, {AUDIT} FROM {{post_devoluciones}}",
    "append_partitioned": (
        f"SELECT '2001' AS year, '08' AS month, CASE WHEN fec_trans <= {SPLIT} THEN '01' ELSE '02' END AS day, "
        f"CASE WHEN fec_trans <= {SPLIT} THEN 'batch-1' ELSE 'batch-2' END AS batch_id, count(*) AS n, CAST(sum(qty_vendida) AS BIGINT) AS qty "
        "FROM {trans_ventas} GROUP BY ALL"),
    "ingest_empty_batch": (
        "SELECT 'TRANS_VENTAS' AS table_name, CAST(0 AS BIGINT) AS record_count, 'SUCCESS' AS status, 'Sin nuevos registros' AS error_message, "
        "CAST(max(fec_trans) AS VARCHAR) AS last_watermark, count(*) AS stored_rows FROM {trans_ventas}"),
    "ingest_incremental": (
        f"SELECT {SALE}, CASE WHEN v.fec_trans <= {SPLIT} THEN '2001-08-01 06:00:00' ELSE '2001-08-02 06:00:00' END AS ingestion_timestamp, "
        f"'RETAIL_SOURCE' AS source_system, CASE WHEN v.fec_trans <= {SPLIT} THEN 'batch-1' ELSE 'batch-2' END AS batch_id, "
        f"'2001' AS year, '08' AS month, CASE WHEN v.fec_trans <= {SPLIT} THEN '01' ELSE '02' END AS day FROM {{trans_ventas}} v"),
    "ingest_log": f"SELECT table_name, record_count, 'batch-1' AS batch_id, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message FROM ({LOADED}) t",
    "ingest_all": (
        "SELECT table_name, CASE WHEN table_name = 'MSTR_TIENDAS' THEN 0 ELSE record_count END AS record_count, "
        f"CASE WHEN table_name = 'MSTR_TIENDAS' THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM ({LOADED}) t"),
    "export_roundtrip": f"SELECT {ARTICLES}, f.fmt FROM {{mstr_articulos}} JOIN (VALUES ('csv'), ('parquet')) f(fmt) ON true",
    "stream_ingest": f"SELECT {RETURN}, {AUDIT} FROM {{post_devoluciones}}",
    "scan_table": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders",
    "dedup_rows": f"SELECT DISTINCT {SALE} FROM {{trans_ventas_raw}}",
    "dedup_newest_per_key": (
        "SELECT id_miembro, CAST(fec_registro AS VARCHAR) AS fec_registro, id_ciudad, genero, CASE WHEN activo THEN '60+' ELSE rango_edad END AS rango_edad, "
        f"canal_pref, activo, {MEMBER_TAIL}, CASE WHEN activo THEN '2001-08-02 06:00:00' ELSE '2001-08-01 06:00:00' END AS ingestion_timestamp, "
        "'RETAIL_SOURCE' AS source_system, CASE WHEN activo THEN 'batch-2' ELSE 'batch-1' END AS batch_id, '2001' AS year, '08' AS month, "
        "CASE WHEN activo THEN '02' ELSE '01' END AS day FROM {crm_miembros}"),
    "mandatory_valid": f"SELECT {SALE} FROM {{trans_ventas_raw}} WHERE id_trans IS NOT NULL AND id_miembro IS NOT NULL AND art_id IS NOT NULL",
    "mandatory_rejected": f"SELECT {SALE}, 'NULL_MANDATORY_FIELD' AS error_reason FROM {{trans_ventas_raw}} WHERE id_trans IS NULL OR id_miembro IS NULL OR art_id IS NULL",
    "hash_pii": f"SELECT id_miembro, CAST(fec_registro AS VARCHAR) AS fec_registro, genero, rango_edad, canal_pref, activo, {MEMBER_TAIL}, sha256(id_ciudad) AS id_ciudad_hash FROM {{crm_miembros}}",
    "cast_boolean": "SELECT id_miembro, CASE genero WHEN 'M' THEN true WHEN 'F' THEN false END AS activo FROM {crm_miembros}",
    "null_flag_fill": (
        "SELECT id_miembro, CAST(fec_registro AS VARCHAR) AS fec_registro, id_ciudad, genero, rango_edad, coalesce(canal_pref, 'NO_DEFINIDO') AS canal_pref, "
        f"activo, {MEMBER_TAIL}, CAST(CASE WHEN canal_pref IS NULL THEN 1 ELSE 0 END AS BIGINT) AS canal_pref_null_flag FROM {{crm_miembros}}"),
    "fk_rejected": f"SELECT {SALE}, 'INVALID_CUSTOMER_ID' AS error_reason FROM {{trans_ventas}} WHERE id_miembro NOT IN (SELECT id_miembro FROM {{crm_miembros}})",
    "fk_valid": f"SELECT {SALE} FROM {{trans_ventas}} WHERE id_miembro IN (SELECT id_miembro FROM {{crm_miembros}})",
    "fk_valid_inner": f"SELECT {SALE} FROM {{trans_ventas}} JOIN (SELECT id_miembro FROM {{crm_miembros}} UNION ALL SELECT id_miembro FROM {{crm_miembros}} WHERE activo) m USING (id_miembro)",
    "quarantine_union": "WITH " + TAGGED + f" SELECT {SALE}, error_reason FROM tagged WHERE error_reason <> 'NONE'",
    "quality_report": "WITH " + TAGGED + ", facts AS (SELECT count(*) FILTER (error_reason = 'NONE') AS total, "
        "count(*) FILTER (error_reason = 'NULL_MANDATORY_FIELD') AS rejected_records, count(*) FILTER (error_reason = 'INVALID_CUSTOMER_ID') AS fk_rejected FROM tagged), "
        "original AS (SELECT count(*) AS n FROM {trans_ventas_raw}), nulls AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM tagged WHERE error_reason = 'NONE'" for c in SALE_NAMES)
        + f") SELECT 'TRANS_VENTAS' AS table_name, column_name, null_count, {cents('null_count * 10000', 'total')} AS null_percentage, rejected_records, fk_rejected, "
        f"{cents('total * 10000', 'n')} AS conform_percentage, 'batch-1' AS batch_id FROM nulls, facts, original",
    "silver_summary": "WITH " + TAGGED + " SELECT 'TRANS_VENTAS' AS table_name, (SELECT count(*) FROM {trans_ventas_raw}) AS original_count, count(*) AS dedup_count, "
        "count(*) FILTER (error_reason = 'NONE') AS final_count, count(*) FILTER (error_reason = 'NULL_MANDATORY_FIELD') AS rejected_count, "
        "count(*) FILTER (error_reason = 'INVALID_CUSTOMER_ID') AS fk_rejected_count FROM tagged",
    "silver_ventas": SILVER_SALES,
    "silver_ventas_salted": SILVER_SALES,
    "silver_clientes": (
        "SELECT DISTINCT id_miembro, CAST(fec_registro AS VARCHAR) AS fec_registro, genero, rango_edad, coalesce(canal_pref, 'NO_DEFINIDO') AS canal_pref, activo, "
        f"{MEMBER_TAIL}, sha256(id_ciudad) AS id_ciudad_hash, CAST(CASE WHEN canal_pref IS NULL THEN 1 ELSE 0 END AS BIGINT) AS canal_pref_null_flag "
        "FROM {crm_miembros} WHERE id_miembro IS NOT NULL"),
    "dim_clientes": (
        "SELECT id_miembro, CAST(fec_registro AS VARCHAR) AS fec_registro, id_ciudad, genero, coalesce(rango_edad, '26-35') AS rango_edad, canal_pref, activo, "
        f"{MEMBER_TAIL}, CAST(date_diff('day', fec_registro, {AS_OF}) AS BIGINT) AS antiguedad_dias, coalesce(genero, 'NO INFORMADO') AS genero_std, "
        "CAST(CASE WHEN activo THEN 1 ELSE 0 END AS BIGINT) AS cliente_activo_flag FROM {crm_miembros}"),
    "dim_tiendas": f"SELECT {STORE} FROM {{mstr_tiendas}}",
    "dim_productos": "WITH " + PRODUCT + f" SELECT {PRODUCT_COLUMNS} FROM product",
    "fact_ventas": FACT_WITH_AUDIT,
    "fact_ventas_salted": FACT_WITH_AUDIT,
    "fact_inventario": "WITH " + INVENTORY + " SELECT * FROM inv",
    "stockout_alerts": "WITH " + INVENTORY + " SELECT * FROM inv WHERE alerta_quiebre = 1",
    "rfm_active": "WITH " + FACT + KNOWN + f" SELECT id_miembro, CAST(max(fec_venta) AS VARCHAR) AS ultima_compra FROM known GROUP BY id_miembro HAVING date_diff('day', max(fec_venta), {AS_OF}) <= 180",
    "sales_last_90": "WITH " + FACT + KNOWN + " SELECT " + FACT_COLUMNS.replace("{audit}", "") + f" FROM known k WHERE k.fec_venta >= {AS_OF} - 90",
    "rfm_sales": "WITH " + FACT + KNOWN + "," + metrics("known") + " SELECT " + FACT_COLUMNS.replace("{audit}", "") + f" FROM known k WHERE k.fec_venta >= {AS_OF} - 90 AND id_miembro IN (SELECT id_miembro FROM active)",
    "rfm_metrics": "WITH " + FACT + KNOWN + "," + metrics("known") + " SELECT id_miembro, recency, frequency, CAST(money AS DOUBLE) / 100 AS monetary FROM metrics",
    "rfm_metrics_wide_window": "WITH " + FACT + KNOWN + "," + metrics("known", 400, 30) + " SELECT id_miembro, recency, frequency, CAST(money AS DOUBLE) / 100 AS monetary FROM metrics",
    "rfm_scores": "WITH " + RFM + f" SELECT {SCORE_COLUMNS} FROM scores",
    "rfm_scores_distributed": "WITH " + RFM + f" SELECT {SCORE_COLUMNS} FROM scores",
    "rfm_scores_best_is_5": "WITH " + RFM + " SELECT id_miembro, recency, frequency, monetary, r_score, 6 - f_score AS f_score, 6 - m_score AS m_score FROM scores",
    "rfm_segments": "WITH " + RFM + f" SELECT {SCORE_COLUMNS}, segmento_rfm FROM segments",
    "rfm_groups": "WITH " + RFM + f" SELECT {SCORE_COLUMNS}, segmento_rfm, grupo_valor FROM groups_",
    "agg_ventas_diarias": "WITH " + FACT + f" SELECT CAST(fec_venta AS VARCHAR) AS fec_venta, canal_venta, id_tienda, id_categ_n1, {sales_measures('transacciones')} FROM fact f LEFT JOIN {{mstr_articulos}} a ON f.art_id = a.art_id GROUP BY f.fec_venta, canal_venta, id_tienda, id_categ_n1",
    "agg_devoluciones_categoria": "WITH " + RETURNS_FACT + " " + RETURNS_MART,
    "kpi_ejecutivo_diario": "WITH " + FACT + " " + KPI.replace("{sales}", "fact"),
    "dq_results": "WITH " + RFM + """
        SELECT 'fact_ventas_pk_not_null' AS test_name, count(*) = 0 AS passed FROM {trans_ventas_raw} WHERE id_trans IS NULL
        UNION ALL SELECT 'ventas_no_negativas', count(*) = 0 FROM {trans_ventas_raw} WHERE qty_vendida * precio_unitario_venta - descuento_aplicado < 0
        UNION ALL SELECT 'fact_ventas_no_duplicates', (SELECT count(*) FROM {trans_ventas_raw}) = (SELECT count(*) FROM (SELECT DISTINCT * FROM {trans_ventas_raw}) t)
        UNION ALL SELECT 'stock_no_negativo', count(*) = 0 FROM {inv_stock_diario} WHERE stock_fisico < 0
        UNION ALL SELECT 'rfm_segmentado', count(*) = 0 FROM groups_ WHERE grupo_valor IS NULL""",
    "dq_duplicate_keys": "SELECT id_trans, count(*) AS copies FROM {trans_ventas_raw} GROUP BY id_trans HAVING count(*) > 1",
    "dq_duplicate_rows": "SELECT 'trans_ventas_no_duplicates' AS test_name, (SELECT count(*) FROM {trans_ventas_raw}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {trans_ventas_raw}) t) AS violations",
    "dq_negative_stock": (
        "SELECT id_snapshot, art_id, id_tienda, CAST(fec_snapshot AS VARCHAR) AS fec_snapshot, CAST(stock_fisico AS BIGINT) AS stock_fisico, "
        "CAST(stock_transito AS BIGINT) AS stock_transito, CAST(stock_reservado AS BIGINT) AS stock_reservado, CAST(stock_minimo_config AS BIGINT) AS stock_minimo_config, "
        "CAST(stock_maximo_config AS BIGINT) AS stock_maximo_config FROM {inv_stock_diario} WHERE stock_fisico < 0"),
    "write_roundtrip": f"SELECT {STORE} FROM {{mstr_tiendas}}",
    "write_partitioned": (
        "SELECT id_trans, canal_venta, CAST(CASE WHEN fec_trans >= TIMESTAMP '2001-01-01 00:00:00' THEN 2 * qty_vendida ELSE qty_vendida END AS BIGINT) AS qty_vendida, "
        "CAST(CAST(fec_trans AS DATE) AS VARCHAR) AS fec_venta FROM {trans_ventas}"),
    "cluster_zorder": "WITH " + FACT + " SELECT id_trans, canal_venta, art_id, id_tienda, CAST(net AS DOUBLE) / 10000 AS vr_venta_neto FROM fact",
    "catalog_roundtrip": "WITH " + RETURNS_FACT + " " + RETURNS_MART,
    "preview_rows": "WITH " + PRODUCT + f" SELECT {PRODUCT_COLUMNS} FROM product ORDER BY art_id LIMIT 10",
    "raw_to_kpi": "WITH " + SILVER_FACT + " " + KPI.replace("{sales}", "fact"),
    "end_to_end_kpi": "WITH " + SILVER_FACT + " " + KPI.replace("{sales}", "fact"),
    "end_to_end_rfm": "WITH " + SILVER_FACT + "," + metrics("fact") + "," + SCORES + f" SELECT {SCORE_COLUMNS}, segmento_rfm, grupo_valor FROM groups_",
    "stored_bytes": "SELECT count(*) AS rows, true AS bytes_match FROM {trans_ventas}",
    "scan_csv": f"SELECT {STOCK} FROM {{inv_stock_diario}} WHERE fec_snapshot > DATE '1999-06-30'",
    "dedup_null_keys": (
        f"SELECT {SALE} FROM (SELECT *, row_number() OVER (PARTITION BY art_id, id_trans ORDER BY {NEWEST}) AS place FROM {{trans_ventas_raw}} "
        f"WHERE art_id IS NOT NULL) t WHERE place = 1 UNION ALL SELECT DISTINCT {SALE} FROM {{trans_ventas_raw}} WHERE art_id IS NULL"),
    "ingest_overlap": (
        f"SELECT {SALE} FROM (SELECT *, row_number() OVER (PARTITION BY id_trans ORDER BY fec_trans > {AS_OF} DESC, {NEWEST.replace('fec_trans', 'art_id DESC, fec_trans')}) AS place "
        "FROM {trans_ventas}) t WHERE place = 1"),
    "skew_join_absent_key": (
        "SELECT id_devolucion, r.art_id, a.art_id AS articulo, desc_art FROM {post_devoluciones} r "
        "LEFT JOIN {mstr_articulos} a ON r.art_id = a.art_id AND a.art_id % 2 = 0"),
    "dim_productos_after_two_runs": "WITH " + PRODUCT + f" SELECT {PRODUCT_COLUMNS} FROM product",
    "stream_to_silver": f"SELECT DISTINCT {RETURN}, {AUDIT} FROM {{post_devoluciones}}",
    "ingest_text_types": (
        f"SELECT DISTINCT {SALE}, CAST(NULL AS VARCHAR) AS error_columns FROM {{trans_ventas}} WHERE id_trans % 101 <> 0 UNION ALL "
        "SELECT id_trans, " + ", ".join(f"NULL AS {c}" for c in SALE_NAMES[1:]) + ", 'fec_trans' AS error_columns FROM {trans_ventas} WHERE id_trans % 101 = 0"),
    "compact_small_files": (
        "SELECT count(*) AS rows, CAST(sum(qty_vendida) AS BIGINT) AS qty, CAST(sum(descuento_aplicado) AS DOUBLE) AS discount, true AS fewer, "
        "true AS none_above, true AS large_kept, CAST(0 AS BIGINT) AS rewritten_again FROM {trans_ventas}"),
    "cluster_skips_files": (
        "WITH " + RFM + ", found(table_name, column_name, rows) AS ("
        "SELECT 'fact_ventas', 'canal_venta', count(*) FROM fact WHERE canal_venta = 'Web' "
        "UNION ALL SELECT 'fact_ventas', 'art_id', count(*) FROM fact WHERE art_id = 77 "
        "UNION ALL SELECT 'fact_ventas', 'id_tienda', count(*) FROM fact WHERE id_tienda = 3 "
        "UNION ALL SELECT 'fact_inventario', 'art_id', count(*) FROM {inv_stock_diario} WHERE art_id = 77 "
        "UNION ALL SELECT 'fact_inventario', 'id_tienda', count(*) FROM {inv_stock_diario} WHERE id_tienda = 3 "
        "UNION ALL SELECT 'fact_rfm_clientes', 'grupo_valor', count(*) FROM groups_ WHERE grupo_valor = 'Champions') "
        "SELECT table_name, column_name, rows, true AS skips FROM found"),
    "silver_incremental": "WITH " + MERGED + f" SELECT {SALE}, error_reason FROM held",
    "kpi_changed_dates": "WITH " + MERGED_FACT + ", kpi AS (" + KPI.replace("{sales}", "fact") + ") "
        "SELECT *, fec_venta[:7] IN (SELECT m FROM moved) AS rewritten FROM kpi",
    "daily_sales_changed_dates": "WITH " + MERGED_FACT + ", daily AS (SELECT CAST(fec_venta AS VARCHAR) AS fec_venta, canal_venta, id_tienda, "
        f"CASE WHEN f.art_id = 77 AND a.art_id = 77 THEN 'MOVED' ELSE id_categ_n1 END AS id_categ_n1, {sales_measures('transacciones')} "
        "FROM fact f LEFT JOIN {mstr_articulos} a ON f.art_id = a.art_id "
        "GROUP BY f.fec_venta, canal_venta, id_tienda, CASE WHEN f.art_id = 77 AND a.art_id = 77 THEN 'MOVED' ELSE id_categ_n1 END) "
        "SELECT *, fec_venta[:7] IN (SELECT m FROM moved UNION ALL SELECT strftime(fec_trans, '%Y-%m') FROM fact WHERE art_id = 77) AS rewritten FROM daily",
    "quality_report_merged": "WITH " + MERGED + ", facts AS (SELECT count(*) FILTER (error_reason = 'NONE') AS total, "
        "count(*) FILTER (error_reason = 'NULL_MANDATORY_FIELD') AS rejected_records, count(*) FILTER (error_reason = 'INVALID_CUSTOMER_ID') AS fk_rejected FROM held), "
        "original AS (SELECT count(*) + count(*) FILTER (id_trans % 50 = 1) AS n FROM {trans_ventas_raw}), nulls AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM held WHERE error_reason = 'NONE'" for c in SALE_NAMES)
        + f") SELECT 'TRANS_VENTAS' AS table_name, column_name, null_count, {cents('null_count * 10000', 'total')} AS null_percentage, rejected_records, fk_rejected, "
        f"{cents('total * 10000', 'n')} AS conform_percentage, 'batch-2' AS batch_id FROM nulls, facts, original",
    "rules_merged": "WITH " + MERGED + " SELECT 'fact_ventas_pk_not_null' AS test_name, count(*) FILTER (id_trans IS NULL) AS violations FROM held WHERE error_reason = 'NONE' "
        "UNION ALL SELECT 'a_piece_at_least', count(*) FILTER (qty_vendida < 2) FROM held WHERE error_reason = 'NONE' "
        "UNION ALL SELECT 'fact_ventas_no_duplicates', 0",
    "overwrite_survives_failure": (
        "SELECT id_tienda, nom_tienda, tipo_tienda, id_ciudad, id_pais, metros_cuadrados, activo, CAST(fec_apertura AS VARCHAR) AS fec_apertura, "
        "r.read_by FROM {mstr_tiendas} JOIN (VALUES ('path'), ('name')) r(read_by) ON true"),
    "ingest_misfits_once": "SELECT id_trans, 'fec_trans' AS error_columns, 'batch-0' AS batch_id FROM {trans_ventas} WHERE id_trans % 101 = 0",
    "ingest_null_dates": (
        "SELECT id_trans, CASE WHEN id_trans % 103 <> 0 THEN CAST(fec_trans AS VARCHAR) END AS fec_trans, "
        f"CASE WHEN CASE WHEN id_trans % 103 = 0 THEN art_id % 2 = 0 ELSE fec_trans <= {SPLIT} END THEN 'batch-0' ELSE 'batch-1' END AS batch_id "
        "FROM {trans_ventas}"),
    "committed_thousand_batches": (
        "SELECT 'batch-' || lpad(CAST(id_trans % 1000 AS VARCHAR), 3, '0') AS batch_id, count(*) AS rows, CAST(sum(qty_vendida) AS BIGINT) AS qty "
        "FROM {trans_ventas} WHERE id_trans % 1000 % 3 <> 0 GROUP BY ALL"),
    "end_to_end_empty_table": "WITH " + SILVER_FACT + " " + KPI.replace("{sales}", "fact"),
    "end_to_end_missing_table": (
        "WITH " + SILVER_FACT + " SELECT table_name, (SELECT count(*) FROM (" + KPI.replace("{sales}", "fact") + ") k) AS kpi_rows FROM (VALUES "
        "('dim_clientes'), ('dim_productos'), ('fact_ventas'), ('fact_inventario'), ('rfm_metrics'), ('fact_rfm_clientes'), "
        "('agg_ventas_diarias'), ('kpi_ejecutivo_diario')) t(table_name)"),
}
for _name in ("fact_devoluciones", "fact_devoluciones_salted"):
    _SQL[_name] = "WITH " + RETURNS_FACT + (
        f" SELECT {RETURN}, id_categ_n1, id_proveedor, CAST(precio_unitario_venta AS DOUBLE) AS precio_unitario_venta, "
        "CAST(qty_vendida AS BIGINT) AS qty_vendida, motivo_desc, CAST(precio_unitario_venta AS DOUBLE) AS precio_original, "
        "CAST(tasa AS DOUBLE) / 100 AS tasa_devolucion FROM back")

ORACLE = {name: sql(body) for name, body in _SQL.items()}
