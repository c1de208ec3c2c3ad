import datetime as dt
from decimal import Decimal

import pytest

from bodega.operators import marts, model, rfm
from bodega.schemas import TABLES
from checks.fixtures import view
from checks.registry import known_sales, products, sales_fact
from tests.conftest import rows


def sale(spark, *data):
    return spark.createDataFrame(list(data), TABLES["TRANS_VENTAS"].schema)


def one_sale(i=1, member=1, qty=2, price="10.00", discount="0.5000", day=1):
    return (i, member, 1, 1, dt.datetime(2025, 1, day, 8), "08:00:00", qty, Decimal(price), Decimal(discount), "PSE", "Web")


def test_fact_sales_measures(spark):
    members = spark.createDataFrame([(1,), (1,)], "id_miembro long")
    got = model.fact_sales(sale(spark, one_sale(), one_sale(2, 9, discount="0.0000"), one_sale(3, None)), members)
    found = {r["id_trans"]: r for r in got.collect()}
    assert len(found) == got.count() == 3  # a member stored twice does not double the sale
    assert found[1]["vr_venta_neto"] == Decimal("19.5000") and found[1]["venta_descuento_flag"] == 1
    assert (found[1]["cliente_validado"], found[1]["cliente_anonimo_flag"]) == (1, 0)
    assert (found[2]["cliente_validado"], found[2]["cliente_anonimo_flag"], found[2]["venta_descuento_flag"]) == (None, 1, 0)
    assert found[3]["cliente_anonimo_flag"] == 1 and found[3]["fec_venta"] == dt.date(2025, 1, 1)


def test_store_types_and_zones(spark):
    df = spark.createDataFrame(
        [("Hipermercado", "Ecuador"), ("super hiper", "COLOMBIA"), ("Supermercado", "Peru"), ("Conveniencia", None), (None, "x")],
        "tipo_tienda string, id_pais string")
    got = [tuple(r)[2:] for r in model.dim_stores(df).collect()]
    assert got == [("HIPERMERCADO", "NORTE"), ("HIPERMERCADO", "SUR"), ("SUPERMERCADO", "CENTRO"), ("OTROS", "CENTRO"), ("OTROS", "CENTRO")]


def test_customers(spark):
    df = spark.createDataFrame([("M", None, True, dt.date(2025, 1, 1)), ("x", "60+", None, None)],
                               "genero string, rango_edad string, activo boolean, fec_registro date")
    got = model.dim_customers(df, "2025-01-31").collect()
    assert (got[0]["genero_std"], got[0]["rango_edad"], got[0]["cliente_activo_flag"], got[0]["antiguedad_dias"]) == ("M", "26-35", 1, 30)
    assert (got[1]["genero_std"], got[1]["rango_edad"], got[1]["cliente_activo_flag"], got[1]["antiguedad_dias"]) == ("NO INFORMADO", "60+", 0, None)


def test_inventory_is_guarded(spark):
    stock = spark.createDataFrame([(1, 1, 140, 10), (2, 1, 0, 10), (3, 2, -10, 10), (4, 9, 140, 200)],
                                  "id_snapshot long, art_id long, stock_fisico int, stock_minimo_config int")
    lead = spark.createDataFrame([(1, 20), (1, 30), (2, 5)], "art_id long, tiempo_repo_dias int")
    got = {r["id_snapshot"]: r for r in model.fact_inventory(stock, lead).collect()}
    assert len(got) == 4
    assert (got[1]["promedio_consumo_14dias"], got[1]["cobertura_dias"], got[1]["alerta_quiebre"], got[1]["tiempo_repo_dias"]) == (10.0, 14.0, 1, 20)
    assert (got[2]["cobertura_dias"], got[2]["alerta_quiebre"]) == (0.0, 0)
    assert (got[3]["promedio_consumo_14dias"], got[3]["cobertura_dias"], got[3]["alerta_quiebre"]) == (-0.71, 0.0, 0)
    assert (got[4]["tiempo_repo_dias"], got[4]["alerta_quiebre"], got[4]["diferencia_stock_min"]) == (None, 0, -60)


def test_returns_fan_out_and_reasons(spark):
    back = spark.createDataFrame(
        [(1, 10, 1, 1, dt.date(2025, 1, 1), 1, "DAM", "Web", "Aprobada", None), (2, 99, 1, 1, dt.date(2025, 1, 1), 1, "zz", "Web", "Aprobada", None)],
        TABLES["POST_DEVOLUCIONES"].schema)
    sold = spark.createDataFrame([(10, 3, Decimal("5.00")), (10, 0, Decimal("6.00"))], "id_trans long, qty_vendida int, precio_unitario_venta decimal(12,2)")
    prods = spark.createDataFrame([(1, "A", 7), (1, "B", 8)], "art_id long, id_categ_n1 string, id_proveedor long")
    got = model.fact_returns(back, sold, prods)
    assert rows(got.select("id_devolucion", "motivo_desc", "tasa_devolucion", "id_categ_n1")) == [
        (1, "Producto Dañado", 0.0, "A"), (1, "Producto Dañado", 33.33, "A"), (2, "Otros", 0.0, "A")]
    other = model.fact_returns(back, sold, prods, reasons={"zz": "Otra causa"})
    assert {r["motivo_desc"] for r in other.collect()} == {"Otros", "Otra causa"}


def test_marts_agree(spark, sf_dir):
    sales = sales_fact(spark, sf_dir)
    total = lambda df: df.agg({"ventas_netas": "sum"}).first()[0]
    daily, kpi = total(marts.daily_sales(sales, products(spark, sf_dir))), total(marts.executive_kpis(sales))
    exact = sales.agg({"vr_venta_neto": "sum"}).first()[0]
    # each group is rounded to two digits
    assert abs(daily - exact) < 100 and abs(kpi - exact) < 100


def test_hot_articles_give_the_same_mart(spark, sf_dir):
    sales, prods = sales_fact(spark, sf_dir), products(spark, sf_dir)
    assert rows(marts.daily_sales(sales, prods)) == rows(marts.daily_sales(sales, prods, hot_articles=[1, 2, 3]))


def test_future_sales_rank_as_most_recent(spark):
    members = spark.createDataFrame([(1,), (2,)], "id_miembro long")
    fact = model.fact_sales(sale(spark, one_sale(1, 1, day=31), one_sale(2, 2, day=5)), members)
    got = {r["id_miembro"]: r["recency"] for r in rfm.rfm_metrics(fact, "2025-01-10").collect()}
    assert got == {1: -21, 2: 5}


@pytest.mark.parametrize("days,active", [(90, 180), (400, 30), (5, 5), (0, 0)])
def test_metrics_equal_the_step_by_step_form(spark, sf_dir, days, active):
    sales, as_of = known_sales(spark, sf_dir), "2001-08-01"
    from pyspark.sql import functions as F
    alive = sales.groupBy("id_miembro").agg(F.max("fec_venta").alias("d")).where(F.datediff(F.lit(as_of).cast("date"), "d") <= active)
    window = rfm.restrict_to(sales.where(F.col("fec_venta") >= F.date_sub(F.lit(as_of).cast("date"), days)), alive)
    stepwise = window.groupBy("id_miembro").agg(
        F.datediff(F.lit(as_of).cast("date"), F.max("fec_venta")).alias("recency"),
        F.count_distinct("id_trans").alias("frequency"), F.round(F.sum("vr_venta_neto"), 2).alias("monetary"))
    assert rows(rfm.rfm_metrics(sales, as_of, days, active)) == rows(stepwise)


def test_scores_order(spark):
    metrics = spark.createDataFrame([(i, i, 10 - i, Decimal(100 - i)) for i in range(5)],
                                    "id_miembro long, recency int, frequency long, monetary decimal(12,2)")
    best = rfm.rfm_groups(rfm.rfm_scores(metrics)).where("id_miembro = 0").first()
    assert (best["r_score"], best["f_score"], best["m_score"], best["grupo_valor"]) == (5, 1, 1, "Clientes Recientes")
    best = rfm.rfm_groups(rfm.rfm_scores(metrics, order="best_is_5")).where("id_miembro = 0").first()
    assert (best["r_score"], best["f_score"], best["m_score"], best["grupo_valor"]) == (5, 5, 5, "Champions")
    with pytest.raises(ValueError):
        rfm.rfm_scores(metrics, order="other")
