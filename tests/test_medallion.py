"""Bronze to gold twice, the second time with one more batch."""

import datetime as dt

import pytest

from bodega.operators import conform as C
from bodega.plans.bronze import BronzeRun
from bodega.plans.full_run import StageFailed, run_medallion
from bodega.plans.gold import CLUSTERED, GoldBuilder, GoldRun, read_gold
from bodega.plans.silver import SilverRun, read_rejects, read_silver
from bodega.schemas import NULL_REASON, TABLES
from bodega.sources.origins import FrameSource
from checks.fixtures import view
from tests.conftest import rows

AS_OF = "2001-08-01"


def frames(spark, sf_dir):
    # half a year keeps the number of date partitions small
    recent = "fec_trans >= TIMESTAMP_NTZ'2001-04-01 00:00:00'"
    data = {name: view(spark, sf_dir, name.lower()) for name in TABLES}
    data["TRANS_VENTAS"] = view(spark, sf_dir, "trans_ventas_raw").where(recent)
    return data


def run(spark, data, root, n, **options):
    return run_medallion(spark, FrameSource(data), str(root), AS_OF, batch_id=f"b{n}",
                         run_ts=dt.datetime(2001, 8, n, tzinfo=dt.timezone.utc), **options)


def test_two_runs(spark, sf_dir, tmp_path):
    data = frames(spark, sf_dir)
    sales = data["TRANS_VENTAS"]
    early = "fec_trans <= TIMESTAMP_NTZ'2001-07-15 00:00:00'"
    first = run(spark, {**data, "TRANS_VENTAS": sales.where(early)}, tmp_path, 1, catalog="twice")
    assert {r["status"] for r in first.log} == {"SUCCESS"}
    counts = {r["table_name"]: r for r in first.summaries}
    trans = counts["TRANS_VENTAS"]
    assert trans["original_count"] == sales.where(early).count()
    assert trans["final_count"] + trans["rejected_count"] + trans["fk_rejected_count"] == trans["dedup_count"]
    rules = {r["test_name"]: r["passed"] for r in first.rules}
    assert rules == {"fact_ventas_pk_not_null": True, "ventas_no_negativas": True, "fact_ventas_no_duplicates": True,
                     "stock_no_negativo": False, "rfm_segmentado": True}

    second = run(spark, data, tmp_path, 2, catalog="twice")
    loaded = {r["table_name"]: r["record_count"] for r in second.log}
    assert loaded["TRANS_VENTAS"] == sales.where(f"NOT ({early})").count() > 0
    assert loaded["MSTR_ARTICULOS"] == 0 and loaded["MSTR_PROVEEDORES"] > 0  # suppliers are always read in full

    silver = second.gold.silver
    expected = C.accepted(C.conform(sales, TABLES["TRANS_VENTAS"], data["CRM_MIEMBROS"])).count()
    assert read_silver(spark, silver, "TRANS_VENTAS").count() == expected
    assert {r[0] for r in read_rejects(spark, silver, "TRANS_VENTAS").select("error_reason").distinct().collect()} == {
        NULL_REASON, "INVALID_CUSTOMER_ID"}
    assert "id_ciudad" not in read_silver(spark, silver, "CRM_MIEMBROS").columns
    fact = read_gold(spark, second.gold, "fact_ventas")
    assert fact.count() == expected
    kpi, daily = read_gold(spark, second.gold, "kpi_ejecutivo_diario"), read_gold(spark, second.gold, "agg_ventas_diarias")
    assert kpi.agg({"ventas_netas": "sum"}).first()[0] > 0
    assert abs(kpi.agg({"ventas_netas": "sum"}).first()[0] - daily.agg({"ventas_netas": "sum"}).first()[0]) < 20
    for name in (*CLUSTERED, "dim_clientes", "dim_tiendas", "dim_productos", "fact_devoluciones", "agg_devoluciones_categoria"):
        assert spark.table(f"twice_gold.{name}").count() == read_gold(spark, second.gold, name).count() > 0
    assert spark.table("twice_silver.dim_clientes").count() > 0
    # with no table small enough to broadcast, the salted joins give the same gold tables
    salted = GoldRun(f"{tmp_path}/gold-salted", silver, AS_OF, broadcast_bytes=0)
    builder = GoldBuilder(spark, salted)
    for step in (builder.dimensions, builder.facts, builder.marts):
        step()
    for name in ("fact_inventario", "fact_devoluciones", "agg_ventas_diarias", "kpi_ejecutivo_diario"):
        assert rows(read_gold(spark, salted, name)) == rows(read_gold(spark, second.gold, name)), name
    reports = spark.read.parquet(silver.quality_path)
    assert {r[0] for r in reports.select("batch_id").distinct().collect()} == {"b1", "b2"}


def test_strict_run_stops_after_bronze(spark, sf_dir, tmp_path):
    data = {name: df for name, df in frames(spark, sf_dir).items() if name != "MSTR_TIENDAS"}
    with pytest.raises(StageFailed, match="MSTR_TIENDAS"):
        run(spark, data, tmp_path, 1, strict=True)


def test_newest_per_key_option(spark, tmp_path):
    from bodega.plans.bronze import ingest_all
    from bodega.plans.silver import conform_table
    schema = TABLES["MSTR_PROVEEDORES"].schema
    for n, name in ((1, "old"), (2, "new")):
        df = spark.createDataFrame([(1, name, "x", 3, 1.0, True)], schema)
        bronze = BronzeRun(f"{tmp_path}/bronze", batch_id=f"b{n}", run_ts=dt.datetime(2025, 1, n, tzinfo=dt.timezone.utc))
        ingest_all(spark, FrameSource({"MSTR_PROVEEDORES": df}), bronze, ["MSTR_PROVEEDORES"])
    for newest, names in ((False, ["new", "old"]), (True, ["new"])):
        silver = SilverRun(f"{tmp_path}/silver-{newest}", bronze, newest_per_key=newest)
        conform_table(spark, silver, "MSTR_PROVEEDORES")
        assert sorted(r["razon_social"] for r in read_silver(spark, silver, "MSTR_PROVEEDORES").collect()) == names


def test_hot_customers_are_salted_when_the_parent_is_large(spark, sf_dir, tmp_path):
    """With a broadcast limit of zero the run takes the salted joins; same rows."""
    from bodega.plans.bronze import ingest_all
    from bodega.plans.silver import conform_table
    data = frames(spark, sf_dir)
    bronze = BronzeRun(f"{tmp_path}/bronze", batch_id="b1", run_ts=dt.datetime(2001, 8, 1, tzinfo=dt.timezone.utc))
    ingest_all(spark, FrameSource(data), bronze, ["CRM_MIEMBROS", "TRANS_VENTAS"])
    found = []
    for limit in (0, 1 << 30):
        silver = SilverRun(f"{tmp_path}/silver-{limit}", bronze, broadcast_bytes=limit)
        for table in ("CRM_MIEMBROS", "TRANS_VENTAS"):
            _, summary = conform_table(spark, silver, table)
        found.append(tuple(summary.first()))
    assert found[0] == found[1]
