"""Physical plans: what is read, shuffled and windowed."""

import re

from pyspark.sql import functions as F

from bodega import session
from bodega.operators import marts, model, quality, rfm
from bodega.plans.gold import GoldBuilder
from bodega.sources import tables
from checks import registry
from checks.fixtures import view
from checks.registry import known_sales, products, sales_fact


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_sales(spark, sf_dir, tmp_path):
    months = sales_fact(spark, sf_dir).withColumn("fec_venta", F.trunc("fec_venta", "month"))
    tables.write_table(months, str(tmp_path / "sales"), partition_by=["fec_venta"], rebalance=True)
    return spark.read.schema(months.schema).parquet(str(tmp_path / "sales"))


def test_window_prunes_date_partitions(spark, sf_dir, tmp_path):
    sales = stored_sales(spark, sf_dir, tmp_path)
    for df in (rfm.rfm_metrics(sales, "2001-08-01"), rfm.active_customers(sales, "2001-08-01")):
        text = plan(df)
        assert re.search(r"PartitionFilters: \[[^]]*fec_venta[^]]*>= 2001-0[25]", text), text
        assert "vr_venta_neto" not in plan(rfm.active_customers(sales, "2001-08-01"))


def test_metrics_need_no_join(spark, sf_dir, tmp_path):
    text = plan(rfm.rfm_metrics(stored_sales(spark, sf_dir, tmp_path), "2001-08-01"))
    assert "Join" not in text and text.count("FileScan") == 1


def test_distinct_counts_spread_hot_groups(spark, sf_dir):
    """The first shuffle of each mart includes the transaction id, so no group is one task."""
    for df in (marts.executive_kpis(sales_fact(spark, sf_dir)), marts.daily_sales(sales_fact(spark, sf_dir), products(spark, sf_dir)),
               rfm.rfm_metrics(known_sales(spark, sf_dir), "2001-08-01")):
        assert re.search(r"hashpartitioning\([^)]*id_trans", plan(df))


def test_kpis_read_only_their_columns(spark, sf_dir):
    text = plan(marts.executive_kpis(sales_fact(spark, sf_dir)))
    assert "l_partkey" not in text and "c_custkey" not in text  # unused customer join is removed


def test_distributed_tiles_have_no_global_window(spark, sf_dir):
    metrics = rfm.rfm_metrics(known_sales(spark, sf_dir), "2001-08-01")
    text = plan(rfm.rfm_scores(metrics))
    assert "Window" not in text and "Exchange" not in text


def test_no_cross_joins_in_facts(spark, sf_dir):
    facts = [
        model.fact_inventory(view(spark, sf_dir, "inv_stock_diario"), products(spark, sf_dir)),
        model.fact_returns(view(spark, sf_dir, "post_devoluciones"), sales_fact(spark, sf_dir), products(spark, sf_dir), hot_sales={1: 10}, hot_returns={1: 10}),
    ]
    for df in facts:
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_rules_count_copies_and_violations_exactly(spark, sf_dir):
    raw = view(spark, sf_dir, "trans_ventas_raw")
    rules = [quality.not_null("article", "art_id"), quality.in_range("quantity", "qty_vendida", low=10)]
    got = {r["test_name"]: r["violations"] for r in quality.check_table(raw, rules, "copies").collect()}
    assert got == {"article": raw.where("art_id IS NULL").count(), "quantity": raw.where("qty_vendida < 10").count(),
                   "copies": raw.count() - raw.distinct().count()}
    assert quality.check_no_duplicates(raw.distinct(), "t").first()["violations"] == 0


def test_returns_shuffle_only_returned_sales(spark, sf_dir):
    text = plan(model.fact_returns(view(spark, sf_dir, "post_devoluciones"), sales_fact(spark, sf_dir), products(spark, sf_dir)))
    assert "LeftSemi" in text


def test_builder_lists_a_table_once(spark, tmp_path):
    from bodega.plans.bronze import BronzeRun
    from bodega.plans.gold import GoldRun
    from bodega.plans.silver import SilverRun
    builder = GoldBuilder(spark, GoldRun(str(tmp_path), SilverRun(str(tmp_path), BronzeRun(str(tmp_path)))))
    builder._write("dim_tiendas", spark.range(3), str(tmp_path))
    assert builder._built("dim_tiendas") is builder._built("dim_tiendas")


def test_partitions_of_rejects_and_rules_follow_the_input(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
    write, rules = registry.S.write_table, registry.gold_rules
    def look(call):
        return lambda *a, **k: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or call(*a, **k)
    monkeypatch.setattr(registry.S, "write_table", look(write))
    monkeypatch.setattr(registry, "gold_rules", look(rules))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert registry.QUERIES["quarantine_union"](spark, sf_dir).count() > 0
    assert registry.QUERIES["dq_results"](spark, sf_dir).count() == 5
    assert len(seen) == 2 and min(seen) > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_the_plain_layout_is_not_shuffled(spark, sf_dir, monkeypatch):
    plans, write = {}, registry.S.write_table
    def look(df, path, *args, **options):
        plans.setdefault(path.rsplit("/", 1)[-1].split("-")[0], []).append(plan(df))
        write(df, path, *args, **options)
    monkeypatch.setattr(registry.S, "write_table", look)
    assert all(r["skips"] for r in registry.QUERIES["cluster_skips_files"](spark, sf_dir).collect())
    assert len(plans["plain"]) == 3 and not any("Exchange" in p for p in plans["plain"]) and all("Exchange" in p for p in plans["clustered"])
