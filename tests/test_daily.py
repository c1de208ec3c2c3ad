"""Fact, marts and quality counts kept up to date by what changed, against the same computed from everything."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bodega.operators import marts, model
from bodega.operators.quality import check_no_duplicates, check_rules, duplicate_rows, in_range, not_null, quality_report
from bodega.plans import daily as D
from bodega.plans import incremental as N
from bodega.plans.bronze import BronzeRun, ingest_all
from bodega.plans.quality_state import QualityState, _copies, measure_new, merged_report, merged_rules
from bodega.schemas import TABLES
from bodega.sources.origins import FrameSource
from tests.conftest import rows

SALES, MEMBERS = D.SALES, D.MEMBERS


def frame(spark, table, data):
    schema = TABLES[table].schema
    return spark.createDataFrame([[row.get(c) for c in schema.names] for row in data], schema)


def sale(i, day, art=1, qty=3):
    when = dt.datetime.fromisoformat(day) if day else None
    return {"id_trans": i, "id_miembro": i % 5, "id_tienda": 1, "art_id": art, "fec_trans": when, "qty_vendida": qty, "canal_venta": "Web"}


def run_silver(spark, root, n, sales):
    bronze = BronzeRun(f"{root}/bronze", batch_id=f"b{n}", run_ts=dt.datetime(2024, 1, 1 + n, tzinfo=dt.timezone.utc))
    people = [{"id_miembro": i, "fec_ultima_compra": dt.date(2024, 1, 1 + n)} for i in range(4)]  # member 4 is unknown
    ingest_all(spark, FrameSource({SALES: frame(spark, SALES, sales), MEMBERS: frame(spark, MEMBERS, people)}), bronze, [MEMBERS, SALES])
    silver = N.IncrementalSilver(f"{root}/silver", bronze, buckets=3)
    N.conform_all_new(spark, silver, [MEMBERS, SALES])
    return silver


RUNS = [
    [sale(i, f"2024-01-{1 + i % 9:02d}", art=i % 3) for i in range(30)] + [sale(41, None), sale(42, "2024-02-01"), sale(43, "2024-02-02", art=None)],
    [sale(42, "2024-03-05", qty=9), sale(0, "2024-03-05"), sale(44, "2024-03-06", art=None)],  # 1 February loses its only sale
]


@pytest.mark.parametrize("few", [0, 10**9])
def test_changed_dates_equal_a_full_recompute(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(D, "FEW", few)  # moved sales looked up by id, or their buckets taken anew
    products = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "art_id long, id_categ_n1 string")
    for n, sales in enumerate(RUNS):
        run = D.DailyGold(f"{tmp_path}/gold", run_silver(spark, tmp_path, n, sales))
        done = D.refresh_daily(spark, run, products)
        fact = model.fact_sales(N.read_accepted(spark, run.silver, SALES).drop("error_reason"), N.read_accepted(spark, run.silver, MEMBERS))
        for table, expected in ((D.FACT, fact), (D.KPIS, marts.executive_kpis(fact)), (D.BY_CATEGORY, marts.daily_sales(fact, products))):
            assert rows(D.read_daily(spark, run, table).select(expected.columns)) == rows(expected), (n, table)
    assert done["periods"] == ["2024-01-01", "2024-02-01", "2024-03-05"] == done["category_periods"]
    assert None in D.read_ledger(spark, run).where("run = 1").first()["periods"]

    ledger = D.read_ledger(spark, run).count()
    again = D.refresh_daily(spark, run, products)
    assert again["periods"] == [] and D.read_ledger(spark, run).count() == ledger

    other = products.withColumn("id_categ_n1", F.coalesce("id_categ_n1", F.lit("c")))
    moved = D.refresh_daily(spark, run, other)
    sold = {str(r[0]) for r in fact.where("art_id = 2").select("fec_venta").distinct().collect()}
    assert moved["periods"] == [] and set(moved["category_periods"]) == sold
    assert rows(D.read_daily(spark, run, D.BY_CATEGORY).drop(D.PERIOD)) == rows(
        marts.daily_sales(fact, other).select([c for c in D.read_daily(spark, run, D.BY_CATEGORY).columns if c != D.PERIOD]))


def test_rows_that_stay_are_not_shuffled(spark, tmp_path, monkeypatch):
    products = spark.createDataFrame([(0, "a")], "art_id long, id_categ_n1 string")
    plans, write = {}, D.write_table

    def look(df, path, *args, **options):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, path, *args, **options)

    for n, sales in enumerate(RUNS):
        run = D.DailyGold(f"{tmp_path}/gold", run_silver(spark, tmp_path, n, sales))
        monkeypatch.setattr(D, "write_table", look)
        D.refresh_daily(spark, run, products)
    lines = plans[D.FACT].splitlines()
    union = next(i for i, line in enumerate(lines) if "Union" in line)
    assert not any("Rebalance" in line for line in lines[:union]) and any("Rebalance" in line for line in lines[union:])
    assert "distinct" not in plans[D.KPIS] and "id_trans" not in plans[D.KPIS].split("Aggregate")[1].split("AS ventas_netas")[0]


def test_copies_are_found_by_their_hashes(spark):
    held = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None), (None, None)], "n int, t string")
    assert rows(_copies(held)) == rows(duplicate_rows(held)) == [(1, "a", 2), (None, None, 3)]


def test_merged_counts_equal_a_full_scan(spark, tmp_path):
    checks = [not_null("keyed", "id_trans"), in_range("few", "qty_vendida", high=8)]
    for n, sales in enumerate(RUNS):
        silver = run_silver(spark, tmp_path, n, sales)
        state = QualityState(f"{tmp_path}/quality", silver, {SALES: checks}, {SALES: "single"})
        before = dict(N.current_buckets(spark, silver, SALES)) if n else {}
        new = measure_new(spark, state, SALES)
        touched = N.read_ledger(spark, silver).where(F.col("table_name") == SALES).orderBy(F.desc("version")).first()["touched"]
        assert sorted(new) == sorted(touched) and (not n or before.items() >= new.items())
        assert measure_new(spark, state, SALES) == {}
        current = N.read_current(spark, silver, SALES)
        read = sum(len(s) for s in RUNS[:n + 1])
        assert rows(merged_report(spark, state, SALES, "b")) == rows(quality_report(current, SALES, read, "b"))
        held = N.read_accepted(spark, silver, SALES)
        full = check_rules(held, checks).unionByName(check_no_duplicates(held, "single"))
        assert rows(merged_rules(spark, state, SALES)) == rows(full)
