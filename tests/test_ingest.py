import datetime as dt

import pytest

from bodega.operators import ingest as I
from bodega.plans.bronze import NO_NEW_ROWS, BronzeRun, ingest_all, read_bronze, read_watermarks
from bodega.schemas import AUDIT_SCHEMA, STORED_PARTITIONS, TABLES
from bodega.sources.origins import FrameSource

T = "POST_DEVOLUCIONES"
DAYS = [dt.date(2025, 1, d) for d in (1, 2, 3)]


def returns(spark, ids_and_days):
    data = [(i, i, 1, 1, day, 1, "DAM", "Web", "Aprobada", None) for i, day in ids_and_days]
    return spark.createDataFrame(data, TABLES[T].schema)


def run(root, n, **options):
    return BronzeRun(str(root), batch_id=f"b{n}", run_ts=dt.datetime(2025, 2, n, tzinfo=dt.timezone.utc), **options)


def ingest(spark, root, n, df, **options):
    bronze = run(root, n, **options)
    return ingest_all(spark, FrameSource({T: df}), bronze, [T]).first(), bronze


def mark(spark, bronze):
    return {r["table_name"]: r["last_watermark"] for r in I.latest_watermarks(read_watermarks(spark, bronze)).collect()}


def test_two_runs_and_an_empty_one(spark, tmp_path):
    first = returns(spark, [(1, DAYS[0]), (2, DAYS[1])])
    log, bronze = ingest(spark, tmp_path, 1, first)
    assert (log["record_count"], log["status"], log["error_message"]) == (2, "SUCCESS", None)
    assert log["file_size_bytes"] > 0 and mark(spark, bronze) == {T: "2025-01-02"}

    both = first.unionByName(returns(spark, [(3, DAYS[2])]))
    log, bronze = ingest(spark, tmp_path, 2, both)
    assert log["record_count"] == 1 and mark(spark, bronze) == {T: "2025-01-03"}

    log, bronze = ingest(spark, tmp_path, 3, both)
    assert (log["record_count"], log["error_message"]) == (0, NO_NEW_ROWS)
    assert mark(spark, bronze) == {T: "2025-01-03"}

    stored = read_bronze(spark, bronze, T)
    assert sorted((r["id_devolucion"], r["batch_id"], r["month"], r["day"]) for r in stored.collect()) == [
        (1, "b1", "02", "01"), (2, "b1", "02", "01"), (3, "b2", "02", "02")]
    assert spark.read.parquet(bronze.log_path).count() == 3


def test_batch_without_watermark_is_not_seen(spark, tmp_path):
    """A run that died between data and watermark: its rows come again and count once."""
    df = returns(spark, [(1, DAYS[0])])
    lost = I.add_audit_columns(df, "s", "dead", dt.datetime(2025, 2, 1))
    lost.write.partitionBy(*STORED_PARTITIONS).parquet(run(tmp_path, 1).table_path(T))
    log, bronze = ingest(spark, tmp_path, 2, df)
    assert log["record_count"] == 1
    stored = read_bronze(spark, bronze, T)
    assert stored.count() == 2
    assert I.committed_rows(stored, read_watermarks(spark, bronze), T).count() == 1
    assert I.committed_rows(stored, read_watermarks(spark, bronze), "OTHER").count() == 0


def test_cap_keeps_watermark_out_of_the_future(spark, tmp_path):
    df = returns(spark, [(1, DAYS[0]), (2, dt.date(2026, 1, 1))])
    _, bronze = ingest(spark, tmp_path, 1, df, max_date="2025-01-31")
    assert mark(spark, bronze) == {T: "2025-01-31"}
    log, _ = ingest(spark, tmp_path, 2, df.unionByName(returns(spark, [(3, dt.date(2025, 2, 1))])), max_date="2025-02-28")
    assert log["record_count"] == 2  # the new row, and the future one again


def test_late_rows_need_inclusive(spark):
    df = returns(spark, [(1, DAYS[0]), (2, DAYS[1])])
    assert I.rows_after(df, "fec_devolucion", "2025-01-02").count() == 0
    assert I.rows_after(df, "fec_devolucion", "2025-01-02", inclusive=True).count() == 1
    assert I.rows_after(df, "fec_devolucion", None).count() == 2


def test_comparison_is_typed(spark):
    df = spark.createDataFrame([(9,), (10,), (100,)], "n int")
    assert I.rows_after(df, "n", "10").count() == 1  # as text '9' would be above '10'


def test_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    plan = I.rows_after(df, "l_shipdate", "2000-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_shipdate,2000-01-01" in plan


def test_failing_table_does_not_stop_others(spark, tmp_path):
    source = FrameSource({T: returns(spark, [(1, DAYS[0])])})
    log = {r["table_name"]: r for r in ingest_all(spark, source, run(tmp_path, 1), ["TRANS_VENTAS", T]).collect()}
    assert log["TRANS_VENTAS"]["status"] == "FAILED" and "TRANS_VENTAS" in log["TRANS_VENTAS"]["error_message"]
    assert log[T]["status"] == "SUCCESS"


def test_audit_columns(spark):
    df = I.add_audit_columns(spark.range(1), "s", "b", dt.datetime(2025, 3, 4, 5, 6))
    assert [f.name for f in df.schema][1:] == [f.name for f in AUDIT_SCHEMA]
    row = df.first()
    assert (row["year"], row["month"], row["day"], row["batch_id"]) == ("2025", "03", "04", "b")


def test_batch_watermark(spark):
    df = returns(spark, [(1, DAYS[0]), (2, DAYS[2])])
    assert tuple(I.batch_watermark(df, "fec_devolucion").first()) == (2, "2025-01-03")
    assert tuple(I.batch_watermark(df, "fec_devolucion", cap="2025-01-02").first()) == (2, "2025-01-02")


def test_store_is_created_empty(spark, tmp_path):
    assert read_watermarks(spark, run(tmp_path / "new", 1)).count() == 0


@pytest.mark.parametrize("table", list(TABLES))
def test_specs_are_consistent(table):
    spec = TABLES[table]
    names = spec.schema.names
    assert spec.key in names and set(spec.mandatory) <= set(names)
    assert spec.incremental is None or spec.incremental in names
    assert set(spec.hashed) | set(spec.defaults) <= set(names)
