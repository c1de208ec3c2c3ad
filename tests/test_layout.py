import datetime as dt

import pytest
from pyspark.sql import functions as F

from bodega.operators import layout as L
from checks.registry import sales_fact
from tests.conftest import rows

COLUMNS = ["canal_venta", "art_id", "id_tienda"]


def files_touched(df, column, value):
    """Files whose min/max range contains the value: those a reader could not skip."""
    ranges = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return ranges.where((F.col("a") <= F.lit(value)) & (F.col("b") >= F.lit(value))).count()


def test_clustering_skips_files_for_every_column(spark, sf_dir, tmp_path):
    sales = sales_fact(spark, sf_dir).select("id_trans", *COLUMNS).where("art_id IS NOT NULL")
    path, plain = str(tmp_path / "z"), str(tmp_path / "p")
    L.cluster(sales, COLUMNS, files=32).write.parquet(path)
    sales.repartition(32).write.parquet(plain)
    stored, unordered = spark.read.parquet(path), spark.read.parquet(plain)
    assert rows(stored) == rows(sales)
    for column, value in {"canal_venta": "Web", "art_id": 77, "id_tienda": 3}.items():
        assert files_touched(stored, column, value) < 0.7 * files_touched(unordered, column, value), column


def test_hot_cell_is_cut_into_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('g', id) END AS g")
    path = str(tmp_path / "one")
    L.cluster(df, ["g"], files=10).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 9 and max(sizes) < 4_000


def test_partition_columns_lead(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "date_add(DATE'2025-01-01', CAST(id % 8 AS INT)) AS d", "id % 50 AS a", "id % 7 AS b")
    path = str(tmp_path / "t")
    L.cluster(df, ["a", "b"], within=["d"], files=8).write.partitionBy("d").parquet(path)
    files = spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().count()
    assert files <= 16  # each task holds one or two dates, not all eight


@pytest.mark.parametrize("bits", [1, 3])
def test_interleave(spark, bits):
    df = spark.range(2**bits).crossJoin(spark.range(2**bits).withColumnRenamed("id", "y"))
    for x, y, z in df.select("id", "y", L.interleave([F.col("id"), F.col("y")], bits)).collect():
        expected = sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << 2 * b + 1) for b in range(bits))
        assert z == expected


def test_buckets_follow_the_order_of_text_and_dates(spark):
    df = spark.createDataFrame(
        [("Añil", dt.date(1969, 5, 1)), ("Azul", dt.date(1970, 1, 1)), ("", dt.date(2025, 1, 1)), (None, None), ("Zeta", dt.date(2030, 1, 1))],
        "s string, d date")
    got = [(r["d"], r["m"]) for r in df.select("d", L._as_value(df, "d").alias("m")).collect() if r["d"] is not None]
    assert [d for d, _ in sorted(got, key=lambda p: p[1])] == sorted(d for d, _ in got)
    bounds = L.range_bounds(df, ["s", "d"], bits=2)
    assert bounds["s"] == sorted(bounds["s"], key=str.encode) and set(bounds["s"]) <= {"Añil", "Azul", "", "Zeta"}
    bucket = df.select(L.range_bucket(F.col("d"), [dt.date(1970, 1, 1)]).alias("b"))
    assert [r["b"] for r in bucket.collect()] == [0, 0, 1, 0, 1]


def test_texts_that_share_a_long_prefix_are_told_apart(spark, tmp_path):
    df = spark.range(4000).selectExpr("concat('warehouse-', lpad(CAST(id * 7919 % 4000 AS STRING), 6, '0')) AS s", "id % 60 AS n")
    path = str(tmp_path / "t")
    L.cluster(df, ["s", "n"], files=16).write.parquet(path)
    stored = spark.read.parquet(path)
    assert files_touched(stored, "s", "warehouse-001234") <= 8
    assert L.bits_for(800_000, 3) == 8 and L.bits_for(8, 3) == L.BITS
