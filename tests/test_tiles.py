import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bodega.operators import tiles
from bodega.operators.tiles import TileOrder, ntile_distributed, values_at_ranks
from tests.conftest import rows

ORDERS = {"up": TileOrder("v"), "down": TileOrder("v", descending=True)}


def ntile_window(df, orders, key, k):
    """The plain form, all rows sorted in one task."""
    def sort(order):
        return F.desc(order.column) if order.descending else F.asc(order.column)
    return df.withColumns({name: F.ntile(k).over(Window.orderBy(sort(o), F.asc(key))) for name, o in orders.items()})


def frames():
    rng = random.Random(7)
    yield "distinct", [(i, rng.randrange(10**6)) for i in range(997)]
    yield "one value", [(i, 5) for i in range(101)]
    yield "third in one value", [(i, 1 if i % 3 == 0 else rng.randrange(50)) for i in range(500)]
    yield "nulls", [(i, None if i % 4 == 0 else rng.randrange(9)) for i in range(203)]
    yield "only nulls", [(i, None) for i in range(13)]
    yield "few rows", [(i, i) for i in range(3)]
    yield "one row", [(1, 1)]
    yield "large keys", [(2**62 + 7 * i, i % 3) for i in range(300)]
    yield "large values", [(2**53 + i, 2**60 + rng.randrange(40)) for i in range(300)]


CASES = [(name, data, 5) for name, data in frames()] + [
    (name, data, 7) for name, data in frames() if name in ("nulls", "third in one value", "few rows")]


@pytest.mark.parametrize("name,data,k", CASES, ids=[f"{n}-{k}" for n, _, k in CASES])
def test_distributed_equals_window(spark, tmp_path, name, data, k):
    path = str(tmp_path / "t")
    spark.createDataFrame(data, "id long, v long").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    assert rows(ntile_distributed(df, ORDERS, "id", k)) == rows(ntile_window(df, ORDERS, "id", k))


def test_decimals(spark, tmp_path):
    rng = random.Random(3)
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, rng.randrange(10**7)) for i in range(800)], "id long, c long").selectExpr(
        "id", "CAST(c / 100 AS DECIMAL(28,2)) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    assert rows(ntile_distributed(df, ORDERS, "id", 5)) == rows(ntile_window(df, ORDERS, "id", 5))


def test_tile_sizes_differ_by_one(spark):
    df = spark.range(1003).selectExpr("id", "id % 7 AS v")
    sizes = [r["count"] for r in ntile_distributed(df, ORDERS, "id", 5).groupBy("up").count().collect()]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1


def test_empty_table(spark):
    df = spark.range(0).selectExpr("id", "id AS v")
    assert ntile_distributed(df, ORDERS, "id", 5).count() == 0


def test_wrong_interval_is_noticed(spark, monkeypatch):
    """Exact even where the approximate quantiles are far off."""
    calls = []

    def misleading(df, ranks, sizes, slack):
        calls.append(slack)
        return {0: [(990, 995)]}

    monkeypatch.setattr(tiles, "_intervals", misleading)
    df = spark.range(1000).selectExpr("0 AS _group", "id AS _value")
    assert values_at_ranks(df, {0: [1, 500, 993]}, {0: 1000}) == {
        (0, 1): (0, 0, 1), (0, 500): (499, 499, 1), (0, 993): (992, 992, 1)}
    assert len(calls) >= 1


@pytest.mark.parametrize("name", ["distinct", "nulls", "third in one value", "large keys", "large values"])
def test_sketches_and_ranges(spark, tmp_path, monkeypatch, name):
    """The same tiles where every group is sketched and the histogram is cut into many ranges."""
    monkeypatch.setattr(tiles, "WHOLE_ROWS", 0)
    monkeypatch.setattr(tiles, "RANGE_ROWS", 7)
    path = str(tmp_path / "t")
    spark.createDataFrame(dict(frames())[name], "id long, v long").write.parquet(path)
    df = spark.read.parquet(path)
    assert rows(ntile_distributed(df, ORDERS, "id", 5)) == rows(ntile_window(df, ORDERS, "id", 5))


def test_running_rows_use_a_task_per_range(spark, monkeypatch):
    """Also where the histogram is the whole table, no window orders more than a range."""
    monkeypatch.setattr(tiles, "RANGE_ROWS", 50)
    histogram = spark.range(2**62, 2**62 + 1000).selectExpr(
        "CAST(id % 2 AS INT) AS _group", "1 AS _segment", "id AS v0", "id % 5 + 1 AS _rows")
    running = tiles.running_rows(histogram, ["_segment", "v0"])
    expected = histogram.withColumn("_to", F.sum("_rows").over(Window.partitionBy("_group").orderBy("v0")))
    assert rows(running.select("_group", "v0", "_to")) == rows(expected.select("_group", "v0", "_to"))
    plan = running._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range" in line for line in windows)
    inputs = {f.rsplit("/", 1)[0] for f in running.inputFiles()}
    assert sum(spark.read.parquet(p).select("_range").distinct().count() for p in inputs) >= 10
