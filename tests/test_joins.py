from collections import Counter

import pytest

from bodega.operators.joins import TASK_ROWS, heavy_keys, salts_of, skew_join


def brute_force(left, right):
    out = []
    for k, v in left:
        partners = [w for q, w in right if q is not None and q == k]
        out += [(k, v, k, w) for w in partners] or [(k, v, None, None)]
    return Counter(out)


LEFT = [(1, i) for i in range(30)] + [(2, i) for i in range(5)] + [(None, i) for i in range(7)] + [(3, 0), (8, 1), (9, 9)]
RIGHT = [(1, i) for i in range(20)] + [(2, 0), (2, 0), (4, 4), (None, 1)] + [(5, i) for i in range(10)]


@pytest.mark.parametrize("hot_left", [[], [1], [1, 8], [77]])
@pytest.mark.parametrize("hot_right", [[], [1], [1, 2, 5], [8, 77, 1]])  # the right side has no 8
def test_same_rows_as_plain_left_join(spark, hot_left, hot_right):
    left = spark.createDataFrame(LEFT, "k long, v long")
    right = spark.createDataFrame(RIGHT, "q long, w long")
    joined = skew_join(left, right, "k", "q", dict.fromkeys(hot_left, 4 * TASK_ROWS), dict.fromkeys(hot_right, 4 * TASK_ROWS))
    assert joined.columns == ["k", "v", "q", "w"]
    assert Counter(tuple(r) for r in joined.collect()) == brute_force(LEFT, RIGHT)


def test_hot_rows_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(8000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "id AS v")
        right = spark.range(8000).selectExpr("id AS q")
        joined = skew_join(left, right, "k", "q", hot_left={1: 64 * TASK_ROWS})
        assert joined.where("k = 1").count() == 2668  # every third row, and id 1 itself
        parts = joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
        counts = [r["count"] for r in parts]
        assert len(counts) == 4 and max(counts) < 1.5 * min(counts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_heavy_keys(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN NULL ELSE id END AS k")
    assert heavy_keys(df, "k", share=0.2) == {-1: 1000}
    assert heavy_keys(df.where("k > 0"), "k", share=0.2) == {}
    assert heavy_keys(df.limit(0), "k") == {}


def test_salts_follow_the_rows():
    assert [salts_of(n) for n in (0, TASK_ROWS, 2 * TASK_ROWS + 1, 10**12)] == [2, 2, 3, 10**12 // TASK_ROWS]
