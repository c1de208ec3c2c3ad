from bodega.operators import quality as Q
from tests.conftest import rows


def tagged(spark):
    return spark.createDataFrame(
        [(1, None, "NONE"), (2, "x", "NONE"), (3, "x", "NONE"), (None, "y", "NULL_MANDATORY_FIELD"), (5, None, "INVALID_CUSTOMER_ID")],
        "id long, v string, error_reason string")


def test_quality_report(spark):
    report = {r["column_name"]: r for r in Q.quality_report(tagged(spark), "T", 8, "b").collect()}
    assert set(report) == {"id", "v"}
    assert (report["v"]["null_count"], report["v"]["null_percentage"]) == (1, 33.33)
    assert (report["id"]["rejected_records"], report["id"]["fk_rejected"], report["id"]["conform_percentage"]) == (1, 1, 37.5)


def test_report_of_an_empty_table(spark):
    report = Q.quality_report(tagged(spark).limit(0), "T", 0, "b").collect()
    assert {(r["null_count"], r["null_percentage"], r["conform_percentage"]) for r in report} == {(0, 0.0, 0.0)}


def test_report_is_one_aggregate(spark):
    plan = Q.quality_report(tagged(spark), "T", 8, "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # partial and final


def test_run_summary(spark):
    assert tuple(Q.run_summary(tagged(spark), "T", 8).first()) == ("T", 8, 5, 3, 1, 1)


def test_rules(spark):
    df = spark.createDataFrame([(1, -1), (1, -1), (None, 5)], "id long, n int")
    found = Q.rule_results(
        Q.check_rules(df, [Q.not_null("key", "id"), Q.in_range("low", "n", low=0), Q.in_range("high", "n", high=5)]),
        Q.check_no_duplicates(df, "dup"))
    assert rows(found) == [("dup", False), ("high", True), ("key", False), ("low", False)]


def test_surplus_rows_are_counted_exactly(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 0), (2, 0), (3, 1)], "a long, b long")
    assert Q.check_no_duplicates(df, "d").first()["violations"] == 3
    assert Q.check_no_duplicates(df.distinct(), "d").first()["violations"] == 0
    assert rows(Q.duplicate_rows(df, ["a"])) == [(1, 3), (2, 2)]
