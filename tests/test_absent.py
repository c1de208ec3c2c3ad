"""Rows are told from the few keys that a large lookup lacks."""

import pytest

from bodega.operators import model
from bodega.operators.conform import conform, tag_rows
from bodega.operators.joins import absent_keys
from bodega.plans.silver import unmatched
from bodega.schemas import TABLES
from tests.conftest import rows

SPEC = TABLES["TRANS_VENTAS"]
LIMIT = 5_000  # bytes that may be broadcast: less than the members' folder


@pytest.fixture
def members(spark, tmp_path):
    path = str(tmp_path / "members")
    spark.range(20_000).selectExpr("IF(id % 50 = 0, NULL, id * 7919) AS id_miembro", "id AS _twice").union(
        spark.range(20).selectExpr("id * 7919", "id")).select("id_miembro").write.parquet(path)
    return spark.read.parquet(path), path


@pytest.fixture
def sales(spark):
    return spark.range(6000).selectExpr(
        "id AS id_trans", "CASE WHEN id % 5 = 0 THEN -1 WHEN id % 11 = 0 THEN NULL ELSE (id % 300) * 7919 END AS id_miembro",
        "IF(id % 13 = 0, NULL, id % 9) AS art_id", "CAST(id % 4 AS INT) AS qty_vendida", "CAST(3 AS DECIMAL(12,2)) AS precio_unitario_venta",
        "CAST(0 AS DECIMAL(17,4)) AS descuento_aplicado", "TIMESTAMP_NTZ '2001-01-01 00:00:00' AS fec_trans")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_that_a_large_lookup_lacks_are_found_once_each(spark, sales, members):
    hot, absent = unmatched(spark, sales, "id_miembro", *members, LIMIT)
    known = {r[0] for r in members[0].collect()}
    assert hot is None
    assert rows(absent) == sorted(((k,) for k in {r["id_miembro"] for r in sales.collect()} - known - {None}), key=repr)


def test_a_small_lookup_needs_nothing(spark, sales, members):
    assert unmatched(spark, sales, "id_miembro", *members, 1 << 30) == (None, None)


def test_too_many_absent_keys_leave_the_salted_join(spark, sales, members):
    assert absent_keys(sales, "id_miembro", members[0], "id_miembro", 0) is None
    assert unmatched(spark, sales, "id_miembro", *members, 0)[0][-1] >= 1200


def test_tags_by_absent_keys_are_the_same_and_move_no_row(spark, sales, members):
    hot, absent = unmatched(spark, sales, "id_miembro", *members, LIMIT)
    tagged = tag_rows(sales, SPEC, members[0], hot, absent)
    assert rows(tagged) == rows(tag_rows(sales, SPEC, members[0]))
    assert tagged.select("error_reason").distinct().count() == 3
    assert "Exchange hashpartitioning" not in plan(tagged)
    assert rows(conform(sales.union(sales), SPEC, members[0], None, hot, absent)) == rows(conform(sales, SPEC, members[0]))


def test_sales_valued_by_absent_keys_are_the_same_and_move_no_row(spark, sales, members):
    hot, absent = unmatched(spark, sales, "id_miembro", *members, LIMIT)
    fact = model.fact_sales(sales, members[0], hot, absent)
    plain = model.fact_sales(sales, members[0])
    assert fact.columns == plain.columns and rows(fact) == rows(plain)
    assert {r[0] for r in fact.select("cliente_anonimo_flag").distinct().collect()} == {0, 1}
    assert "Exchange hashpartitioning" not in plan(fact)


def test_no_absent_key_is_no_reject(spark, sales, members):
    known = sales.where("id_miembro > 0").join(members[0].distinct(), "id_miembro", "left_semi")
    hot, absent = unmatched(spark, known, "id_miembro", *members, LIMIT)
    assert absent.count() == 0
    assert tag_rows(known, SPEC, members[0], hot, absent).where("error_reason = 'INVALID_CUSTOMER_ID'").count() == 0
