import hashlib

import pytest

from bodega.operators import conform as C
from bodega.schemas import NULL_REASON, TABLES
from checks.fixtures import view
from tests.conftest import rows


def test_dedup_keeps_rows_of_two_batches(spark):
    df = spark.createDataFrame([(1, "a", "b1"), (1, "a", "b1"), (1, "a", "b2")], "id long, v string, batch_id string")
    assert C.dedup(df).count() == 2


def test_dedup_newest_row_per_key(spark):
    df = spark.createDataFrame(
        [(1, "old", 1, "b1"), (1, "new", 2, "b2"), (2, None, 1, "b1"), (2, "x", 1, "b1"), (None, "n", 1, "b1")],
        "id long, v string, ingestion_timestamp int, batch_id string")
    assert rows(C.dedup(df, ["id"]).select("id", "v")) == rows(
        spark.createDataFrame([(1, "new"), (2, "x"), (None, "n")], "id long, v string"))


def test_mandatory_split_is_complete(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None), (2, 2)], "a long, b long")
    ok, bad = C.split_mandatory(df, ["a", "b"])
    assert ok.count() == 2 and bad.count() == 2
    assert {r["error_reason"] for r in bad.collect()} == {NULL_REASON}


def test_hash_drops_clear_text_and_keeps_null(spark):
    df = C.hash_columns(spark.createDataFrame([("Quito",), (None,)], "id_ciudad string"), ["id_ciudad"])
    assert df.columns == ["id_ciudad_hash"]
    assert {r[0] for r in df.collect()} == {hashlib.sha256(b"Quito").hexdigest(), None}


def test_rejects_carry_no_clear_text(spark):
    members = spark.createDataFrame([(None, "Quito", None)], "id_miembro long, id_ciudad string, canal_pref string")
    tagged = C.conform(members, TABLES["CRM_MIEMBROS"])
    assert "id_ciudad" not in tagged.columns
    assert C.rejected(tagged).count() == 1


def test_flag_is_set_before_fill(spark):
    df = C.flag_and_fill(spark.createDataFrame([("Web",), (None,)], "canal_pref string"), {"canal_pref": "NO_DEFINIDO", "absent": "x"})
    assert rows(df) == [("NO_DEFINIDO", 1), ("Web", 0)]


def test_cast_ignores_missing_columns_and_bad_values(spark):
    df = C.cast_columns(spark.createDataFrame([("true",), ("?",)], "activo string"), {"activo": "boolean", "x": "int"})
    assert {r[0] for r in df.collect()} == {True, None}


@pytest.mark.parametrize("hot", [[], [1, 9]])
def test_tags_split_input_without_loss(spark, hot):
    sales = spark.createDataFrame(
        [(i, m, a) for i, (m, a) in enumerate([(1, 1), (1, None), (9, 1), (None, 1), (2, 2), (1, 1)])],
        "id_trans long, id_miembro long, art_id long")
    parents = spark.createDataFrame([(1,), (1,), (2,)], "id_miembro long")  # member 1 is stored twice
    tagged = C.conform(sales, TABLES["TRANS_VENTAS"], parents, hot_keys=hot)
    assert {r["id_trans"]: r["error_reason"] for r in tagged.collect()} == {
        0: "NONE", 1: NULL_REASON, 2: "INVALID_CUSTOMER_ID", 3: NULL_REASON, 4: "NONE", 5: "NONE"}
    assert tagged.count() == 6


def test_anti_and_semi_cover_input(spark, sf_dir):
    sales, members = view(spark, sf_dir, "trans_ventas"), view(spark, sf_dir, "crm_miembros")
    kept = C.fk_valid(sales, members, "id_miembro").count()
    lost = C.fk_rejects(sales, members, "id_miembro", "X").count()
    assert kept + lost == sales.count() and lost > 0


def test_semi_join_does_not_multiply(spark):
    sales = spark.createDataFrame([(1, 7)], "id_trans long, id_miembro long")
    twice = spark.createDataFrame([(7,), (7,)], "id_miembro long")
    assert C.fk_valid(sales, twice, "id_miembro").count() == 1
    assert C.fk_valid(sales, twice, "id_miembro", how="inner").count() == 2
    with pytest.raises(ValueError):
        C.fk_valid(sales, twice, "id_miembro", how="cross")
