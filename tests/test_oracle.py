"""Every registered query against its SQL on the given tables."""

import pytest

from checks.oracle import ORACLE
from checks.registry import QUERIES


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    expected = ordered(cursor.fetchall(), columns)
    assert sorted(df.columns) == sorted(columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == expected


def test_entry_contract(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["fec_venta", "canal_venta", "ventas_netas", "ticket_promedio",
                          "total_transacciones", "porcentaje_ventas_descuento"]
    assert df.limit(1).count() == 1
    assert set(contract.oracle_sql()) <= set(contract.queries())
