import duckdb
import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean, "
          "`_gone` int, `group` string, `Label` string")


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1.0, False, 3, "g", "x")


PROSE = [
    "the quick brown fox jumps over the lazy dog and runs away from the small house on the hill while the old man sleeps",
    "der schnelle braune fuchs springt über den faulen hund und läuft weg von dem kleinen haus auf dem hügel während der mann schläft",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and names that clash."""
    rows = [
        document(1, None), document(2, ""), document(3, "!!! 123 \n\t"), document(4, "word " * 40000),
        document(5, PROSE[0]), document(5, PROSE[0]), document(6, PROSE[0], None, None), document(7, PROSE[1], "de"),
        document(None, PROSE[1], "de"), document(8, "x" * 30000), document(9, PROSE[1] + " 漢字 🎉", "de", None),
        (10, *[None] * 9), document(11, " \n "), document(12, "a", "en"),
        *[document(20 + i, f"{PROSE[i % 2]} number {i} of these", ("en", "de")[i % 2]) for i in range(20)],
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(sf_dir):
    """doc_id and text of the given documents."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()
