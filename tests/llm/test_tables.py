"""Packing, URL rules and the permutation index."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bodega.llm import packing, permutation_index, url_filter
from bodega.llm.common import table
from bodega.llm.queries import ORACLE, op9_url_filter, tokenizer

JSON, RANKS = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------- packing

def check_packing(rows, texts):
    """Every document's ids are cut and placed once, without gaps."""
    library = Tokenizer.from_file(JSON)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        total += len(ids)
        at = 0
        for i, r in enumerate(sorted(by_doc[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            part = ids[at:at + r["length"]]
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and (i == 0 or r["length"] == 2048)
        assert at == len(ids) and (len(ids) > 2048 or len(by_doc[doc]) == 1)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return len(by_sequence), total


def test_given_documents_are_packed_tightly(spark, sf_dir, texts):
    rows = packing.pack_documents(table(spark, sf_dir, "documents"), JSON, RANKS).collect()
    sequences, total = check_packing(rows, dict(texts))
    assert sequences <= -(-total // 2048) + 2


def test_packing_edges(spark, edge_docs, no_docs):
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    repeated = packing.pack_documents(edge_docs, JSON, RANKS).collect()
    assert sum(r["doc_id"] == 5 for r in repeated) == 2
    check_packing(packing.pack_documents(edge_docs.dropDuplicates(["doc_id"]), JSON, RANKS).collect(), texts)
    assert packing.pack_documents(no_docs, JSON, RANKS).collect() == []


@pytest.mark.parametrize("text", ["", " ", "  a", "a \nb", "a\u00a0b", "x<|endoftext|>y z", "it's 's a1 ½ 漢字 🎉🎉", "a\t b  c \n", "\x1c a \x1c"])
def test_tokens_are_the_librarys(text):
    own = packing.tokens_at(JSON, RANKS)
    assert np.frombuffer(own(text), "<u4").tolist() == own.full.encode(text, add_special_tokens=False).ids


def test_a_hot_length_is_ranked_by_many_cells(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 50)
    rows = [(i, 0, 0, 700 if i % 3 else 1 + i % 40, i) for i in range(600)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    used = defaultdict(list)
    for r in packing.place(pieces).collect():
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in used.values():
        assert [o for o, _ in sorted(own)] == np.concatenate([[0], np.cumsum([n for _, n in sorted(own)])[:-1]]).tolist()
    assert sum(map(len, used.values())) == 600 and len(used) <= 201


def test_sweep_gives_every_piece_the_least_gap_left():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pieces, gaps = rng.integers(0, 3, 13), rng.integers(0, 3, 13)
        pieces[0] = gaps[0] = 0
        got = defaultdict(int)
        for size, gap, n in packing.successor_match(pieces, gaps):
            got[size, gap] += n
        free, want = gaps.copy(), defaultdict(int)
        for size in range(12, 0, -1):
            for _ in range(pieces[size]):
                fits = [g for g in range(size, 13) if free[g]]
                if fits:
                    free[fits[0]] -= 1
                    want[size, fits[0]] += 1
        assert got == want


# ---------------------------------------------------------------- urls

def test_urls_match_sql(spark, sf_dir):
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    got = sorted(map(tuple, op9_url_filter(spark, sf_dir).collect()))
    assert got == sorted(duck.execute(ORACLE["op9_url_filter"]).fetchall())


def test_url_edges(spark):
    urls = {1: None, 2: "", 3: "no scheme/en/", 4: "http://COM/x?y", 5: "https://A.Example.com/en/1", 6: "http://www.example.com/en/",
            7: "http://x.www.example.com/en/a#b", 8: "http://com", 9: "http://examplecom/en/", 10: "http://b.net/es/://c", 11: "x://net/fr",
            12: "http://" + "a." * 3000 + "net/fr/", 13: "http://Émile.com/", 14: "http://.com/", 15: "://net/es/?q"}
    pages = spark.createDataFrame([(k, v, "r", 0) for k, v in urls.items()] * 2, "page_id int, url string, rule string, `Keys` int")
    got = {(r["page_id"], r["host"][:20], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, url_filter.rule_table(spark)).collect()}
    assert got == {
        (1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "com", "com/", "allow"),
        (5, "a.example.com", "example.com/en/", "block"), (6, "www.example.com", "www.example.com/en/", "allow"),
        (7, "x.www.example.com", "www.example.com/en/", "allow"), (8, "com", None, "allow"), (9, "examplecom", None, "allow"),
        (10, "b.net", "net/es/", "block"), (11, "net", None, "allow"), (12, "a." * 10, "net/fr/", "block"),
        (13, "Émile.com", "com/", "allow"), (14, ".com", "com/", "allow"), (15, "net", "net/es/", "block")}
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark)).collect() == []
    assert url_filter.judge_urls(pages, url_filter.rule_table(spark, [("a", "/", "block")]).limit(0)).where("rule IS NOT NULL").count() == 0


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_A_KEY", 6)  # many false positives
    monkeypatch.setattr(url_filter, "HASHES", 2)
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("substr(key, -1) = '7'")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.contains(F.col("key")) != F.expr("substr(key, -1) = '7'"))
    assert wrong.count() == 0


# ---------------------------------------------------------------- neighbours

def test_recall_and_exact_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    data = rows.select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], dtype=np.float64)
    got = defaultdict(list)
    for r in permutation_index.search(rows, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    recall = []
    for q, found in got.items():
        score = (x * x[ids == q][0]).sum(axis=1)
        order = np.lexsort((ids, -score))
        want = [i for i in ids[order].tolist() if i != q][:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(s == score[ids == v][0] for _, v, s in found)
        recall.append(len(set(want) & {v for _, v, _ in found}) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (40, None), (60, []), (80, [0.0, 0.0]),
            (100, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (None, [5.0, 5.0]), (7, [1.0]), (8, [-1.0, -1.0])]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(0)).withColumn("v", F.lit("x"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in permutation_index.search(data, F.col("vec_id") % 20 == 0, k=20).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 1.0), (0, 4, 20, 0.0), (0, 5, 8, -1.0),
                   (20, 1, 2, 1.0), (20, 2, 2, 1.0), (20, 3, 3, 1.0), (20, 4, 0, 0.0), (20, 5, 8, -1.0)]
    assert permutation_index.search(data.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_footrule_by_postings_is_the_footrule():
    rng = np.random.default_rng(0)
    orders = np.array([rng.permutation(12)[:5] for _ in range(30)])
    files = permutation_index.Postings(orders, 12)

    def place(order):
        out = np.full(12, 5)
        out[order] = np.arange(5)
        return out

    for q in orders[:5]:
        want = [np.abs(place(q) - place(o)).sum() for o in orders]
        assert np.array_equal(files.footrule(q), want)
