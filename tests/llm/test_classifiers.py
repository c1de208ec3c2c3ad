import zlib

import numpy as np

from bodega.llm import language_id, quality_score
from bodega.llm.common import table


def test_languages_on_held_out_rows(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    got = language_id.identify(table(spark, sf_dir, "documents")).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark, edge_docs, no_docs):
    got = language_id.identify(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for doc in (1, 2, 3, 10, 11):
        assert (by_id[doc]["lang_pred"], by_id[doc]["score"]) == ("und", 0.0)
    assert by_id[7]["lang_pred"] == by_id[9]["lang_pred"] == "de" and by_id[5]["lang_pred"] == "en"
    assert by_id[None]["held_out"] is False
    assert language_id.identify(no_docs).collect() == []
    kept = language_id.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 10, 11})


def test_grams_do_not_cross_texts():
    one = language_id.grams(["abc def", None, "", "ZZ 9 top"])
    for i, text in enumerate(["abc def", None, "", "ZZ 9 top"]):
        row, bucket, count = language_id.grams([text])
        own = one[0] == i
        assert np.array_equal(one[1][own], bucket) and np.array_equal(one[2][own], count)
    assert np.array_equal(language_id.grams(["ZZ 9 top"])[1], language_id.grams(["zz -- top!"])[1])


def test_leader_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    examples = [(np.array([k, 10 + int(rng.integers(500))]), np.array([0.9, 0.4]), k) for k in rng.integers(3, size=400).tolist()]
    w = language_id.learn_weights(examples, 3)
    assert all(w[k].argmax() == k for k in range(3))
    assert (w == 0).mean() > 0.9


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(20000, 3))
    p = language_id.softmax(logits)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert abs(language_id.fit_temperature(logits * 4, labels) - 4) < 0.4


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    got = quality_score.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.85
    good = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    poor = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.9


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (7, 0, 0), (7, 1, 0), (None, 1, 0), (20, None, 1), (21, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = quality_score.score_quality(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality_score.score_quality(no_docs, labels).collect() == []
    unlabelled = quality_score.score_quality(edge_docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in unlabelled} == {(0.5, 1)}


def test_isotonic_is_the_nearest_rising_fit():
    rng = np.random.default_rng(2)
    n = rng.integers(1, 5, 30).astype(float)
    y = rng.random(30) * n
    fit = quality_score.isotonic(y, n)
    assert (np.diff(fit) >= -1e-12).all()
    # by the formula of largest lower and least upper averages
    brute = [max(min(y[a:b].sum() / n[a:b].sum() for b in range(i + 1, 31)) for a in range(i + 1)) for i in range(30)]
    assert np.allclose(fit, brute)


def test_normal_equations_equal_one_matrix(spark):
    rng = np.random.default_rng(3)
    stats = rng.normal(size=(40, len(quality_score.STATS)))
    y = rng.integers(2, size=40)
    model = quality_score.Model(np.zeros(stats.shape[1]), np.ones(stats.shape[1]), rng.normal(size=(stats.shape[1], 8)), np.zeros(8))
    rows = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<double>, y int").repartition(5)
    a, b = quality_score.normal_equations(rows, model)
    phi = model.features(stats)
    assert np.allclose(a, phi.T @ phi) and np.allclose(b, phi.T @ y)
