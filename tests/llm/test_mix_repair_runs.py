"""Source mixing, conversation repair and periodic runs."""

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bodega.llm import conversation_repair, periodic_runs, source_mix
from bodega.llm.common import table
from bodega.llm.queries import ORACLE, op11_source_mix, op12_conversation_repair, op13_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(text):
    return zlib.crc32(text.encode())


# ---------------------------------------------------------------- mixing

def sql_rows(name, **views):
    connection = duckdb.connect()
    for view, body in views.items():
        connection.execute(f"CREATE VIEW {view} AS {body}")
    cursor = connection.execute(ORACLE[name])
    return [c[0] for c in cursor.description], cursor.fetchall()


def test_mix_matches_sql(spark, sf_dir):
    columns, expected = sql_rows("op11_source_mix", documents=f"SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = op11_source_mix(spark, sf_dir).collect()
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == sorted(expected, key=repr)


def goals_of(sizes, weights=(5, 2, 1)):
    """Targets by exact rounds of resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, held = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        rest = {s: weight[s] for s in order if s not in held}
        if not rest:
            return held
        rate = (wanted - sum(held.values())) / sum(rest.values())
        over = {s: Fraction(2 * sizes[s]) for s in rest if 2 * sizes[s] < rate * weight[s]}
        if not over:
            return held | {s: rate * w for s, w in rest.items()}
        held |= over


def test_targets_by_rounds(spark):
    rnd = random.Random(7)
    for most in (3, 1000):
        sizes = {rnd.choice(["a", "Z", "é", "漢", "", "src"]) + str(i): rnd.randint(0, most) for i in range(40)} | {None: 5}
        given = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
        found = {r["source"]: r["target"] for r in source_mix.targets(given).collect()}
        expected = goals_of(sizes)
        assert found.keys() == expected.keys()
        assert all(abs(found[s] - float(t)) < 1e-6 * max(1, t) for s, t in expected.items())


def test_schedule_ranks_and_spread(spark):
    goals = spark.createDataFrame([("a", 7000.0), ("b", 100.4), ("c", 0.0), (None, 2500.0)], "source string, target double")
    rows = sorted(source_mix.schedule(goals, block=100).collect(), key=lambda r: r["slot"])
    seen = defaultdict(list)
    for r in rows:
        assert r["block"] == len(seen[r["source"]])  # the slot's rank among its source's
        seen[r["source"]].append(r["words"])
    assert {s: sum(w) for s, w in seen.items()} == {"a": 7000, "b": 100, None: 2500}
    assert len({r["slot"] for r in rows}) == len(rows) == 70 + 1 + 25
    for n in range(1, len(rows)):  # every prefix holds about the shares
        assert abs(sum(r["source"] == "a" for r in rows[:n]) - n * 70 / 96) < 4


def test_mix_pieces_fill_their_slots(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(source_mix, "CELL_WORDS", 500)
    monkeypatch.setattr(source_mix, "CHUNK_BLOCKS", 3)
    sizes = source_mix.sized(table(spark, sf_dir, "documents"))
    goals = source_mix.targets(sizes.select("source", "size"))
    rows = source_mix.mix(sizes, goals, block=64).where("slot IS NOT NULL").collect()
    slots = {r["slot"]: r["words"] for r in source_mix.schedule(goals, 64).collect()}
    filled = defaultdict(int)
    for r in rows:
        assert 0 <= r["from"] and r["from"] + r["length"] <= r["size"] and r["length"] > 0
        filled[r["slot"]] += r["length"]
    assert filled == slots


def test_mix_edges(spark, edge_docs, no_docs):
    rows = source_mix.mixed(edge_docs).collect()
    given = edge_docs.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in given)
    assert sorted(r["size"] for r in rows) == sorted(len(WORD.findall(r["text"] or "")) for r in given)
    by_source = defaultdict(int)
    for r in given:
        by_source[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert {r["source_size"] for r in rows} == set(by_source.values())
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(words - target) <= 1 for (_, target), words in taken.items())
    again = source_mix.mixed(edge_docs.repartition(7, F.rand(3))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert source_mix.mixed(no_docs).collect() == []
    empty = edge_docs.where("doc_id in (1, 2, 11)")
    assert [(r["size"], r["target"], r["taken"]) for r in source_mix.mixed(empty).collect()] == [(0, 0.0, 0)] * 3


# ---------------------------------------------------------------- conversations

NEXT, NAME = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, digest) over all edits of rows (role, text, lost, truncated), pairs compared as they are."""
    @functools.lru_cache(None)
    def go(i, state, inserted):
        options = []

        def offer(cost, letter, rest, line):
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2]))

        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, lost, truncated = rows[i]
            offer(3, "D", go(i + 1, state, 0), None)
            if not lost:
                to = NEXT[state]
                offer(2 + truncated, "R", go(i + 1, to, 0), f"{NAME[to]}:{text}")
                if role[:1] == to or role[:1] == "s" and state == "":
                    offer(truncated, "K", go(i + 1, role[:1], 0), f"{role}:{text}")
        if inserted < 3:
            offer(2, "I", go(i, NEXT[state], inserted + 1), f"{NAME[NEXT[state]]}:")
        return min(options, key=lambda o: o[:2], default=None)

    cost, audit, lines = go(0, "", 0)
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def contract_row(conv, rows):
    """The whole contract for one conversation of (turn, role, text), in plain Python."""
    shown = lambda x: " " if x is None else str(x)
    after = []
    for turn, role, text in rows:
        part, role, text = crc(f"{shown(conv)}:{shown(turn)}") % 20, shown(role), shown(text)
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        after += [(turn, "user" if part == 4 else role, text)] * (0 if part == 0 else 2 if part == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, judged, faults = set(), [], [0, 0, 0]
    for _, role, text in after:
        words = WORD.findall(text)
        kind = 0 if not words else 1 if (role, text) in seen else 2 if words[-1][-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            faults[kind] += 1
        judged.append((role, text, kind in (0, 1), kind == 2))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    turns = {r[0] for r in after} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return conv, gaps, *faults, illegal, *cheapest(tuple(judged))


def expected_repairs(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    return sorted((contract_row(c, own) for c, own in by.items()), key=repr)


def test_given_conversations_are_repaired(spark, sf_dir):
    given = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'").fetchall()
    assert sorted(map(tuple, op12_conversation_repair(spark, sf_dir).collect()), key=repr) == expected_repairs(given)


@pytest.mark.parametrize("block", [2, 3, 64])
def test_least_integer_is_the_cheapest_repair(block, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    monkeypatch.setattr(conversation_repair, "_WIDTH", 3 * block + 3)
    monkeypatch.setattr(conversation_repair, "_HIGH", 9 * block + 9)
    rnd = random.Random(block)
    for _ in range(600):
        rows = []
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 30])):
            lost = rnd.random() < .15
            rows.append((rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", " "]),
                         rnd.choice(["a.", "b", "c?", ""]), lost, not lost and rnd.random() < .2))
        repair = conversation_repair.Repair()
        for row in rows:
            repair.row(*row)
        assert repair.best() == cheapest(tuple(rows))


def test_conversation_edges(spark):
    schema = "text string, conv_id bigint, role string, turn bigint, gone int, blank string, conv string"
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "", " \n", "Yes.", "no", "Why? ", "a.\x1c", "漢字!"]), rnd.choice([None, 1, 2, 3, 4, 5, 6]),
             rnd.choice([None, "", "user", "assistant", "system", "User", "ubiquity"]), rnd.choice([None, -3, 0, 0, 1, 2, 9]))
            for _ in range(120)]
    rows += [("word " * 20000 + ".", 77, "user", 0), ("ok.", 77, "assistant", 1), *[("same.", 78, "user", i % 3) for i in range(40)],
             *[(f"turn {i}.", 79, ("user", "assistant", "user")[i % 3], i) for i in range(400)]]
    given = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], schema).repartition(5)
    found = conversation_repair.repair_damaged(given).collect()
    assert sorted(map(tuple, found), key=repr) == expected_repairs([(c, t, r, x) for x, c, r, t in rows])
    assert conversation_repair.repair_damaged(given.limit(0)).collect() == []


# ---------------------------------------------------------------- periodic runs

def plain_runs(words):
    """Every run by trying all periods."""
    ids, found = np.unique(words, return_inverse=True)[1] if words else np.empty(0), {}
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8)
        edge = np.diff(same)
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def contract_runs(doc, text):
    words = WORD.findall(text or "")
    h, n = crc(str(doc)), len(words)
    g = h // 10
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_given_documents_runs(spark, sf_dir, texts):
    rows = sorted(map(tuple, op13_periodic_runs(spark, sf_dir).collect()))
    assert rows == [contract_runs(*t) for t in texts]
    assert sum(r[1] > 0 for r in rows) > 5


def random_words(rnd):
    kind, few = rnd.random(), lambda k, m: [rnd.randint(0, k) for _ in range(rnd.randint(0, m))]
    if kind < .3:
        return few(1, 70)
    if kind < .6:
        return (few(2, 9) + [rnd.randint(0, 2) for _ in range(rnd.randint(1, 15))] * rnd.randint(1, 9) + few(2, 9)) * rnd.choice([1, 1, 4, 6])
    if kind < .8:  # long stretches of a smaller period inside a larger one
        words = ([0] * rnd.randint(0, 40) + [1] + [0, 2] * rnd.randint(0, 12)) * rnd.randint(1, 7)
        if words and rnd.random() < .5:
            words[rnd.randrange(len(words))] = 7
        return words
    return few(50, 120)


def test_runs_are_all_runs():
    rnd = random.Random(5)
    for _ in range(400):
        texts = [random_words(rnd) for _ in range(rnd.randint(1, 5))]
        bounds = np.cumsum([0] + [len(w) for w in texts])
        found = [[] for _ in texts]
        for text, *run in zip(*(x.tolist() for x in periodic_runs.find_runs(
                np.array([x for w in texts for x in w], dtype=np.uint64), bounds))):
            found[text].append(tuple(run))
        assert found == [plain_runs(w) for w in texts]


@pytest.mark.parametrize("ends", [("a", "b"), ("b", "a"), ("same words", "same words")])
def test_texts_that_end_alike(ends):
    """Texts 97 and 98 of a chunk, whose numbers are the codes of a and b, and texts with the very same words."""
    texts = ["", *["x"] * 96, *[f"{mid} {end}" for mid, end in zip(("c d c d c d c d", "e f"), ends)], *ends, "b " * 9 + "b"]
    found = list(periodic_runs.runs_of_texts(pa.array(texts)))
    assert [[w.decode() for w in words] for words, _ in found] == [t.split() for t in texts]
    assert [runs for _, runs in found] == [plain_runs(t.split()) for t in texts]


def test_wavelet_matrix_answers_range_successors():
    rnd = np.random.default_rng(2)
    values = rnd.permutation(300)[:200]
    matrix = periodic_runs.WaveletMatrix(values, 9)
    low = rnd.integers(0, 199, 500)
    high = low + rnd.integers(1, 201 - low)
    bound = rnd.integers(0, 301, 500)
    below = matrix.below(low, high, bound)
    assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    some = below < high - low
    assert matrix.nth(low[some], high[some], below[some]).tolist() == [
        int(min(v for v in values[a:b] if v >= x)) for a, b, x in zip(low[some], high[some], bound[some])]


def test_run_edges(spark, edge_docs, no_docs):
    rows = sorted(map(tuple, periodic_runs.run_digests(edge_docs).collect()), key=repr)
    assert rows == sorted((contract_runs(r["doc_id"], r["text"]) for r in edge_docs.collect()), key=repr)
    assert periodic_runs.run_digests(no_docs).collect() == []
    whole = periodic_runs.periodic_runs(edge_docs.withColumn("Runs", F.lit(1)))
    assert whole.columns[-3:] == ["Runs", "_runs", "collapsed"]
    for r in whole.collect():
        words = WORD.findall(r["text"] or "")
        assert [tuple(x) for x in r["_runs"]] == (plain_runs(words) if len(words) < 1000 else [(0, 40000, 1)])
        assert r["text"] is None or r["_runs"] or r["collapsed"] == " ".join(words)
