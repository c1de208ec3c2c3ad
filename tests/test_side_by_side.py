import datetime as dt
import threading

import pytest

from bodega.plans.bronze import BronzeRun, ingest_all, read_bronze, read_watermarks
from bodega.plans.side_by_side import run_steps
from bodega.plans.silver import SilverRun, conform_all, read_rejects, read_silver
from bodega.schemas import TABLES
from bodega.sources.origins import FrameSource
from checks.fixtures import view
from tests.conftest import rows

NOW = dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc)


def test_steps_meet_and_keep_their_order(spark):
    both = threading.Barrier(2, timeout=60)

    def count(n):
        both.wait()  # passed only where two steps run at the same time
        return spark.range(n).count()

    done = run_steps(spark, {"a": lambda: count(5), "b": lambda: count(7)}, at_once=2)
    assert list(done) == ["a", "b"] and [o.value for o in done.values()] == [5, 7]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_no_more_than_allowed_run_at_once(spark):
    now, most, lock = [0], [0], threading.Lock()

    def step():
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        spark.range(1000).count()
        with lock:
            now[0] -= 1

    run_steps(spark, {str(i): step for i in range(6)}, at_once=2)
    assert 1 <= most[0] <= 2
    assert run_steps(spark, {}) == {}


def test_failure_stops_only_what_needs_it(spark):
    seen = []

    def step(name):
        def work():
            seen.append(name)
            if name == "b":
                raise RuntimeError("lost")
        return work

    done = run_steps(spark, {n: step(n) for n in "fedcba"}, {"c": ["b"], "d": ["c", "a"], "e": ["a", "elsewhere"], "a": []}, 3)
    assert {n: o.ok for n, o in done.items()} == {"a": True, "b": False, "c": False, "d": False, "e": True, "f": True}
    assert str(done["b"].error) == "lost" and done["c"].kept_by == ("b",) and done["d"].kept_by == ("c",)
    assert sorted(seen) == ["a", "b", "e", "f"] and seen.index("a") < seen.index("e")


def test_steps_in_a_circle_are_refused(spark):
    with pytest.raises(ValueError, match="a, b"):
        run_steps(spark, {"a": int, "b": int, "c": int}, {"a": ["b"], "b": ["a"]})


def test_tables_side_by_side_equal_tables_in_sequence(spark, sf_dir, tmp_path):
    frames = {t: view(spark, sf_dir, t.lower()) for t in TABLES}
    frames["TRANS_VENTAS"] = view(spark, sf_dir, "trans_ventas_raw")
    stored = []
    for at_once in (1, 4):
        root = str(tmp_path / str(at_once))
        before = spark.conf.get("spark.sql.shuffle.partitions")
        bronze = BronzeRun(f"{root}/bronze", batch_id="b", run_ts=NOW, at_once=at_once)
        log = ingest_all(spark, FrameSource(frames), bronze).select("table_name", "record_count", "status", "error_message").collect()
        silver = SilverRun(f"{root}/silver", bronze, at_once=at_once)
        summaries = conform_all(spark, silver).drop("duration_seconds").collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        stored.append((
            log, summaries, rows(read_watermarks(spark, bronze)), rows(spark.read.parquet(silver.quality_path)),
            {t: (read_bronze(spark, bronze, t).count(), rows(read_silver(spark, silver, t)), rows(read_rejects(spark, silver, t)))
             for t in TABLES}))
    assert stored[0] == stored[1]
    assert [r["table_name"] for r in stored[1][0]] == list(TABLES)
