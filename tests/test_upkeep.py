"""Compaction, zone maps, versions and incremental silver, with the failures they are made for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bodega.operators import files as L
from bodega.operators import ingest as I
from bodega.plans import incremental as N
from bodega.plans.bronze import BronzeRun, ingest_all, read_bronze, read_misfits, read_watermarks
from bodega.plans.gold import CLUSTERED, GoldRun, optimize_tables, read_gold, zone_map
from bodega.plans.silver import SilverRun, conform_all, read_rejects, read_silver
from bodega.schemas import TABLES
from bodega.session import folder_files, path_exists
from bodega.sources import versions as V
from bodega.sources.origins import FrameSource
from bodega.sources.tables import write_table
from checks import registry
from checks.fixtures import view
from checks.registry import AS_OF, MEMBERS, RUN_TS, SALES, full_run, thousand_batches, three_runs
from tests.conftest import rows


def sizes(spark, path):
    return {r["path"]: r["bytes"] for r in L.listed(spark, path).collect()}


# ---------------------------------------------------------------- compaction

def appended(spark, path, partition_by=()):
    """One large append and a dozen small ones, over partitions with an odd name."""
    df = spark.range(40_000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS text", "CASE id % 3 WHEN 0 THEN 'a b/c' WHEN 1 THEN 'ñ=1' END AS part")
    write_table(df.coalesce(1), path, partition_by=partition_by)
    for i in range(12):
        write_table(df.where(f"id % 400 = {i}").withColumn("id", -F.col("id")).coalesce(1), path, mode="append", partition_by=partition_by)
    return df.schema


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_small_files_are_merged_and_large_ones_stay(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    schema = appended(spark, path, partition_by)
    before, held = sizes(spark, path), rows(spark.read.schema(schema).parquet(path).select("id", "text", "part"))
    target = max(before.values())
    done = L.compact(spark, path, schema, partition_by, target=target)
    after = sizes(spark, path)
    large = {p for p, size in before.items() if size >= L.SMALL * target}
    assert done.rewritten == 12 * (3 if partition_by else 1) and large <= set(after)
    assert len(after) == len(before) - done.rewritten + done.written and max(after.values()) <= target
    assert rows(spark.read.schema(schema).parquet(path).select("id", "text", "part")) == held
    assert L.compact(spark, path, schema, partition_by, target=target) == L.Compaction(0, 0)
    assert sizes(spark, path) == after and not path_exists(spark, f"{path}/{L.STAGING}")


def test_groups_stay_below_the_target(spark):
    given = [(f"f{i}", 1 + (i * 37) % 24, "d" if i % 3 else "e") for i in range(300)] + [("big", 90, "d"), ("alone", 3, "z")]
    plan = L.plan_groups(spark.createDataFrame(given, "path string, bytes bigint, folder string"), target=100)
    groups = plan.groupBy("folder", "group").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(25 < r["b"] <= 90 and r["n"] > 1 for r in groups if r["group"] < max(g["group"] for g in groups if g["folder"] == r["folder"]))
    assert max(r["b"] for r in groups) <= 90 and {"big", "alone"}.isdisjoint(r["path"] for r in plan.collect())


def test_each_group_is_merged_by_a_task_of_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS text")
    df.repartition(60).write.parquet(path)
    done = L.compact(spark, path, df.schema, target=6 * max(sizes(spark, path).values()))
    tasks = [p.split("-part-")[1][:5] for p in sizes(spark, path)]
    assert done.written > 8 and len(set(tasks)) == len(tasks) == done.written
    assert rows(spark.read.schema(df.schema).parquet(path)) == rows(df)


def test_large_parts_are_written_by_several_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "FILE_BYTES", 20_000)
    found = registry.QUERIES["compact_small_files"](spark, sf_dir).first().asDict()
    assert found["fewer"] and found["none_above"] and found["large_kept"] and found["rewritten_again"] == 0
    assert found["rows"] == view(spark, sf_dir, "trans_ventas").count()


def test_a_compaction_that_died_is_finished_or_forgotten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = appended(spark, path)
    held, target = rows(spark.read.schema(schema).parquet(path)), max(sizes(spark, path).values())
    finish = L.finish_compactions
    calls = []
    monkeypatch.setattr(L, "finish_compactions", lambda *a: calls.append(a) or (finish(*a) if len(calls) == 1 else None))
    L.compact(spark, path, schema, target=target)  # dies once the new files are written, before any is moved
    assert rows(spark.read.schema(schema).parquet(path)) == held
    monkeypatch.undo()
    L.finish_compactions(spark, path)
    assert rows(spark.read.schema(schema).parquet(path)) == held and len(sizes(spark, path)) <= 3
    (tmp_path / "t" / L.STAGING / "dead" / "rows").mkdir(parents=True)  # one that died while it wrote
    L.finish_compactions(spark, path)
    assert rows(spark.read.schema(schema).parquet(path)) == held


def test_an_empty_table_has_nothing_to_compact(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    assert L.compact(spark, str(tmp_path / "t"), spark.range(0).schema) == L.Compaction(0, 0)


# ---------------------------------------------------------------- zone maps

def test_zones_never_lose_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(9000).selectExpr("id", "CASE WHEN id % 7 > 0 THEN id % 100 END AS n", "concat('k', lpad(CAST(id AS STRING), 5, '0')) AS s")
    df.repartitionByRange(9, "id").write.parquet(path)
    zones = L.ZoneMap(path, f"{path}-zones", df.schema, ("id", "n", "s"))
    assert zones.refresh(spark) == 9 and zones.refresh(spark) == 0
    ranges = {"id": (2500, 2600), "s": (None, "k02550")}
    assert rows(zones.scan(spark, ranges)) == rows(df.where("id BETWEEN 2500 AND 2600 AND s <= 'k02550'"))
    assert zones.files(spark, ranges).count() == 1
    # files the map does not know are read, files that are gone are passed over
    df.withColumn("id", F.col("id") + 2550).where("id < 2560").coalesce(1).write.mode("append").parquet(path)
    assert zones.scan(spark, {"id": (2550, 2555)}).count() == 12
    assert zones.refresh(spark) == 1 and zones.files(spark, {"id": (8000, 8010)}).count() == 1
    L.compact(spark, path, df.schema, target=1 << 20)
    assert zones.scan(spark, {"id": (2550, 2555)}).count() == 12
    assert zones.scan(spark, {"n": (None, None)}).count() == spark.read.parquet(path).where("n IS NOT NULL").count()
    with pytest.raises(ValueError, match="no zones of other"):
        zones.scan(spark, {"other": (1, 2)})


def test_a_column_of_nulls_alone_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("CAST(NULL AS INT) AS n").write.parquet(path)
    zones = L.ZoneMap(path, f"{path}-zones", spark.read.parquet(path).schema, ("n",))
    zones.refresh(spark)
    assert zones.scan(spark, {"n": (1, 5)}).count() == 0 and zones.files(spark, {"n": (1, 5)}).count() == 0


# ---------------------------------------------------------------- versions

def test_a_version_counts_once_it_is_finished(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.range(5).selectExpr("id", "id % 2 AS p")
    V.overwrite(first, root, name="versions_test.t")
    dies = first.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("dies")).cast("long")).otherwise(0))
    with pytest.raises(Exception, match="dies"):
        V.overwrite(dies, root, name="versions_test.t")
    assert rows(V.read_current(spark, root)) == rows(first) == rows(spark.table("versions_test.t"))
    # a version may be made of the one before, and the remains of the dead job go with the next
    V.overwrite(V.read_current(spark, root).where("id > 2"), root, name="versions_test.t")
    assert rows(V.read_current(spark, root)) == [(3, 1), (4, 0)] == rows(spark.table("versions_test.t"))
    for n in range(3):
        V.overwrite(spark.range(n).selectExpr("id", "id AS p"), root)
    assert len(V.finished(spark, root)) == V.KEPT == len(V._numbers(spark, root))


def test_replaced_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, p string")
    V.replace_partitions(first, root, ["p"], first.schema)
    V.replace_partitions(spark.createDataFrame([(9, None), (8, "c")], first.schema), root, ["p"], first.schema)
    assert rows(V.read_current(spark, root, schema=first.schema)) == [(1, "a"), (2, "b"), (8, "c"), (9, None)]


def test_gold_is_versioned_and_optimized(spark, sf_dir, tmp_path):
    gold = full_run(spark, sf_dir, str(tmp_path)).gold
    held = {t: rows(read_gold(spark, gold, t)) for t in CLUSTERED}
    first = {t: gold.current(spark, t) for t in CLUSTERED}
    assert all("/version=" in p for p in first.values())
    done = optimize_tables(spark, gold, target=1 << 20)
    assert set(done) == set(CLUSTERED) and done["fact_ventas"].rewritten == 0 or done["fact_ventas"].written > 0
    assert {t: rows(read_gold(spark, gold, t)) for t in CLUSTERED} == held
    zones = zone_map(spark, gold, "fact_rfm_clientes")
    assert zones.scan(spark, {"grupo_valor": ("Champions", "Champions")}).count() == sum(
        "Champions" in r for r in held["fact_rfm_clientes"])
    assert optimize_tables(spark, gold, target=1 << 20)["fact_ventas"] == L.Compaction(0, 0)


# ---------------------------------------------------------------- batches and incremental silver

def test_incremental_silver_equals_a_full_run_and_reads_little(spark, sf_dir):
    read = {}

    def look(silver, n):
        state = N._state(spark, silver, SALES)
        read[n] = (state, N.read_current(spark, silver, SALES).inputFiles())
        full = SilverRun(f"{silver.root}-full-{n}", silver.bronze, newest_per_key=True)
        conform_all(spark, full, [MEMBERS, SALES])
        for table in (MEMBERS, SALES):
            columns = read_silver(spark, full, table).columns
            assert rows(N.read_accepted(spark, silver, table).select(columns)) == rows(read_silver(spark, full, table)), (n, table)
            columns = read_rejects(spark, full, table).columns
            assert rows(N.read_rejected(spark, silver, table).select(columns)) == rows(read_rejects(spark, full, table)), (n, table)

    silver = three_runs(spark, sf_dir, look)
    ledger = N.read_ledger(spark, silver).where(F.col("table_name") == SALES).orderBy("version").collect()
    assert [r["batches"] for r in ledger] == [["batch-0"], ["batch-1"], ["batch-2"]]
    assert ledger[2]["read_rows"] < ledger[1]["read_rows"]
    # every bucket is read in the version the last run that touched it wrote
    state, files = read[2]
    assert all(any(f"key_bucket={b}/version={v}/" in f for f in files) for b, v in state.current.items())
    again = N.conform_new(spark, silver, SALES)
    assert again["touched"] == [] and N.read_ledger(spark, silver).where(F.col("table_name") == SALES).count() == 3
    held = rows(N.read_current(spark, silver, SALES))
    assert N.prune(spark, silver, SALES) > 0 and rows(N.read_current(spark, silver, SALES)) == held


def member(i, day, **more):
    return {"id_miembro": i, "fec_ultima_compra": day, "id_ciudad": "x", **more}


def test_only_touched_buckets_are_written_and_dead_runs_do_not_count(spark, tmp_path, monkeypatch):
    schema = TABLES[MEMBERS].schema
    def bronze(n, people):
        run = BronzeRun(f"{tmp_path}/bronze", batch_id=f"b{n}", run_ts=RUN_TS + dt.timedelta(days=n))
        frame = spark.createDataFrame([[p.get(c) for c in schema.names] for p in people], schema)
        ingest_all(spark, FrameSource({MEMBERS: frame}), run, [MEMBERS])
        return N.IncrementalSilver(f"{tmp_path}/silver", run, buckets=8)
    people = [member(i, dt.date(2020, 1, 1)) for i in range(200)] + [member(None, dt.date(2020, 1, 1), genero=g) for g in "MF"]
    silver = bronze(0, people)
    assert len(N.conform_new(spark, silver, MEMBERS)["touched"]) == 8
    silver = bronze(1, [*people, member(7, dt.date(2021, 1, 1), genero="F")])
    changed = N._write_changes
    monkeypatch.setattr(N, "_write_changes", lambda *a: 1 / 0)  # dies with its rows written
    with pytest.raises(ZeroDivisionError):
        N.conform_new(spark, silver, MEMBERS)
    assert {r["genero"] for r in N.read_accepted(spark, silver, MEMBERS).where("id_miembro = 7").collect()} == {None}
    monkeypatch.setattr(N, "_write_changes", changed)
    row = N.conform_new(spark, silver, MEMBERS)
    assert len(row["touched"]) == 1 and row["read_rows"] == 1
    assert [r["genero"] for r in N.read_accepted(spark, silver, MEMBERS).where("id_miembro = 7").collect()] == ["F"]
    assert N.read_current(spark, silver, MEMBERS).count() == 202 and N.read_rejected(spark, silver, MEMBERS).count() == 2


def test_a_bucket_is_the_work_of_several_tasks_and_late_batches_lose(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "PART_BYTES", 500)
    schema = TABLES[MEMBERS].schema
    def silver(n, day, people):
        run = BronzeRun(f"{tmp_path}/bronze", batch_id=f"b{n}", run_ts=RUN_TS + dt.timedelta(days=day))
        ingest_all(spark, FrameSource({MEMBERS: spark.createDataFrame([[p.get(c) for c in schema.names] for p in people], schema)}), run, [MEMBERS])
        held = N.IncrementalSilver(f"{tmp_path}/silver", run, buckets=2)
        N.conform_new(spark, held, MEMBERS)
        return held
    first = silver(0, 5, [member(i, dt.date(2020, 1, 1)) for i in range(2000)] + [member(None, dt.date(2020, 1, 1))] * 2)
    files = sizes(spark, first.path(MEMBERS))
    assert len(files) > 8 and len({p.split("key_bucket=")[1][0] for p in files}) == 2
    # an older batch that comes late takes no key from a newer one, and brings those that are new
    late = silver(1, 1, [member(i, dt.date(2021, 1, 1), genero="M") for i in (3, 5000)] + [member(None, dt.date(2021, 1, 1))])
    found = {r["id_miembro"]: r["genero"] for r in N.read_accepted(spark, late, MEMBERS).collect()}
    assert len(found) == 2001 and found[3] is None and found[5000] == "M"
    assert N.read_rejected(spark, late, MEMBERS).count() == 2 and N.read_current(spark, late, MEMBERS).count() == 2003


def test_committed_batches_prune_partitions(spark, sf_dir):
    run = thousand_batches(spark, sf_dir)
    assert folder_files(spark, run.watermark_path) < 10  # the store is compacted
    done = I.committed_rows(read_bronze(spark, run, SALES), read_watermarks(spark, run), SALES)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "batch-001" not in plan
    assert {int(r[0][-3:]) % 3 for r in done.select("batch_id").distinct().collect()} == {1, 2}


def test_undated_rows_of_a_dead_run_come_again(spark, tmp_path):
    schema = TABLES["POST_DEVOLUCIONES"].schema
    data = [(i, i, 1, 1, dt.date(2025, 1, 1) if i % 2 else None, 1, "DAM", "Web", "Aprobada", None) for i in range(6)]
    source = FrameSource({"POST_DEVOLUCIONES": spark.createDataFrame(data, schema)})
    def ingest(n):
        run = BronzeRun(str(tmp_path), batch_id=f"b{n}", run_ts=RUN_TS + dt.timedelta(days=n))
        return ingest_all(spark, source, run, ["POST_DEVOLUCIONES"]).first()["record_count"], run
    assert ingest(0)[0] == 6
    count, run = ingest(1)
    assert count == 0 and read_misfits(spark, run, "POST_DEVOLUCIONES").count() == 0
    # digests of a batch that never got its watermark row do not count
    spark.read.parquet(run.undated_path("POST_DEVOLUCIONES")).withColumn("batch_id", F.lit("dead")).write.mode("overwrite").parquet(f"{tmp_path}/x")
    spark.read.parquet(f"{tmp_path}/x").write.mode("overwrite").parquet(run.undated_path("POST_DEVOLUCIONES"))
    assert ingest(2)[0] == 3


def test_as_of_is_pinned():
    assert GoldRun("r", None, AS_OF).staged
