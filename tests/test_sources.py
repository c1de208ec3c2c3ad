"""Tables, exports, catalog; the relational source against a recording reader (no database)."""

import datetime as dt
from unittest.mock import MagicMock

import pytest

from bodega.plans.bronze import BronzeRun
from bodega.schemas import TABLES
from bodega.session import broadcast_limit, folder_bytes, materialize, path_exists, remove_path, shared_folder, sized_shuffles
from bodega.sources import origins, tables
from checks.fixtures import view
from tests.conftest import rows


def test_csv_keeps_codes_nulls_and_quotes(spark, tmp_path):
    schema = TABLES["MSTR_ARTICULOS"].schema
    data = [(1, "0000000000017", 'a "quoted", text', "x", None, "", 3, None, 1.5, "UND", True, dt.date(2025, 1, 2))]
    df = spark.createDataFrame(data, schema)
    folders = tables.export_table(df, str(tmp_path))
    # a CSV does not tell empty text from null
    assert rows(tables.read_csv(spark, folders["csv"], schema)) == rows(df.replace("", None))
    assert rows(tables.read_table(spark, folders["parquet"])) == rows(df)


def test_malformed_csv_is_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id_proveedor,razon_social,pais_origen,tiempo_repo_dias,calificacion_calidad,activo\nx,a,b,1,1.0,true\n")
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), TABLES["MSTR_PROVEEDORES"].schema).collect()


def test_file_source(spark, sf_dir, tmp_path):
    stores = view(spark, sf_dir, "mstr_tiendas")
    stores.write.parquet(f"{tmp_path}/mstr_tiendas")
    stores.write.option("header", True).csv(f"{tmp_path}/csv/mstr_tiendas")
    assert rows(origins.FileSource(str(tmp_path)).load(spark, "MSTR_TIENDAS")) == rows(stores)
    assert rows(origins.FileSource(f"{tmp_path}/csv", "csv").load(spark, "MSTR_TIENDAS")) == rows(stores)


def test_overwrite_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "01"), (2, "02")], "v int, month string")
    tables.write_table(df, path, partition_by=["month"])
    tables.write_table(df.where("v = 2").selectExpr("v * 10 AS v", "month"), path, partition_by=["month"], dynamic=True)
    assert rows(tables.read_table(spark, path, schema=df.schema)) == [(1, "01"), (20, "02")]
    tables.write_table(df.where("v = 1"), path, partition_by=["month"])
    assert rows(tables.read_table(spark, path, schema=df.schema)) == [(1, "01")]


def test_register_follows_a_moved_table(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        tables.write_table(spark.range(n).selectExpr("id", "id % 2 AS p"), str(tmp_path / name), partition_by=["p"])
    tables.register_table(spark, "reg_check.t", str(tmp_path / "a"))
    tables.register_table(spark, "reg_check.t", str(tmp_path / "a"))
    assert spark.table("reg_check.t").count() == 3
    tables.register_table(spark, "reg_check.t", str(tmp_path / "b"))
    assert spark.table("reg_check.t").count() == 5
    tables.write_table(spark.range(2).selectExpr("id", "9 AS p"), str(tmp_path / "b"), mode="append", partition_by=["p"])
    tables.register_table(spark, "reg_check.t", str(tmp_path / "b"))
    assert spark.table("reg_check.t").count() == 7
    assert path_exists(spark, str(tmp_path / "a"))


def test_stored_bytes_equals_files_on_disk(spark, tmp_path):
    tables.write_table(spark.range(100).selectExpr("id", "id % 3 AS p"), str(tmp_path / "t"), partition_by=["p"])
    on_disk = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    assert tables.stored_bytes(spark, str(tmp_path / "t")).first()["bytes"] == on_disk
    assert folder_bytes(spark, str(tmp_path / "t")) == on_disk


def test_materialize_uses_the_shared_folder(spark):
    df = materialize(spark.range(5), "check")
    path = df.inputFiles()[0]
    assert shared_folder(spark) in path
    assert df.count() == 5 and remove_path(spark, path)


def test_cluster_without_shared_folder_is_refused():
    cluster = MagicMock()
    cluster.conf.get.side_effect = lambda name, default=None: {"spark.master": "yarn"}.get(name, default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 1 << 40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    with sized_shuffles(spark, 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_broadcast_limit_is_the_sessions(spark):
    assert broadcast_limit(spark) == 64 << 20


def test_run_paths():
    run = BronzeRun("s3a://lake/bronze")
    assert run.table_path("TRANS_VENTAS") == "s3a://lake/bronze/trans_ventas"
    assert run.watermark_path != run.log_path


class TestJdbc:
    source = origins.JdbcSource("jdbc:x://host/db", {"user": "u", "driver": "d"}, rows_a_task=100)

    def reader(self, low_high):
        session = MagicMock()
        session.read.jdbc.return_value.first.return_value = low_high
        return session

    def test_parallel_read_by_key_range(self):
        session = self.reader((1, 900, 650))
        self.source.load(session, "TRANS_VENTAS")
        bounds, read = session.read.jdbc.call_args_list
        assert "MIN(id_trans)" in bounds.args[1] and "dbo.TRANS_VENTAS" in bounds.args[1]
        assert read.args[1] == "(SELECT * FROM dbo.TRANS_VENTAS) src"
        assert {k: read.kwargs[k] for k in ("column", "lowerBound", "upperBound", "numPartitions")} == {
            "column": "id_trans", "lowerBound": 1, "upperBound": 900, "numPartitions": 7}
        assert read.kwargs["properties"] == {"user": "u", "driver": "d", "fetchsize": "10000"}

    def test_bounds_are_those_of_the_rows_read(self):
        session = self.reader((880, 900, 20))
        self.source.load_after(session, "TRANS_VENTAS", "fec_trans", "2001-01-01 00:00:00")
        for call in session.read.jdbc.call_args_list:
            assert "WHERE fec_trans > '2001-01-01 00:00:00'" in call.args[1]

    def test_empty_table_is_read_plainly(self):
        session = self.reader((None, None, 0))
        self.source.load(session, "TRANS_VENTAS")
        assert "column" not in session.read.jdbc.call_args.kwargs

    def test_csv_is_inserted_in_chunks(self):
        session = MagicMock()
        origins.load_csv_to_jdbc(session, "p", TABLES["MSTR_TIENDAS"].schema, "url", "MSTR_TIENDAS", {"user": "u"})
        writer = session.read.schema.return_value.options.return_value.csv.return_value.repartition.return_value.write
        writer.mode.assert_called_once_with("overwrite")
        writer.mode.return_value.option.assert_called_once_with("batchsize", 5000)
        writer.mode.return_value.option.return_value.jdbc.assert_called_once_with("url", "MSTR_TIENDAS", properties={"user": "u"})
