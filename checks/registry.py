"""One query per operator over the given tables."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators import conform as C
from bodega.operators import ingest as I
from bodega.operators import files, layout, marts, model, quality, rfm
from bodega.operators.joins import heavy_keys, skew_join
from bodega.plans.bronze import BronzeRun, compact_store, ingest_all, read_bronze, read_misfits, read_watermarks
from bodega.plans.daily import DailyGold, read_daily, refresh_daily
from bodega.plans.full_run import run_medallion
from bodega.plans.gold import CLUSTERED, GOLD_TABLES, gold_rules, read_gold
from bodega.plans.incremental import IncrementalSilver, conform_all_new, read_current
from bodega.plans.quality_state import QualityState, measure_new, merged_report, merged_rules
from bodega.plans.silver import SilverRun, conform_all, read_silver
from bodega.schemas import AUDIT_SCHEMA, PARTITION_COLUMNS, STORED_PARTITIONS, TABLES, WATERMARK_SCHEMA
from bodega.session import folder_bytes, materialize, path_exists, scratch_path, sized_shuffles
from bodega.sources import tables as S
from bodega.sources import versions
from bodega.sources.origins import FileSource, FrameSource, read_full, read_incremental
from bodega.streaming.files import stream_batch, stream_to_bronze
from checks.fixtures import view

AS_OF = "2001-08-01"
SPLIT = "1999-06-30 00:00:00"
RUN_TS = dt.datetime(2001, 8, 1, 6, 0, tzinfo=dt.timezone.utc)
NEXT_TS = dt.datetime(2001, 8, 2, 6, 0, tzinfo=dt.timezone.utc)
SOURCE = "RETAIL_SOURCE"
SALES, MEMBERS, STORES = "TRANS_VENTAS", "CRM_MIEMBROS", "MSTR_TIENDAS"
AUDIT_COLUMNS = AUDIT_SCHEMA.names
STOCK, RETURNS = "INV_STOCK_DIARIO", "POST_DEVOLUCIONES"
FILE_BYTES = 256 << 20  # of a file that one task writes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Same values in types every engine prints alike."""
    def shown(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return value.cast("long").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):  # shown in UTC whatever the session's zone
            return F.to_utc_timestamp(value, F.current_timezone()).cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            return value.cast("string").alias(field.name)
        return value
    return df.select([shown(f) for f in df.schema])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_types(fn(spark, sf_dir))
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def audited(df: DataFrame, batch: str = "batch-1", ts: dt.datetime = RUN_TS) -> DataFrame:
    return I.add_audit_columns(df, SOURCE, batch, ts)


def source(spark: SparkSession, sf: str, **frames: DataFrame | None) -> FrameSource:
    """The seven source tables; keyword arguments replace one or (None) leave it out."""
    views = {name: frames.get(name, ...) for name in TABLES}
    return FrameSource({
        name: view(spark, sf, name.lower()) if df is ... else df
        for name, df in views.items() if df is not None})


def medallion_silver(spark: SparkSession, sf: str, tables: list[str]) -> SilverRun:
    """Bronze and silver of some tables, sales with their planted defects."""
    root = scratch_path(spark, "lake")
    bronze = BronzeRun(f"{root}/bronze", SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    ingest_all(spark, source(spark, sf, TRANS_VENTAS=view(spark, sf, "trans_ventas_raw")), bronze, tables)
    silver = SilverRun(f"{root}/silver", bronze)
    conform_all(spark, silver, tables)
    return silver


def sized(spark: SparkSession, sf: str):
    """Shuffles in number by the bytes of the sales, whatever the session's number."""
    return sized_shuffles(spark, sum(folder_bytes(spark, f"{sf}/{t}.parquet") for t in ("lineitem", "orders")))


def tagged_sales(spark: SparkSession, sf: str) -> DataFrame:
    members = view(spark, sf, "crm_miembros")
    return C.conform(view(spark, sf, "trans_ventas_raw"), TABLES[SALES], members)


def sales_fact(spark: SparkSession, sf: str) -> DataFrame:
    return model.fact_sales(view(spark, sf, "trans_ventas"), view(spark, sf, "crm_miembros"))


def known_sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales_fact(spark, sf).where("cliente_anonimo_flag = 0")


def products(spark: SparkSession, sf: str) -> DataFrame:
    return model.dim_products(view(spark, sf, "mstr_articulos"), view(spark, sf, "mstr_proveedores"))


# ---------------------------------------------------------------- sources and ingest

@query
def scan_full(spark, sf):
    """Suppliers in full, from Parquet files through the file source."""
    base = scratch_path(spark, "files")
    view(spark, sf, "mstr_proveedores").write.parquet(f"{base}/mstr_proveedores")
    return read_full(spark, FileSource(base), "MSTR_PROVEEDORES")


@query
def scan_incremental(spark, sf):
    return read_incremental(spark, source(spark, sf), SALES, "fec_trans", SPLIT)


@query
def scan_incremental_inclusive(spark, sf):
    """Rows equal to the watermark are read again."""
    return read_incremental(spark, source(spark, sf), SALES, "fec_trans", SPLIT, inclusive=True)


def monthly_watermarks(spark, sf) -> DataFrame:
    """A watermark store as monthly batches of three tables would have left it."""
    parts = []
    for table in (SALES, STOCK, RETURNS):
        column = TABLES[table].incremental
        month = F.date_trunc("month", F.col(column).cast("timestamp"))
        parts.append(
            view(spark, sf, table.lower()).groupBy(month.alias("version"))
            .agg(F.max(column).cast("string").alias("last_watermark"))
            .select(F.lit(table).alias("table_name"), "last_watermark",
                    F.date_format("version", "yyyy-MM").alias("batch_id"), "version"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def watermark_lookup(spark, sf):
    return I.latest_watermarks(monthly_watermarks(spark, sf))


@query
def watermark_advance(spark, sf):
    store = monthly_watermarks(spark, sf).where(F.col("version") <= F.lit(SPLIT).cast("timestamp"))
    batch = read_incremental(spark, source(spark, sf), SALES, "fec_trans", SPLIT)
    new = I.batch_watermark(batch, "fec_trans", cap=AS_OF).select(
        F.lit(SALES).alias("table_name"), "last_watermark",
        F.lit("batch-2").alias("batch_id"), F.lit(RUN_TS).alias("version"))
    return I.advance_watermark(store.select(WATERMARK_SCHEMA.names), new)


@query
def audit_columns(spark, sf):
    return audited(view(spark, sf, "post_devoluciones"))


@query
def append_partitioned(spark, sf):
    """Two batches on two days appended to one table; rows and quantity per partition."""
    path = scratch_path(spark, "append")
    sales = view(spark, sf, "trans_ventas")
    early = F.col("fec_trans") <= F.lit(SPLIT).cast("timestamp_ntz")
    for rows, batch, ts in ((sales.where(early), "batch-1", RUN_TS), (sales.where(~early), "batch-2", NEXT_TS)):
        S.append_partitioned(audited(rows, batch, ts), path, PARTITION_COLUMNS)
    run = BronzeRun(path)
    stored = S.read_table(spark, path, run.fmt, audited(sales).schema)
    return stored.groupBy(*PARTITION_COLUMNS, "batch_id").agg(
        F.count("*").alias("n"), F.sum("qty_vendida").alias("qty"))


def two_runs(spark, sf, table, before, after) -> tuple[DataFrame, BronzeRun]:
    root = scratch_path(spark, "bronze")
    first = BronzeRun(root, SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    second = BronzeRun(root, SOURCE, batch_id="batch-2", run_ts=NEXT_TS)
    ingest_all(spark, FrameSource({table: before}), first, [table])
    return ingest_all(spark, FrameSource({table: after}), second, [table]), second


@query
def ingest_empty_batch(spark, sf):
    """A second run without new rows: logged, nothing stored, watermark kept."""
    sales = view(spark, sf, "trans_ventas")
    log, run = two_runs(spark, sf, SALES, sales, sales)
    marks = I.latest_watermarks(read_watermarks(spark, run))
    stored = read_bronze(spark, run, SALES).groupBy().agg(F.count("*").alias("stored_rows"))
    return (log.select("table_name", "record_count", "status", "error_message")
            .join(marks, "table_name", "left")
            .withColumn("stored_rows", stored.scalar()))


@query
def ingest_incremental(spark, sf):
    """Bronze rows after two runs, the second reading past the first one's watermark."""
    sales = view(spark, sf, "trans_ventas")
    before = sales.where(F.col("fec_trans") <= F.lit(SPLIT).cast("timestamp_ntz"))
    _, run = two_runs(spark, sf, SALES, before, sales)
    return I.committed_rows(read_bronze(spark, run, SALES), read_watermarks(spark, run), SALES)


@query
def stored_bytes(spark, sf):
    """Rows stored, and whether the listing's bytes are those of the files the table reads."""
    path = scratch_path(spark, "bytes")
    S.append_partitioned(audited(view(spark, sf, "trans_ventas")), path, PARTITION_COLUMNS)
    stored = spark.read.parquet(path)
    files = sum(folder_bytes(spark, f) for f in stored.inputFiles())
    return S.stored_bytes(spark, path).select((F.col("bytes") == files).alias("bytes_match")).withColumn(
        "rows", stored.agg(F.count("*")).scalar())


@query
def ingest_log(spark, sf):
    """The stored log of one run over all tables."""
    run = BronzeRun(scratch_path(spark, "bronze"), SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    ingest_all(spark, source(spark, sf), run)
    return S.read_table(spark, run.log_path).select("table_name", "record_count", "batch_id", "status", "error_message")


@query
def ingest_all_(spark, sf):
    """A missing table fails alone; the others are loaded."""
    run = BronzeRun(scratch_path(spark, "bronze"), SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    log = ingest_all(spark, source(spark, sf, MSTR_TIENDAS=None), run)
    return log.select("table_name", "record_count", "status")


@query
def export_roundtrip(spark, sf):
    """Articles written as CSV and Parquet and read back with the explicit schema."""
    schema = TABLES["MSTR_ARTICULOS"].schema
    folders = S.export_table(view(spark, sf, "mstr_articulos"), scratch_path(spark, "export"))
    csv = S.read_csv(spark, folders["csv"], schema).withColumn("fmt", F.lit("csv"))
    return csv.unionByName(S.read_table(spark, folders["parquet"]).withColumn("fmt", F.lit("parquet")))


@query
def stream_ingest(spark, sf):
    """The same incremental append for landed files, by Structured Streaming."""
    base = scratch_path(spark, "stream")
    view(spark, sf, "post_devoluciones").write.parquet(f"{base}/in")
    stream_to_bronze(spark, RETURNS, f"{base}/in", f"{base}/out", f"{base}/log", SOURCE, "batch-1", RUN_TS).awaitTermination()
    return S.read_table(spark, f"{base}/out", schema=audited(view(spark, sf, "post_devoluciones")).schema)


# ---------------------------------------------------------------- conform and quality

@query
def scan_table(spark, sf):
    return S.read_table(spark, f"{sf}/orders.parquet")


@query
def dedup_rows(spark, sf):
    return C.dedup(view(spark, sf, "trans_ventas_raw"))


@query
def dedup_newest_per_key(spark, sf):
    """Members loaded twice, the second time with changes: the newest row per member."""
    members = view(spark, sf, "crm_miembros")
    later = members.where("activo").withColumn("rango_edad", F.lit("60+"))
    both = audited(members).unionByName(audited(later, "batch-2", NEXT_TS))
    return C.dedup(both, ["id_miembro"])


@query
def mandatory_valid(spark, sf):
    return C.split_mandatory(view(spark, sf, "trans_ventas_raw"), TABLES[SALES].mandatory)[0]


@query
def mandatory_rejected(spark, sf):
    return C.split_mandatory(view(spark, sf, "trans_ventas_raw"), TABLES[SALES].mandatory)[1]


@query
def hash_pii(spark, sf):
    return C.hash_columns(view(spark, sf, "crm_miembros"), ["id_ciudad"])


@query
def cast_boolean(spark, sf):
    text = F.when(F.col("genero") == "M", "true").when(F.col("genero") == "F", "0").otherwise("?")
    members = view(spark, sf, "crm_miembros").withColumn("activo", text)
    return C.cast_columns(members.select("id_miembro", "activo"), {"activo": "boolean"})


@query
def null_flag_fill(spark, sf):
    return C.flag_and_fill(view(spark, sf, "crm_miembros"), TABLES[MEMBERS].defaults)


@query
def fk_rejected(spark, sf):
    return C.fk_rejects(view(spark, sf, "trans_ventas"), view(spark, sf, "crm_miembros"), "id_miembro", "INVALID_CUSTOMER_ID")


@query
def fk_valid(spark, sf):
    return C.fk_valid(view(spark, sf, "trans_ventas"), view(spark, sf, "crm_miembros"), "id_miembro")


@query
def fk_valid_inner(spark, sf):
    """The inner form repeats a sale once per stored copy of its member."""
    members = view(spark, sf, "crm_miembros")
    twice = members.unionAll(members.where("activo"))
    return C.fk_valid(view(spark, sf, "trans_ventas"), twice, "id_miembro", how="inner")


@query
def quarantine_union(spark, sf):
    """Conformed sales written by reject cause; the rejects of all causes read back."""
    path = scratch_path(spark, "quarantine")
    tagged = tagged_sales(spark, sf)
    with sized(spark, sf):
        S.write_table(tagged, path, partition_by=[C.REASON])
    return C.rejected(S.read_table(spark, path, schema=tagged.schema))


@query
def quality_report(spark, sf):
    original = view(spark, sf, "trans_ventas_raw").agg(F.count("*")).scalar()
    return quality.quality_report(tagged_sales(spark, sf), SALES, original, "batch-1")


@query
def silver_summary(spark, sf):
    """The stored summary of a silver run over sales and members."""
    silver = medallion_silver(spark, sf, [MEMBERS, SALES])
    stored = S.read_table(spark, silver.summary_path)
    return stored.where(F.col("table_name") == SALES).drop("duration_seconds", "batch_id")


@query
def silver_ventas(spark, sf):
    return C.accepted(tagged_sales(spark, sf))


@query
def silver_ventas_salted(spark, sf):
    """The same with hot members salted."""
    raw, members = view(spark, sf, "trans_ventas_raw"), view(spark, sf, "crm_miembros")
    hot = heavy_keys(raw, "id_miembro", share=0, limit=20)
    return C.accepted(C.conform(raw, TABLES[SALES], members, hot_keys=hot))


@query
def silver_clientes(spark, sf):
    return C.accepted(C.conform(view(spark, sf, "crm_miembros"), TABLES[MEMBERS]))


# ---------------------------------------------------------------- dimensions and facts

@query
def dim_clientes(spark, sf):
    return model.dim_customers(view(spark, sf, "crm_miembros"), AS_OF)


@query
def dim_tiendas(spark, sf):
    return model.dim_stores(view(spark, sf, "mstr_tiendas"))


@query
def dim_productos(spark, sf):
    return products(spark, sf)


@query
def fact_ventas(spark, sf):
    return model.fact_sales(audited(view(spark, sf, "trans_ventas")), view(spark, sf, "crm_miembros"))


@query
def fact_ventas_salted(spark, sf):
    sales = audited(view(spark, sf, "trans_ventas"))
    hot = heavy_keys(sales, "id_miembro", share=0, limit=20)
    return model.fact_sales(sales, view(spark, sf, "crm_miembros"), hot)


def inventory(spark, sf) -> DataFrame:
    return model.fact_inventory(view(spark, sf, "inv_stock_diario"), products(spark, sf))


@query
def fact_inventario(spark, sf):
    return inventory(spark, sf)


@query
def stockout_alerts(spark, sf):
    return model.stockout_alerts(inventory(spark, sf))


def returns_fact(spark, sf, **hot) -> DataFrame:
    return model.fact_returns(view(spark, sf, "post_devoluciones"), sales_fact(spark, sf), products(spark, sf), **hot)


@query
def fact_devoluciones(spark, sf):
    return returns_fact(spark, sf)


@query
def fact_devoluciones_salted(spark, sf):
    """The same with hot transactions and articles salted on both sides."""
    sales, back = view(spark, sf, "trans_ventas"), view(spark, sf, "post_devoluciones")
    return returns_fact(
        spark, sf, hot_sales=heavy_keys(sales, "id_trans", share=0, limit=20),
        hot_returns=heavy_keys(back, "id_trans_origen", share=0, limit=20),
        hot_articles=heavy_keys(back, "art_id", share=0, limit=20))


# ---------------------------------------------------------------- segmentation

@query
def rfm_active(spark, sf):
    return rfm.active_customers(known_sales(spark, sf), AS_OF)


@query
def sales_last_90(spark, sf):
    return rfm.sales_since(known_sales(spark, sf), AS_OF)


@query
def rfm_sales(spark, sf):
    sales = known_sales(spark, sf)
    return rfm.restrict_to(rfm.sales_since(sales, AS_OF), rfm.active_customers(sales, AS_OF))


def metrics(spark, sf) -> DataFrame:
    return rfm.rfm_metrics(known_sales(spark, sf), AS_OF)


@query
def rfm_metrics(spark, sf):
    return metrics(spark, sf)


@query
def rfm_metrics_wide_window(spark, sf):
    """A window longer than the activity limit, where the limit does remove customers."""
    return rfm.rfm_metrics(known_sales(spark, sf), AS_OF, days=400, active_days=30)


@query
def rfm_scores(spark, sf):
    return rfm.rfm_scores(metrics(spark, sf))


@query
def rfm_scores_distributed(spark, sf):
    """The same tiles; kept as a query of its own for its time."""
    return rfm.rfm_scores(metrics(spark, sf))


@query
def rfm_scores_best_is_5(spark, sf):
    return rfm.rfm_scores(metrics(spark, sf), order="best_is_5")


@query
def rfm_segments(spark, sf):
    return rfm.rfm_segments(rfm.rfm_scores(metrics(spark, sf)))


@query
def rfm_groups(spark, sf):
    return rfm.rfm_groups(rfm.rfm_segments(rfm.rfm_scores(metrics(spark, sf))))


# ---------------------------------------------------------------- marts and rules

@query
def agg_ventas_diarias(spark, sf):
    return marts.daily_sales(sales_fact(spark, sf), products(spark, sf))


@query
def agg_devoluciones_categoria(spark, sf):
    return marts.returns_by_category(returns_fact(spark, sf))


@query
def kpi_ejecutivo_diario(spark, sf):
    return marts.executive_kpis(sales_fact(spark, sf))


@query
def dq_results(spark, sf):
    """The five gold rules, over sales with repeated rows and stock with negative counts."""
    raw = model.fact_sales(view(spark, sf, "trans_ventas_raw"), view(spark, sf, "crm_miembros"))
    with sized(spark, sf):
        return gold_rules(raw, inventory(spark, sf), rfm.rfm_groups(rfm.rfm_scores(metrics(spark, sf))))


@query
def dq_duplicate_keys(spark, sf):
    return quality.duplicate_rows(view(spark, sf, "trans_ventas_raw"), ["id_trans"])


@query
def dq_duplicate_rows(spark, sf):
    return quality.check_no_duplicates(view(spark, sf, "trans_ventas_raw"), "trans_ventas_no_duplicates")


@query
def dq_negative_stock(spark, sf):
    return view(spark, sf, "inv_stock_diario").where(quality.in_range("stock", "stock_fisico", low=0).violation)


# ---------------------------------------------------------------- layout, catalog, full run

@query
def write_roundtrip(spark, sf):
    """A table overwritten by another one and read back."""
    path = scratch_path(spark, "overwrite")
    S.write_table(view(spark, sf, "mstr_tiendas"), path)
    S.write_table(model.dim_stores(view(spark, sf, "mstr_tiendas")), path)
    return S.read_table(spark, path)


@query
def write_partitioned(spark, sf):
    """Sales by date; then only the dates from 2001 on are replaced, with quantities doubled."""
    path = scratch_path(spark, "by-date")
    sales = sales_fact(spark, sf).select("id_trans", "canal_venta", "qty_vendida", F.col("fec_venta"))
    S.write_table(sales, path, partition_by=["fec_venta"], rebalance=True)
    late = sales.where("fec_venta >= '2001-01-01'").withColumn("qty_vendida", F.col("qty_vendida") * 2)
    S.write_table(late, path, partition_by=["fec_venta"], rebalance=True, dynamic=True)
    return S.read_table(spark, path, schema=sales.schema)


@query
def cluster_zorder(spark, sf):
    """Sales laid out along three columns; the layout keeps every row."""
    path = scratch_path(spark, "zorder")
    sales = sales_fact(spark, sf).select("id_trans", "canal_venta", "art_id", "id_tienda", "vr_venta_neto")
    S.write_table(layout.cluster(sales, ["canal_venta", "art_id", "id_tienda"]), path)
    return S.read_table(spark, path)


@query
def catalog_roundtrip(spark, sf):
    """Returns mart registered over its path and read by name."""
    path = scratch_path(spark, "mart")
    S.write_table(marts.returns_by_category(returns_fact(spark, sf)), path)
    S.register_table(spark, "gold_check.agg_devoluciones_categoria", path)
    return spark.table("gold_check.agg_devoluciones_categoria")


@query
def preview_rows(spark, sf):
    return marts.preview(products(spark, sf), ["art_id"])


def full_run(spark, sf, root: str | None = None, **frames):
    """One medallion run over the seven source tables, sales with their planted defects."""
    frames = {"TRANS_VENTAS": view(spark, sf, "trans_ventas_raw")} | frames
    return run_medallion(spark, source(spark, sf, **frames), root or scratch_path(spark, "lake"), AS_OF,
                         source_system=SOURCE, batch_id="batch-1", run_ts=RUN_TS)


@query
def raw_to_kpi(spark, sf):
    """Raw sales conformed, valued and summed up to the executive KPIs in one lazy plan."""
    members = C.accepted(C.conform(view(spark, sf, "crm_miembros"), TABLES[MEMBERS]))
    sales = C.accepted(C.conform(audited(view(spark, sf, "trans_ventas_raw")), TABLES[SALES], members))
    return marts.executive_kpis(model.fact_sales(sales, members))


@query
def end_to_end_kpi(spark, sf):
    """Source tables through bronze, silver and gold to the executive KPIs."""
    return read_gold(spark, full_run(spark, sf).gold, "kpi_ejecutivo_diario")


@query
def end_to_end_rfm(spark, sf):
    return read_gold(spark, full_run(spark, sf).gold, "fact_rfm_clientes")


@query
def end_to_end_missing_table(spark, sf):
    """Without stores and returns the run goes on: what it built, and the rows of one mart."""
    gold = full_run(spark, sf, MSTR_TIENDAS=None, POST_DEVOLUCIONES=None).gold
    built = [t for t in GOLD_TABLES if path_exists(spark, gold.path(t))]
    kpi = read_gold(spark, gold, "kpi_ejecutivo_diario").agg(F.count("*")).scalar()
    return spark.createDataFrame([(t,) for t in built], "table_name string").withColumn("kpi_rows", kpi)


@query
def end_to_end_empty_table(spark, sf):
    """A source table without rows, returns, stops nothing: the executive KPIs."""
    none = view(spark, sf, "post_devoluciones").limit(0)
    return read_gold(spark, full_run(spark, sf, POST_DEVOLUCIONES=none).gold, "kpi_ejecutivo_diario")


@query
def dim_productos_after_two_runs(spark, sf):
    """Suppliers are loaded in full by every run; articles still come out once each."""
    root = scratch_path(spark, "lake")
    tables = {t: view(spark, sf, t.lower()) for t in ("MSTR_ARTICULOS", "MSTR_PROVEEDORES")}
    for batch, ts in (("batch-1", RUN_TS), ("batch-2", NEXT_TS)):
        run = run_medallion(spark, FrameSource(tables), root, AS_OF, source_system=SOURCE, batch_id=batch, run_ts=ts)
    return read_gold(spark, run.gold, "dim_productos")


@query
def ingest_overlap(spark, sf):
    """Three runs whose cap keeps later sales from moving the watermark: silver still has each once."""
    root = scratch_path(spark, "lake")
    sales = FrameSource({SALES: view(spark, sf, "trans_ventas")})
    for i in range(3):
        bronze = BronzeRun(f"{root}/bronze", SOURCE, batch_id=f"batch-{i}", run_ts=RUN_TS + dt.timedelta(days=i), max_date=AS_OF)
        ingest_all(spark, sales, bronze, [SALES])
    silver = SilverRun(f"{root}/silver", bronze)
    conform_all(spark, silver, [SALES])
    return read_silver(spark, silver, SALES).drop(*AUDIT_COLUMNS)


@query
def dedup_null_keys(spark, sf):
    """Sales without an article are not one another's copies."""
    return C.dedup(view(spark, sf, "trans_ventas_raw"), ["art_id", "id_trans"])


@query
def skew_join_absent_key(spark, sf):
    """A key said to be hot on the right that the right side lacks keeps its left rows."""
    returns = view(spark, sf, "post_devoluciones").select("id_devolucion", "art_id")
    articles = view(spark, sf, "mstr_articulos").where("art_id % 2 = 0").select(F.col("art_id").alias("articulo"), "desc_art")
    hot = dict.fromkeys([r[0] for r in view(spark, sf, "mstr_articulos").select("art_id").orderBy("art_id").limit(20).collect()], 10**7)
    return skew_join(returns, articles, "art_id", "articulo", hot_left=hot, hot_right=hot)


@query
def stream_to_silver(spark, sf):
    """Returns that arrive as files are streamed to bronze, committed, and read by silver."""
    root = scratch_path(spark, "stream")
    view(spark, sf, "post_devoluciones").write.parquet(f"{root}/in")
    bronze = BronzeRun(f"{root}/bronze", SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    stream_batch(spark, bronze, RETURNS, f"{root}/in", f"{root}/log")
    silver = SilverRun(f"{root}/silver", bronze)
    conform_all(spark, silver, [RETURNS])
    return read_silver(spark, silver, RETURNS)


@query
def ingest_text_types(spark, sf):
    """A source with dates as text and money as floats, some dates unreadable: silver rows, and misfits kept."""
    root = scratch_path(spark, "types")
    sales = view(spark, sf, "trans_ventas")
    text = sales.withColumns({
        "fec_trans": F.when(F.col("id_trans") % 101 == 0, "no date").otherwise(F.col("fec_trans").cast("string")),
        "precio_unitario_venta": F.col("precio_unitario_venta").cast("double"),
        "descuento_aplicado": F.col("descuento_aplicado").cast("double"),
        "id_trans": F.col("id_trans").cast("string")})
    bronze = BronzeRun(f"{root}/bronze", SOURCE, batch_id="batch-1", run_ts=RUN_TS)
    ingest_all(spark, FrameSource({SALES: text}), bronze, [SALES])
    silver = SilverRun(f"{root}/silver", bronze)
    conform_all(spark, silver, [SALES])
    fits = read_silver(spark, silver, SALES).drop(*AUDIT_COLUMNS).withColumn("error_columns", F.lit(None).cast("string"))
    kept = S.read_table(spark, bronze.misfit_path(SALES))
    unfit = kept.select(F.get_json_object("row", "$.id_trans").cast("long").alias("id_trans"), "error_columns")
    return fits.unionByName(unfit, allowMissingColumns=True)


@query
def scan_csv(spark, sf):
    """Stock read incrementally from CSV files through the file source."""
    base = scratch_path(spark, "csv")
    view(spark, sf, "inv_stock_diario").write.options(header="true", nullValue="").csv(f"{base}/inv_stock_diario")
    return read_incremental(spark, FileSource(base, "csv"), STOCK, "fec_snapshot", SPLIT[:10])


# ---------------------------------------------------------------- upkeep: files, versions, batches

@query
def compact_small_files(spark, sf):
    """Half of the sales in one file (or several of ``FILE_BYTES``) and the rest in 20 appends of as many small ones; the small files
    are merged, the large ones stay."""
    path = scratch_path(spark, "compact")
    part = F.least(F.pmod(F.xxhash64("id_trans"), F.lit(40)), F.lit(20)).alias("_part")
    parts = scratch_path(spark, "sales")  # by append, so that each append reads its own rows only
    S.write_table(view(spark, sf, "trans_ventas").select("*", part), parts, partition_by=["_part"])
    many = max(1, math.ceil(folder_bytes(spark, f"{parts}/_part=20") / FILE_BYTES))  # one file, as long as one task can write it
    split = S.read_table(spark, parts)
    sales = split.drop("_part")
    for i in (20, *range(20)):
        appended = split.where(f"_part = {i}").drop("_part")
        S.write_table(appended.coalesce(1) if many == 1 else appended.repartition(many), path, mode="append")
    before = {r["path"]: r["bytes"] for r in files.listed(spark, path).collect()}
    target = max(before.values())
    files.compact(spark, path, sales.schema, target=target)
    again = files.compact(spark, path, sales.schema, target=target)
    after = {r["path"]: r["bytes"] for r in files.listed(spark, path).collect()}
    large = {p for p, size in before.items() if size >= files.SMALL * target}
    return S.read_table(spark, path, schema=sales.schema).agg(
        F.count("*").alias("rows"), F.sum("qty_vendida").alias("qty"), F.sum("descuento_aplicado").alias("discount")).withColumns({
            "fewer": F.lit(2 * len(after) < len(before)), "none_above": F.lit(max(after.values()) <= target),
            "large_kept": F.lit(large <= set(after)), "rewritten_again": F.lit(again.rewritten).cast("long")})


@query
def cluster_skips_files(spark, sf):
    """Of each column of the three clustered tables: rows of one value read through the zone map, and whether clustering
    leaves less than half of the files to be opened."""
    tables = {
        "fact_ventas": (sales_fact(spark, sf), {"canal_venta": "Web", "art_id": 77, "id_tienda": 3}),
        "fact_inventario": (inventory(spark, sf), {"art_id": 77, "id_tienda": 3}),
        "fact_rfm_clientes": (rfm.rfm_groups(rfm.rfm_scores(metrics(spark, sf))), {"grupo_valor": "Champions"}),
    }
    found = []
    for name, (rows, values) in tables.items():
        rows = materialize(rows, name)
        columns = CLUSTERED[name]
        zones = {}
        for kind, laid in (("clustered", layout.cluster(rows, columns, files=32)), ("plain", rows.coalesce(32))):
            path = scratch_path(spark, kind)
            S.write_table(laid, path)
            zones[kind] = files.ZoneMap(path, f"{path}-zones", rows.schema, columns)
            zones[kind].refresh(spark)
        for column, value in values.items():
            ranges = {column: (value, value)}
            share = {k: z.files(spark, ranges).count() / files.listed(spark, z.path).count() for k, z in zones.items()}
            read = zones["clustered"].scan(spark, ranges).count()
            found.append((name, column, read, share["clustered"] < 0.5 * share["plain"]))
    return spark.createDataFrame(found, "table_name string, column_name string, rows bigint, skips boolean")


def resent(sales: DataFrame, which: str = "id_trans % 50 = 1") -> DataFrame:
    """Every fiftieth sale again, ten years later and with one piece more."""
    return sales.where(which).withColumns({
        "fec_trans": F.expr("fec_trans + INTERVAL 10 YEARS"), "qty_vendida": F.col("qty_vendida") + 1})


def three_runs(spark, sf, check=lambda silver, n: None, again=resent) -> IncrementalSilver:
    """Three bronze runs, each followed by an incremental silver run: early members and sales, then all, then corrections."""
    root = scratch_path(spark, "incremental")
    sales, members = (materialize(view(spark, sf, t), t) for t in ("trans_ventas_raw", "crm_miembros"))
    early, known = F.col("fec_trans") <= F.lit(SPLIT).cast("timestamp_ntz"), F.col("fec_ultima_compra") <= "1992-01-01"
    runs = ((sales.where(early), members.where(known)), (sales, members), (again(sales), members))
    for n, (sold, people) in enumerate(runs):
        bronze = BronzeRun(f"{root}/bronze", SOURCE, batch_id=f"batch-{n}", run_ts=RUN_TS + dt.timedelta(days=n))
        ingest_all(spark, FrameSource({SALES: sold, MEMBERS: people}), bronze, [MEMBERS, SALES])
        silver = IncrementalSilver(f"{root}/silver", bronze, buckets=16)
        conform_all_new(spark, silver, [MEMBERS, SALES])
        check(silver, n)
    return silver


@query
def silver_incremental(spark, sf):
    """Sales in force after three incremental runs, with their reject cause."""
    return read_current(spark, three_runs(spark, sf), SALES).drop(*AUDIT_COLUMNS)


FEW = "id_trans % 1000 = 1"


def three_refreshes(spark, sf, check=lambda daily, row, n: None) -> DailyGold:
    """The three incremental runs, after each of which fact and marts are brought up to date month by month. Few sales are corrected."""
    root, sold = scratch_path(spark, "daily"), materialize(view(spark, sf, "mstr_articulos").select("art_id", "id_categ_n1"), "articles")

    def refresh(silver: IncrementalSilver, n: int) -> None:
        daily = DailyGold(root, silver, "month")
        moved = F.when((F.col("art_id") == 77) & F.lit(n == 2), F.lit("MOVED")).otherwise(F.col("id_categ_n1"))
        check(daily, refresh_daily(spark, daily, sold.withColumn("id_categ_n1", moved)), n)

    return DailyGold(root, three_runs(spark, sf, refresh, lambda sales: resent(sales, FEW)), "month")


def files_of_periods(spark, daily: DailyGold, table: str) -> DataFrame:
    """(periodo, file) of a dated table."""
    return read_daily(spark, daily, table).select("periodo", F.col("_metadata.file_name").alias("file")).distinct()


def refreshed(spark, sf, table: str) -> DataFrame:
    """A mart after three refreshes, and whether the last one wrote the row's month."""
    before = {}

    def look(daily, row, n):
        if n == 1:
            before["files"] = materialize(files_of_periods(spark, daily, table), "files")

    daily = three_refreshes(spark, sf, look)
    written = files_of_periods(spark, daily, table).join(before["files"], ["periodo", "file"], "left_anti")
    written = written.select("periodo").distinct().withColumn("_written", F.lit(True))
    return read_daily(spark, daily, table).join(written, "periodo", "left").withColumn(
        "rewritten", F.coalesce("_written", F.lit(False))).drop("_written", "periodo")


@query
def kpi_changed_dates(spark, sf):
    """Executive KPIs of which the third refresh, with corrected sales, writes the months these left or came to."""
    return refreshed(spark, sf, "kpi_ejecutivo_diario")


@query
def daily_sales_changed_dates(spark, sf):
    """Daily sales by category; the third refresh also writes the months of an article that changed its category."""
    return refreshed(spark, sf, "agg_ventas_diarias")


def three_measures(spark, sf, check=lambda state, new, n: None) -> QualityState:
    """The three incremental runs, after each of which the new versions of buckets are counted."""
    root = scratch_path(spark, "quality")

    def state(silver: IncrementalSilver) -> QualityState:
        return QualityState(root, silver, {SALES: [
            quality.not_null("fact_ventas_pk_not_null", "id_trans"), quality.in_range("a_piece_at_least", "qty_vendida", low=2)]},
            {SALES: "fact_ventas_no_duplicates"})

    return state(three_runs(spark, sf, lambda silver, n: check(state(silver), measure_new(spark, state(silver), SALES), n)))


@query
def quality_report_merged(spark, sf):
    """The column report after three runs, summed from the counts each run took of what it wrote."""
    report = merged_report(spark, three_measures(spark, sf), SALES, "batch-2")
    return report.where(~F.col("column_name").isin(AUDIT_COLUMNS))


@query
def rules_merged(spark, sf):
    """Row rules and repeated rows after three runs, summed in the same way."""
    return merged_rules(spark, three_measures(spark, sf), SALES)


@query
def overwrite_survives_failure(spark, sf):
    """Stores overwritten by a job that dies midway: the version before, read by path and by name."""
    path = scratch_path(spark, "versions")
    stores = view(spark, sf, "mstr_tiendas")
    name = f"versions_check.tiendas_{path[-8:]}"
    versions.overwrite(stores, path, name=name)
    dies = stores.withColumn("id_tienda", F.when(F.col("id_tienda") == 7, F.raise_error(F.lit("dies here")).cast("long"))
                             .otherwise(F.col("id_tienda") + 1000))
    try:
        versions.overwrite(dies.repartition(4, "id_tienda"), path, name=name)
    except Exception as error:  # noqa: BLE001 - whatever Spark wraps it in
        if "dies here" not in str(error):
            raise
    by_path = versions.read_current(spark, path, schema=stores.schema).withColumn("read_by", F.lit("path"))
    return by_path.unionByName(spark.table(name).withColumn("read_by", F.lit("name")))


@query
def ingest_misfits_once(spark, sf):
    """Three runs over sales of which some dates cannot be read: each such row is kept apart once."""
    root = scratch_path(spark, "misfits")
    text = view(spark, sf, "trans_ventas").withColumn(
        "fec_trans", F.when(F.col("id_trans") % 101 == 0, "no date").otherwise(F.col("fec_trans").cast("string")))
    given = materialize(text, "text-sales")
    for n in range(3):
        run = BronzeRun(root, SOURCE, batch_id=f"batch-{n}", run_ts=RUN_TS + dt.timedelta(days=n))
        ingest_all(spark, FrameSource({SALES: given}), run, [SALES])
    return read_misfits(spark, run, SALES).select(
        F.get_json_object("row", "$.id_trans").cast("long").alias("id_trans"), "error_columns", "batch_id")


@query
def ingest_null_dates(spark, sf):
    """Sales without a date, some of them arriving late: each is loaded by the first run that sees it, and once."""
    root = scratch_path(spark, "undated")
    sales = materialize(view(spark, sf, "trans_ventas").withColumn(
        "fec_trans", F.when(F.col("id_trans") % 103 != 0, F.col("fec_trans"))), "undated-sales")
    early = (F.col("fec_trans") <= F.lit(SPLIT).cast("timestamp_ntz")) | (F.col("fec_trans").isNull() & (F.col("art_id") % 2 == 0))
    for n, given in enumerate((sales.where(early), sales, sales)):
        run = BronzeRun(root, SOURCE, batch_id=f"batch-{n}", run_ts=RUN_TS + dt.timedelta(days=n))
        ingest_all(spark, FrameSource({SALES: given}), run, [SALES])
    return I.committed_rows(read_bronze(spark, run, SALES), read_watermarks(spark, run), SALES).select("id_trans", "fec_trans", "batch_id")


def thousand_batches(spark, sf) -> BronzeRun:
    """Sales as a thousand batches, of which every third has no watermark row."""
    run = BronzeRun(scratch_path(spark, "batches"), SOURCE, batch_id="batch-1000", run_ts=RUN_TS)
    batch = F.format_string("batch-%03d", F.pmod("id_trans", F.lit(1000)))
    rows = audited(view(spark, sf, "trans_ventas")).withColumn("batch_id", batch)
    S.append_partitioned(rows.repartition("batch_id"), run.table_path(SALES), STORED_PARTITIONS)
    marks = spark.range(1000).where("id % 3 <> 0").select(
        F.lit(SALES).alias("table_name"), F.lit(SPLIT).alias("last_watermark"),
        F.format_string("batch-%03d", "id").alias("batch_id"), F.lit(RUN_TS).alias("version"))
    marks.repartition(40).write.parquet(run.watermark_path)
    compact_store(spark, run, most=20)
    return run


@query
def committed_thousand_batches(spark, sf):
    """Rows and pieces of the committed batches, told by the watermark store, whose small files are merged first."""
    run = thousand_batches(spark, sf)
    done = I.committed_rows(read_bronze(spark, run, SALES), read_watermarks(spark, run), SALES)
    return done.groupBy("batch_id").agg(F.count("*").alias("rows"), F.sum("qty_vendida").alias("qty"))
