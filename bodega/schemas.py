"""Explicit schemas and per-table rules of the seven source tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": T.DecimalType(12, 2),
    "discount": T.DecimalType(17, 4),
    "refund": T.DecimalType(14, 2),
}


def _schema(text: str) -> T.StructType:
    pairs = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class ForeignKey:
    """Rows whose ``key`` is missing in ``parent`` are rejected with ``reason``."""

    parent: str
    key: str
    reason: str


@dataclass(frozen=True)
class TableSpec:
    """What ingest and conform need to know about one source table."""

    name: str
    silver: str
    key: str
    mandatory: tuple[str, ...]
    schema: T.StructType
    incremental: str | None = None
    hashed: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    foreign_key: ForeignKey | None = None


NULL_REASON = "NULL_MANDATORY_FIELD"

# Order matters: members are conformed before the sales that refer to them.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "MSTR_ARTICULOS", "dim_articulos", "art_id", ("art_id", "cod_barra"),
            _schema("art_id:long cod_barra:string desc_art:string id_categ_n1:string"
                    " id_categ_n2:string id_categ_n3:string id_proveedor:long precio_lista:money"
                    " peso_kg:double unid_medida:string activo:boolean fec_alta:date"),
            incremental="fec_alta",
        ),
        TableSpec(
            "MSTR_PROVEEDORES", "dim_proveedores", "id_proveedor", ("id_proveedor", "razon_social"),
            _schema("id_proveedor:long razon_social:string pais_origen:string"
                    " tiempo_repo_dias:int calificacion_calidad:double activo:boolean"),
        ),
        TableSpec(
            "MSTR_TIENDAS", "dim_tiendas", "id_tienda", ("id_tienda", "nom_tienda"),
            _schema("id_tienda:long nom_tienda:string tipo_tienda:string id_ciudad:string"
                    " id_pais:string metros_cuadrados:double activo:boolean fec_apertura:date"),
            incremental="fec_apertura",
        ),
        TableSpec(
            "CRM_MIEMBROS", "dim_clientes", "id_miembro", ("id_miembro",),
            _schema("id_miembro:long fec_registro:date id_ciudad:string genero:string"
                    " rango_edad:string canal_pref:string activo:boolean fec_ultima_compra:date"),
            incremental="fec_ultima_compra",
            hashed=("id_ciudad",),
            defaults={"canal_pref": "NO_DEFINIDO"},
        ),
        TableSpec(
            "TRANS_VENTAS", "fact_ventas", "id_trans", ("id_trans", "id_miembro", "art_id"),
            _schema("id_trans:long id_miembro:long id_tienda:long art_id:long fec_trans:timestamp"
                    " hra_trans:string qty_vendida:int precio_unitario_venta:money"
                    " descuento_aplicado:discount tipo_pago:string canal_venta:string"),
            incremental="fec_trans",
            foreign_key=ForeignKey("CRM_MIEMBROS", "id_miembro", "INVALID_CUSTOMER_ID"),
        ),
        TableSpec(
            "INV_STOCK_DIARIO", "fact_stock_diario", "id_snapshot", ("id_snapshot", "art_id"),
            _schema("id_snapshot:long art_id:long id_tienda:long fec_snapshot:date"
                    " stock_fisico:int stock_transito:int stock_reservado:int"
                    " stock_minimo_config:int stock_maximo_config:int"),
            incremental="fec_snapshot",
        ),
        TableSpec(
            "POST_DEVOLUCIONES", "fact_devoluciones", "id_devolucion",
            ("id_devolucion", "id_trans_origen"),
            _schema("id_devolucion:long id_trans_origen:long art_id:long id_tienda:long"
                    " fec_devolucion:date qty_devuelta:int motivo_cod:string"
                    " canal_devolucion:string estado_devolucion:string vr_reembolso:refund"),
            incremental="fec_devolucion",
        ),
    )
}

AUDIT_SCHEMA = _schema("source_system:string batch_id:string year:string month:string day:string")
AUDIT_SCHEMA = T.StructType([T.StructField("ingestion_timestamp", T.TimestampType()), *AUDIT_SCHEMA])
PARTITION_COLUMNS = ("year", "month", "day")
# Bronze keeps each batch in a folder of its own, so that a batch is read, or passed over, without its neighbours.
STORED_PARTITIONS = (*PARTITION_COLUMNS, "batch_id")

WATERMARK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("last_watermark", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("version", T.TimestampType()),
])

LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])


def bronze_schema(name: str) -> T.StructType:
    """Source columns plus the audit columns."""
    return T.StructType([*TABLES[name].schema, *AUDIT_SCHEMA])
