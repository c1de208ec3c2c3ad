"""Silver operators: deduplicate, quarantine, pseudonymise, standardise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.functions.measures import flag
from bodega.operators.joins import skew_join
from bodega.schemas import NULL_REASON, TableSpec

REASON = "error_reason"
ACCEPTED = "NONE"


def dedup(df: DataFrame, keys: Sequence[str] | None = None,
          newest: Sequence[str] = ("ingestion_timestamp", "batch_id")) -> DataFrame:
    """Drop whole-row duplicates, or with ``keys`` keep the newest row of each key.

    Both forms combine on the map side, so a key with very many copies is reduced before the
    shuffle. Rows equal in ``newest`` are decided by the remaining columns, hence repeatable.
    Rows with a null in ``keys`` are not one another's copies: of them only whole-row duplicates go.
    """
    if not keys:
        return df.dropDuplicates()
    order = [c for c in newest if c in df.columns]
    rest = [c for c in df.columns if c not in order and c not in keys]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    known = all_present(keys)
    reduced = df.where(known).groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
    return reduced.unionByName(df.where(~known).dropDuplicates())


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def split_mandatory(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every mandatory column, and the others with their reason."""
    present = all_present(columns)
    return df.where(present), df.where(~present).withColumn(REASON, F.lit(NULL_REASON))


def hash_columns(df: DataFrame, columns: Sequence[str], bits: int = 256) -> DataFrame:
    """Replace each column by its SHA-2 hex digest ``<name>_hash``; null stays null."""
    return df.withColumns(
        {f"{c}_hash": F.sha2(F.col(c).cast("string"), bits) for c in columns}).drop(*columns)


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns that exist; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def flag_and_fill(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """``<name>_null_flag`` 1/0, then the default instead of null."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    if not present:
        return df
    return df.withColumns(
        {f"{c}_null_flag": flag(F.col(c).isNull()) for c in present}).fillna(present)


def parent_keys(parent: DataFrame, key: str) -> DataFrame:
    return parent.select(key).distinct()


def fk_rejects(df: DataFrame, parent: DataFrame, key: str, reason: str) -> DataFrame:
    """Rows without a parent."""
    return df.join(parent.select(key), key, "left_anti").withColumn(REASON, F.lit(reason))


def fk_valid(df: DataFrame, parent: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows with a parent. ``how="inner"`` repeats a row once per parent copy."""
    if how not in ("left_semi", "inner"):
        raise ValueError(f"how must be left_semi or inner, not {how!r}")
    return df.join(parent.select(key), key, how).select(*df.columns)


def tag_rows(df: DataFrame, spec: TableSpec, parent: DataFrame | None = None,
             hot_keys: Mapping | None = None, absent: DataFrame | None = None) -> DataFrame:
    """Add ``error_reason``: NONE for a valid row, else the first rule it breaks.

    One pass instead of one anti and one semi join: the row is joined to the distinct parent
    keys, which cannot multiply it, and both outcomes leave the same plan. With ``absent`` (see
    ``absent_keys``) it is joined to the few keys that the parent lacks instead.
    """
    reason = F.when(~all_present(spec.mandatory), NULL_REASON)
    if spec.foreign_key and absent is not None:
        key = F.col(spec.foreign_key.key)
        tagged = df.join(absent, key == F.col("_absent"), "left")
        reason = reason.when(key.isNull() | F.col("_absent").isNotNull(), spec.foreign_key.reason)
        return tagged.withColumn(REASON, reason.otherwise(ACCEPTED)).select(*df.columns, REASON)
    if spec.foreign_key and parent is not None:
        key = spec.foreign_key.key
        known = parent_keys(parent, key).withColumnRenamed(key, "_parent")
        columns = df.columns
        if hot_keys is not None:
            df = skew_join(df, known, key, "_parent", hot_left=hot_keys)
        else:
            df = df.join(known, F.col(key) == F.col("_parent"), "left")
        reason = reason.when(F.col("_parent").isNull(), spec.foreign_key.reason)
        return df.withColumn(REASON, reason.otherwise(ACCEPTED)).select(*columns, REASON)
    return df.withColumn(REASON, reason.otherwise(ACCEPTED))


def standardise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rules that change columns: hashed personal data, types, null flags and defaults."""
    if spec.hashed:
        df = hash_columns(df, spec.hashed)
    df = cast_columns(df, {"activo": T.BooleanType()})
    return flag_and_fill(df, spec.defaults)


def conform(df: DataFrame, spec: TableSpec, parent: DataFrame | None = None,
            keys: Sequence[str] | None = None, hot_keys: Mapping | None = None,
            absent: DataFrame | None = None) -> DataFrame:
    """All silver rules of one table; every input row leaves once, tagged valid or rejected.

    Personal data is hashed before rejects are told apart, so no reject keeps it in clear.
    """
    return tag_rows(standardise(dedup(df, keys), spec), spec, parent, hot_keys, absent)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON) == ACCEPTED).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON) != ACCEPTED)
