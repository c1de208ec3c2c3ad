"""What the text operators share: table access, Arrow batches, word hashes of whole batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.session import materialize

# Rows sent to Python at a time: bounds the memory of a worker where texts are very long.
BATCH_ROWS = 200
# Text bytes that one numpy pass covers.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows from here on, in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], fields: str) -> DataFrame:
    """``fn`` turns a batch into columns of equal length, named and typed by ``fields`` (DDL)."""
    small_batches(df.sparkSession)
    schema = T._parse_datatype_string(fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(fn(batch), names=names)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_columns(df: DataFrame, text: str, fn: Callable[[str | None], tuple], fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """All columns of ``df`` and, behind them, what ``fn`` returns for each row's text.

    ``fields``: name, Spark type and Arrow type of each new column.
    """
    small_batches(df.sparkSession)
    schema = T.StructType(df.schema.fields + [
        T.StructField(n, T._parse_datatype_string(t), True) for n, t, _ in fields])
    at = df.columns.index(text)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fn(x) for x in batch.column(at).to_pylist()]
            new = [pa.array([m[i] for m in made], type=kind) for i, (_, _, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, schema)


_OWN_NUMBERS = 1 << 62  # from here on, numbers that stand for a text of an id that other texts share


def numbered(docs: DataFrame, key: str, text: str, name: str) -> tuple[DataFrame, bool, bool]:
    """``docs`` with a number in ``name`` that tells texts apart; whether any id repeats, and with another text.

    The number is the id. Where rows of one id hold several texts, one text keeps the id and each other gets a
    large number of its own, the same for equal rows of it. Rows without an id have no number. Only ids and
    digests are grouped; texts move only where ids do hold several.
    """
    number = column_of(docs, key).cast("long")
    mark = F.struct(F.xxhash64(column_of(docs, text)), F.xxhash64(F.lit(1), column_of(docs, text)))
    first, differs = free_name(docs, f"{name}_first"), free_name(docs, f"{name}_differs")
    again = materialize(docs.select(number.alias(name), mark.alias("m")).where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("n"), F.min("m").alias(first), (F.min("m") != F.max("m")).alias(differs)).where("n > 1").drop("n"), "repeated")
    found = again.agg(F.count(F.lit(1)), F.count_if(F.col(differs))).first()
    if not found[1]:
        return docs.withColumn(name, number), found[0] > 0, False
    joined = docs.withColumn(name, number).join(again.where(F.col(differs)), name, "left")
    salt = 0
    while True:
        own = F.lit(_OWN_NUMBERS) + F.xxhash64(F.lit(salt), F.col(name), column_of(docs, text)).bitwiseAND(F.lit(_OWN_NUMBERS - 1))
        given = joined.where(F.col(first).isNotNull() & (F.col(first) != mark)).select(own.alias("o"), F.struct(F.col(name), mark).alias("m"))
        if given.groupBy("o").agg((F.min("m") != F.max("m")).alias("clash")).where("clash").isEmpty():
            break
        salt += 2
    chosen = F.when(F.col(first).isNotNull() & (F.col(first) != mark), own).otherwise(F.col(name))
    return joined.select(*[column_of(docs, c) for c in docs.columns], chosen.alias(name)), True, True


def bucket_of(key: str, parts: int):
    """The contract's folds: crc32 of the id written as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


# ---------------------------------------------------------------- word hashes of whole batches

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept for the next batch."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b)]))
                      for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_table(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than ASCII white space) of texts lying one after another.

    ``data``: UTF-8 bytes; text i is ``data[bounds[i]:bounds[i + 1]]``. Returns the first word of
    each text (with the total as last entry), each word's first byte and end, and its 64-bit hash.
    """
    n = len(data)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = bounds[(bounds > 0) & (bounds < n)]
    begins[cut] = inside[cut]  # a word ends where its text ends
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cut - 1] = inside[cut - 1]
    end = np.flatnonzero(ends) + 1
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * inverse[start])
    return np.searchsorted(start, bounds), start, end, hashed


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, at its first word; shorter by ``k - 1`` than ``words``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * _BASE + words[i:i + n]
    return mix(out)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of texts of about ``CHUNK_BYTES``; null is empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], (offsets[first:end + 1] - offsets[first]).astype(np.int64)
        first = end


def column_of(df: DataFrame, name: str):
    return F.col(f"`{name}`")
