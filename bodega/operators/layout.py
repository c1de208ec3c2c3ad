"""Multi-column clustering, so that per-file statistics skip files for each column."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 4              # at least so many bits a column
SAMPLE_ROWS = 20_000  # about so many values of a text column give its bounds


def bits_for(files: int, columns: int) -> int:
    """Bits a column so that each column alone could tell as many ranges as files hold of it."""
    return max(BITS, math.ceil(math.log2(max(files, 1)) / columns) + 1)


def _as_value(df: DataFrame, column: str) -> Column:
    """What is compared with the bounds: text as it is, dates as days."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    return F.col(column)


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """The 2^bits - 1 inner quantiles per column, ascending.

    Numbers and dates by one pass of sketches; texts, of which there are no sketches, by a sample of which
    only the text columns are read. Bounds steer the layout only. A frequent value is several quantiles at once.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    sketches = [F.percentile_approx(_as_value(df, c), shares).alias(c) for c in numbers]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    bounds = {c: list(row[c] or []) for c in numbers}
    if texts:
        sample = df.select(*texts).sample(min(1.0, SAMPLE_ROWS / max(row["_rows"], 1)), seed=0).collect()
        for c in texts:
            values = sorted(r[c] for r in sample if r[c] is not None)
            bounds[c] = [values[int(s * len(values))] for s in shares] if values else []
    return bounds


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def range_bucket(value: Column, bounds: Sequence) -> Column:
    """Number of bounds below the value; nulls in bucket 0.

    Repeated bounds count repeatedly, so few distinct values still spread over all bits.
    """
    bucket = F.lit(0)
    for bound, times in Counter(bounds).items():
        bucket = bucket + F.when(value > F.lit(bound), times).otherwise(0)
    return bucket


def interleave(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """Bit-interleaved z-value of small non-negative integers."""
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for i, bucket in enumerate(buckets):
            digit = F.shiftright(bucket.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(digit, bit * len(buckets) + i))
    return z


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BITS,
            bounds_from: DataFrame | None = None) -> Column:
    """z-value of several columns, with bounds taken from ``bounds_from`` or ``df`` itself."""
    bounds = range_bounds(df if bounds_from is None else bounds_from, columns, bits)
    return interleave([range_bucket(_as_value(df, c), bounds[c]) for c in columns], bits)


def cluster(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), files: int | None = None,
            bits: int | None = None, bounds_from: DataFrame | None = None) -> DataFrame:
    """Range-partition and sort ``df`` along its z-value (one column: along the column).

    ``within`` are partition columns of the target, kept as leading range keys, so a task holds
    few of their values. A hash of the row is the last range key: one cell, date or group with
    very many rows is cut into several tasks and files. Bounds only steer the layout; a stored
    table with the same columns can give them (``bounds_from``) where ``df`` is costly to compute.
    """
    keep = df.columns
    tie = _row_hash(df)
    if bits is None:
        bits = bits_for(files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(columns))
    along = F.col(columns[0]) if len(columns) == 1 else z_value(df, columns, bits, bounds_from)
    keyed = df.withColumns({"_z": along, "_tie": tie})
    keys = [*within, "_z", "_tie"]
    ranged = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*within, "_z").select(*keep)
