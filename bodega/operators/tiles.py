"""Exact ntile over a whole table without sorting it in one task.

A tile number depends only on the k-1 rows that end the tiles. Those rows are found by exact
selection: approximate quantiles give an interval around each wanted rank, one histogram tells how
many rows lie between the intervals and how often each value inside them occurs. All orders
share one sketch and one histogram, and so do all ties, which are resolved on the key the same way. Each row then
gets its tile by comparing itself with the k-1 rows: no shuffle and no sort of the table, and a
value held by a third of all rows is just one group of the count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bodega.functions.measures import first_match
from bodega.session import materialize

ACCURACY = 10_000
WHOLE_ROWS = 100_000  # a group of fewer rows is counted value by value, without a sketch
RANGE_ROWS = 1_000_000  # histogram rows that one task orders


@dataclass(frozen=True)
class TileOrder:
    """Sort column; nulls come first ascending and last descending, as in Spark."""

    column: str
    descending: bool = False


Ranks = dict[int, list[int]]  # group -> wanted ranks, counted from 1
Found = dict[tuple[int, int], tuple]  # (group, rank) -> (value, rows before it, rows equal to it)


def _member(group: int) -> str:
    return f"m{group}"


def _intervals(df: DataFrame, ranks: Ranks, sizes: dict[int, int], slack: float) -> dict[int, list[tuple] | None]:
    """Per group, disjoint ascending value intervals that should hold the wanted ranks; None for all values."""
    sketches = {}
    for group, wanted in ranks.items():
        n = sizes[group]
        if n > WHOLE_ROWS:
            shares = [s for r in wanted for s in (max(0.0, (r - 1) / n - slack), min(1.0, r / n + slack))]
            sketches[group] = F.percentile_approx(_member(group), shares, ACCURACY).alias(str(group))
    result: dict[int, list[tuple] | None] = dict.fromkeys(ranks)
    if sketches:
        row = df.agg(*sketches.values()).first()
        for group in sketches:
            merged: list[tuple] = []
            for low, high in sorted(zip(row[str(group)][::2], row[str(group)][1::2])):
                if merged and low <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
                else:
                    merged.append((low, high))
            result[group] = merged
    return result


def _segment(value: Column, intervals: list[tuple] | None) -> Column:
    """Odd numbers lie inside an interval, even ones between intervals."""
    if intervals is None:
        return F.lit(1)
    rules = [rule for i, (low, high) in enumerate(intervals)
             for rule in ((value < low, 2 * i), (value <= high, 2 * i + 1))]
    return first_match(rules, 2 * len(intervals))


def _histogram(df: DataFrame, parts: dict[int, list[tuple] | None]) -> tuple[DataFrame, list[str], dict[int, str]]:
    """Rows per group, segment and, inside an interval, value; its order within a group; the value's column by group.

    Values keep their types: there is one column for each type that occurs.
    """
    types = {g: df.schema[_member(g)].dataType for g in parts}
    slots = {t: f"v{i}" for i, t in enumerate(dict.fromkeys(types.values()))}
    entries = []
    for group, intervals in parts.items():
        value = F.col(_member(group))
        segment = _segment(value, intervals)
        held = {types[group]: F.when(segment % 2 == 1, value)}
        entries.append(F.when(value.isNotNull(), F.struct(
            F.lit(group).alias("_group"), segment.cast("int").alias("_segment"),
            *[held.get(t, F.lit(None)).cast(t).alias(name) for t, name in slots.items()])))
    order = ["_segment", *slots.values()]
    each = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counted = each.groupBy("_group", *order).agg(F.count(F.lit(1)).alias("_rows"))
    return counted, order, {g: slots[t] for g, t in types.items()}


def running_rows(histogram: DataFrame, order: list[str], most: float = math.inf) -> DataFrame:
    """``_to``: the rows up to and including each row of the histogram, by group.

    Sums run on two levels: within ranges of about ``RANGE_ROWS`` rows, and over the ranges' totals, joined back.
    Where the histogram has at ``most`` one range's rows there is nothing to divide.
    """
    def summed(*by: str) -> Column:
        return F.sum("_rows").over(Window.partitionBy(*by).orderBy(*order))

    if most > RANGE_ROWS:
        histogram = materialize(histogram, "histogram")
        most = histogram.count()
    if most <= RANGE_ROWS:
        return histogram.withColumn("_to", summed("_group"))
    ranges = histogram.repartitionByRange(math.ceil(most / RANGE_ROWS), "_group", *order)
    stored = materialize(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("_group", "_range").agg(F.sum("_rows").alias("_sum"))
    offsets = totals.select("_group", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    return (stored.join(offsets, ["_group", "_range"])
            .withColumn("_to", summed("_group", "_range") + F.col("_offset")).drop("_offset", "_range"))


def _search(df: DataFrame, ranks: Ranks, sizes: dict[int, int], whole: bool = False) -> Found:
    """Values at ranks among the non-null values of the columns ``m<group>``."""
    wanted = {g: sorted(set(w)) for g, w in ranks.items() if w}
    if not wanted:
        return {}
    parts = dict.fromkeys(wanted) if whole else _intervals(df, wanted, sizes, 2 / ACCURACY)
    histogram, order, slots = _histogram(df, parts)
    most = sum(sizes[g] if parts[g] is None else math.inf for g in wanted)
    until, since = F.col("_to"), F.col("_to") - F.col("_rows")
    hit = reduce(lambda a, b: a | b, [
        (F.col("_group") == g) & (until >= r) & (since < r) for g, w in wanted.items() for r in w])
    result: Found = {}
    missed = []  # (group, segment between intervals, rows before it, rows in it, ranks in it)
    for row in running_rows(histogram, order, most).where(hit).collect():
        group, before = row["_group"], row["_to"] - row["_rows"]
        inside = [r for r in wanted[group] if before < r <= row["_to"]]
        if row["_segment"] % 2:
            result |= {(group, r): (row[slots[group]], before, row["_rows"]) for r in inside}
        else:
            missed.append((group, row["_segment"], before, row["_rows"], inside))
    if missed:
        gaps = df.select([F.when(_segment(F.col(_member(g)), parts[g]) == segment, F.col(_member(g))).alias(_member(i))
                          for i, (g, segment, *_) in enumerate(missed)])
        found = _search(gaps, {i: [r - m[2] for r in m[4]] for i, m in enumerate(missed)},
                        {i: m[3] for i, m in enumerate(missed)}, whole=True)
        for (i, rank), (value, before, rows) in found.items():
            group, _, skipped, *_ = missed[i]
            result[group, rank + skipped] = (value, before + skipped, rows)
    return result


def values_at_ranks(df: DataFrame, ranks: Ranks, sizes: dict[int, int]) -> Found:
    """(group, rank) -> (value, rows before it, rows equal to it) for rows (_group, _value).

    Values are not null and ascending within their group. The quantiles may be off (they are
    computed in double): the histogram tells between which intervals a missed rank lies, and the values there are
    counted once more, so the result is exact after two passes.
    """
    return _search(df.select([F.when(F.col("_group") == g, F.col("_value")).alias(_member(g)) for g in ranks]), ranks, sizes)


@dataclass(frozen=True)
class _End:
    """Last row of a tile: its value, and its key where rows after it share the value."""

    value: object
    key: object | None


def _tile_ends(df: DataFrame, orders: dict[str, TileOrder], key: str, ranks: list[int], n: int,
               nulls: dict[str, int]) -> dict[str, list[_End]]:
    names = list(orders)
    wanted: Ranks = {}  # ascending ranks among the non-null values
    ascending: dict[tuple[int, int], int] = {}  # (order, rank in it) -> that ascending rank
    for i, name in enumerate(names):
        filled = n - nulls[name]
        for r in ranks:
            position = r if orders[name].descending else r - nulls[name]
            if 1 <= position <= filled:
                ascending[i, r] = filled - position + 1 if orders[name].descending else position
        wanted[i] = [rank for (j, _), rank in ascending.items() if j == i]
    present = df.select([F.col(f"`{o.column}`").alias(_member(i)) for i, o in enumerate(orders.values())])
    found = _search(present, wanted, {i: n - nulls[name] for i, name in enumerate(names)})

    ends: dict[tuple[int, int], _End] = {}
    ties: dict[tuple, tuple[int, int]] = {}  # (order, value) -> (its group below, rows holding it)
    within: Ranks = {}  # group -> positions among the rows of one value, ordered by key
    for i, name in enumerate(names):
        filled = n - nulls[name]
        for r in ranks:
            if (i, r) in ascending:
                bound, before, same = found[i, ascending[i, r]]
                earlier = filled - before - same if orders[name].descending else nulls[name] + before
            else:
                bound, same = None, nulls[name]
                earlier = filled if orders[name].descending else 0
            ends[i, r] = _End(bound, None)
            if r - earlier < same:
                group, _ = ties.setdefault((i, bound), (len(ties), same))
                within.setdefault(group, []).append(r - earlier)
                ends[i, r] = _End(bound, (group, r - earlier))
    if ties:
        keys = []
        for (i, bound), (group, _) in ties.items():
            value = F.col(f"`{orders[names[i]].column}`")
            keys.append(F.when(value.isNull() if bound is None else value == F.lit(bound), F.col(f"`{key}`")).alias(_member(group)))
        held = _search(df.select(keys), within, dict(ties.values()))
        ends = {at: end if end.key is None else _End(end.value, held[end.key][0]) for at, end in ends.items()}
    return {name: [ends[i, r] for r in ranks] for i, name in enumerate(names)}


def _after(end: _End, order: TileOrder, key: str) -> Column:
    """True for rows that come after the given row."""
    value = F.col(order.column)
    if end.value is None:
        later = F.lit(False) if order.descending else value.isNotNull()
        same = value.isNull()
    else:
        bound = F.lit(end.value)
        later = (value.isNull() | (value < bound)) if order.descending else (value > bound)
        same = value == bound
    if end.key is not None:
        later = later | (same & (F.col(key) > F.lit(end.key)))
    return F.coalesce(later, F.lit(False))


def ntile_distributed(df: DataFrame, orders: dict[str, TileOrder], key: str, k: int) -> DataFrame:
    """``ntile(k)`` per named order, ties broken by ascending ``key`` (unique, not null).

    ``df`` is read several times, so it should be a stored table.
    """
    counts = df.agg(F.count("*").alias("n"), *[F.count(o.column).alias(f"_{name}") for name, o in orders.items()]).first()
    n = counts["n"]
    if n == 0:
        return df.withColumns({name: F.lit(1) for name in orders})
    size, extra = divmod(n, k)
    ranks = sorted({r for r in (i * size + min(i, extra) for i in range(1, k)) if 0 < r < n})
    ends = _tile_ends(df, orders, key, ranks, n, {name: n - counts[f"_{name}"] for name in orders})
    tiles = {}
    for name, order in orders.items():
        tile = F.lit(1)
        for end in ends[name]:
            tile = tile + _after(end, order, key).cast("int")
        tiles[name] = tile
    return df.withColumns(tiles)
