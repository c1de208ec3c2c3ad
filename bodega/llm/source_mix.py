"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Each source's documents are laid end to end in an order shuffled by a digest, again and again as often as its
target asks, and cut into blocks of equally many words. The schedule has one slot a block. Slot t stands at the van der
Corput point of t (its bits turned round); cumulative weights, counted in blocks, map the point to a source, and the slot's
rank among the slots of its source is the block it takes. So every prefix of the schedule holds the sources in
about their shares, and the whole of it holds each source's target to the word: its last block is as short as
need be. A slot's rank is arithmetic (the points of earlier slots that lie in an interval), so no window runs
over a source's slots.

Of a source that holds a third of all words no task holds more than a cell: documents are dealt to cells by their digest,
words are summed by cell, and offsets are the sums of earlier cells plus the sum within. Sources are numbered
over ranges of their names. The driver sees counts alone: partitions of the table of sources, and one row a round of resharing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bodega.llm.common import column_of
from bodega.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5          # words of the mix for each word there is
MOST_TIMES = 2       # no source is taken more often
BLOCK_WORDS = 2048
CELL_WORDS = 1 << 20  # words of one source that one task orders
CHUNK_BLOCKS = 1 << 16  # slots that one row makes
TASK_BLOCKS = 1 << 20   # slots that one task makes
WORD = r"[^\x20\x09-\x0D]+"
_CELL_DIGITS = 8     # hexadecimal digits of the digest that choose the cell


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Rows (doc, source, size, digest), written once: words of the text, and a digest of id and text for the shuffle."""
    whole = F.coalesce(column_of(docs, text), F.lit(""))
    tag = F.md5(F.concat(F.coalesce(column_of(docs, key).cast("string"), F.lit("")), F.lit(":"), whole).cast("binary"))
    return materialize(docs.select(
        column_of(docs, key).alias("doc"), column_of(docs, source).alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"), tag.alias("digest")), "mix-sizes")


def _prefixed(table: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """``table`` (stored, with ``part`` and ``row``) with the sum of each measure over all earlier rows.

    Two levels: within a part by a window, over parts by their totals, of which there are as many as
    partitions were written.
    """
    totals = table.groupBy("part").agg(*[F.sum(m).alias(n) for n, m in measures.items()]).orderBy("part").collect()
    running = dict.fromkeys(measures, 0)
    offsets = []
    for total in totals:
        offsets.append((total["part"], *running.values()))
        running = {n: running[n] + total[n] for n in measures}
    if not offsets:
        return table.withColumns({n: F.lit(0).cast("long") for n in measures})
    base = table.sparkSession.createDataFrame(offsets, "part bigint, " + ", ".join(f"`{n}_base` bigint" for n in measures))
    earlier = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inner = table.withColumns({n: F.coalesce(F.sum(m).over(earlier), F.lit(0)) for n, m in measures.items()})
    return inner.join(base, "part").withColumns({n: F.col(n) + F.col(f"{n}_base") for n in measures}).drop(
        *[f"{n}_base" for n in measures])


def _stored_in_order(table: DataFrame, *order: Column) -> DataFrame:
    """``table`` range-sorted and written, its rows numbered by part and row within it."""
    at = F.monotonically_increasing_id()
    ranged = table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    return materialize(ranged, "mix-sources").withColumns({
        "part": F.shiftright("_at", 33), "row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, weight, target) of rows (source, size).

    Sources in order of code points, null last, get the weights in turn. Together they get ``share`` of all
    words by weight; a target stops at ``most`` times its source's words, and what is over is shared anew by
    weight until no target is above its limit. Each round is one aggregate over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    stored = _stored_in_order(totals, F.col("source").isNull(), F.col("source"))
    ranked = _prefixed(stored, {"rank": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    table = materialize(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    limit, wanted = F.lit(float(most)) * F.col("source_size"), share * whole
    rate, before = 0.0, -1.0
    while rate > before:  # it rises from round to round, so a source that is full stays full
        before = rate
        full = limit < F.lit(rate) * F.col("weight")
        row = table.agg(F.sum(F.when(full, limit).otherwise(0.0)).alias("held"),
                        F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("rest")).first()
        rate = (wanted - row["held"]) / row["rest"] if row["rest"] else rate
    return table.withColumn("target", F.least(limit, F.lit(rate) * F.col("weight")))


# ---------------------------------------------------------------- schedule

def turned(t: Column, bits: int) -> Column:
    """The van der Corput point of t among 2^bits, as a whole number: its bits in reverse."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(t, bit).bitwiseAND(F.lit(1).cast("long")), bits - 1 - bit))
    return out


def _below(bound: Column, first: Column, step_bits: int) -> Column:
    """How many of first, first + 2^step_bits, ... are below ``bound`` (first < 2^step_bits)."""
    return F.shiftright(bound - first + F.lit((1 << step_bits) - 1), step_bits)


def rank_before(slot: Column, point: Column, low: Column, high: Column, bits: int) -> Column:
    """Number of earlier slots whose point lies in [low, high).

    The slots that agree with this one above one of its set bits and have that bit unset are earlier. Their
    points are this slot's lower bits plus the multiples of a power of two, so they can be counted at once.
    """
    rank = F.lit(0).cast("long")
    for bit in range(bits):
        first = point.bitwiseAND(F.lit((1 << (bits - 1 - bit)) - 1).cast("long"))
        own = _below(high, first, bits - bit) - _below(low, first, bits - bit)
        rank = rank + own * F.shiftright(slot, bit).bitwiseAND(F.lit(1).cast("long"))
    return rank


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, block, words): which block of which source each slot takes, and how many words of it.

    ``goals``: (source, target), one row a source. Slots are numbered in the order in which they are to be read; numbers
    whose point lies beyond the last block are left out.
    """
    quota = F.round("target").cast("long")
    blocks = F.ceil(quota / F.lit(block)).cast("long")
    stored = _stored_in_order(goals.select("source", quota.alias("quota"), blocks.alias("blocks")),
                              F.col("source").isNull(), F.col("source"))
    placed = _prefixed(stored, {"low": F.col("blocks")}).withColumn("high", F.col("low") + F.col("blocks"))
    whole = stored.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (whole - 1).bit_length()) if whole else 1
    chunks = placed.where("blocks > 0").withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / F.lit(CHUNK_BLOCKS)))))
    point = F.explode(F.sequence(
        F.col("low") + F.col("chunk") * CHUNK_BLOCKS,
        F.least(F.col("high"), F.col("low") + (F.col("chunk") + 1) * CHUNK_BLOCKS) - 1))
    tasks = max(1, -(-whole // TASK_BLOCKS))  # a fixed number: the rows are few and small before they are exploded
    slots = chunks.repartition(tasks, "low", "chunk").select("source", "quota", "low", "high", point.alias("point"))
    slots = slots.withColumn("slot", turned(F.col("point"), bits))
    rank = rank_before(F.col("slot"), F.col("point"), F.col("low"), F.col("high"), bits)
    return slots.select("slot", "source", rank.alias("block"), "quota").withColumn(
        "words", F.least(F.lit(block).cast("long"), F.col("quota") - F.col("block") * block)).drop("quota")


# ---------------------------------------------------------------- documents in blocks

def laid_out(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``sizes`` joined with their source's row of ``goals``, and each document's first word within its source.

    ``cell`` and ``row`` (from 1) tell documents apart, also where whole rows repeat.
    """
    same = sizes["source"].eqNullSafe(goals["source"])
    joined = sizes.join(goals, same).drop(goals["source"])
    cells = F.ceil(F.col("source_size") / F.lit(CELL_WORDS))
    high = F.conv(F.substring("digest", 1, _CELL_DIGITS), 16, 10).cast("long")
    cell = F.shiftright(high * F.greatest(cells, F.lit(1)), 4 * _CELL_DIGITS)  # rises with the digest
    dealt = joined.withColumn("cell", cell).withColumn("_none", F.col("source").isNull()).withColumn(
        "_name", F.coalesce("source", F.lit("")))
    held = dealt.groupBy("_none", "_name", "cell").agg(F.sum("size").alias("_held"))
    earlier = Window.partitionBy("_none", "_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("_none", "_name", "cell", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_none", "_name", "cell").orderBy("digest", "doc")
    return dealt.withColumns({
        "row": F.row_number().over(inside),
        "_end": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    }).join(bases, ["_none", "_name", "cell"]).withColumn(
        "first", F.col("_base") + F.col("_end") - F.col("size")).drop("_none", "_name", "_base", "_end")


def pieces(laid: DataFrame, block: int = BLOCK_WORDS, most: int = MOST_TIMES) -> DataFrame:
    """One row for each block that a document reaches into, within its source's target: ``block``, ``pass``,
    ``from`` (word of the document) and ``length``. Documents without a word of the mix have one row of nulls."""
    quota = F.round("target").cast("long")
    start = F.col("first") + F.col("pass") * F.col("source_size")
    end = F.least(start + F.col("size"), quota)
    passes = laid.withColumns({"pass": F.explode(F.sequence(F.lit(0), F.lit(int(most) - 1)))}).withColumns(
        {"_start": start, "_end": end})
    reached = F.when(F.col("_end") > F.col("_start"), F.sequence(
        F.floor(F.col("_start") / F.lit(block)), F.floor((F.col("_end") - 1) / F.lit(block))))
    cut = passes.withColumn("block", F.explode_outer(reached))
    since = F.greatest(F.col("_start"), F.col("block") * block)
    until = F.least(F.col("_end"), (F.col("block") + 1) * block)
    return cut.withColumns({"from": since - F.col("_start"), "length": until - since}).drop("_start", "_end")


def mix(sizes: DataFrame, goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """What every slot reads: the pieces of documents joined with the slot that takes their block.

    Rows of ``pieces`` with ``slot`` (null where a document gives nothing). Sorted by slot and place in the block
    they are the mix. The join is told to sort and merge: the plan takes the slots for as few as the sources.
    """
    cut = pieces(laid_out(sizes, goals), block)
    slots = schedule(goals, block)
    same = cut["source"].eqNullSafe(slots["source"]) & (cut["block"] == slots["block"])
    return cut.join(slots.select("slot", "source", "block").hint("merge"), same, "left").drop(slots["source"]).drop(slots["block"])


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per document: key, size, source_size, target of its source, and the words that the mix takes of it.

    A null text has no words. Documents without a source are a source of their own, the last. Repeated rows are documents of
    their own; where they are alike in id and text, either may be the one taken more often. Documents without words
    give none, and a source without words has the target 0. Other columns are not looked at. Runs
    agree: nothing depends on the order or the partitions of the rows.
    """
    sizes = sized(docs, key, source, text)
    goals = materialize(targets(sizes.select("source", "size")), "mix-targets")
    taken = F.sum(F.when(F.col("slot").isNotNull(), F.col("length")).otherwise(0)).cast("long")
    return mix(sizes, goals).groupBy("source", "cell", "row", "doc", "size", "source_size", "target").agg(
        taken.alias("taken")).select(F.col("doc").alias(key), "size", "source_size", "target", "taken")
