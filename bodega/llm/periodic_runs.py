"""Stretches of words that repeat with a period, by internal pattern matching.

A run is a maximal stretch of words with smallest period q and a length of at least max(6, 4 q). Every text gets a
suffix array. A run of period q holds a block of b = 2^k words that starts at a multiple of b, where q lies
between 2b/3 and 4b/3, together with the block's next occurrence, q words on. So each block that occurs twice asks,
by range successors of a wavelet matrix over its interval of the suffix array, for its occurrences in the
neighbouring window of starts. That window is shorter than the block: one or two occurrences are candidates as they
are, three or more form one arithmetic progression whose difference d is the block's own period, and then q
brings either the left or the right end of the stretch of period d around the block to that of its copy.
Candidates are extended to both sides by the names that the suffix array's doubling gave to all words' 2^k successors.

The work is one pass over the rows, a chunk of texts at a time in numpy; no shuffle, nothing leaves a task but
its rows. Words are compared by a 64-bit hash within their own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import column_of, free_name, map_rows, small_batches, text_chunks, word_table

LEAST_LENGTH = 6  # words
LEAST_POWER = 4   # periods


# ---------------------------------------------------------------- suffix array and wavelet matrix

class Names:
    """Suffix array of several texts' words by doubling, with the names of all levels.

    ``level[k][i]`` names the 2^k words from word i on: the place where suffixes that begin with them start in
    ``order``. Equal words of two texts, told by where their texts end, have two names: else two texts that end
    alike would never be told apart. A name met once is never looked at again.
    """

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        first = np.ones(n, dtype=bool)
        first[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (ends[order[1:]] != ends[order[:-1]])
        name = np.empty(n, dtype=np.int64)
        name[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        self.order, self.ends, self.level, self.count = order, ends, [name], []
        self._count(name)
        step = 1
        while True:
            busy = order[self.count[-1][name[order]] > 1]  # in the order of their names
            if not len(busy):
                break
            after = busy + step
            inside = after < ends[busy]
            after = np.where(inside, name[np.where(inside, after, 0)] + 1, 0)
            group = name[busy]
            by = np.argsort(group * (n + 1) + after, kind="stable")
            busy, group, after = busy[by], group[by], after[by]
            new_group = np.ones(len(busy), dtype=bool)
            new_group[1:] = group[1:] != group[:-1]
            index = np.arange(len(busy))
            place = group + index - np.maximum.accumulate(np.where(new_group, index, 0))
            new_group[1:] |= after[1:] != after[:-1]
            name = name.copy()
            name[busy] = np.maximum.accumulate(np.where(new_group, place, 0))
            order[place] = busy
            self.level.append(name)
            self._count(name)
            step *= 2

    def _count(self, name: np.ndarray) -> None:
        self.count.append(np.bincount(name, minlength=len(name)))

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j on (i < j, of one text)."""
        i, j, ends, got = i.copy(), j.copy(), self.ends[i], np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            near = j + (1 << k) <= ends
            name = self.level[k]
            same = near & (name[i] == name[np.where(near, j, 0)])
            move = np.where(same, 1 << k, 0)
            i, j, got = i + move, j + move, got + move
        return got

    def behind(self, i: np.ndarray, j: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of equal words before i and before j (i < j, of one text that begins at ``starts``)."""
        i, j, got = i.copy(), j.copy(), np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            near = i - (1 << k) >= starts
            name = self.level[k]
            same = near & (name[np.where(near, i - (1 << k), 0)] == name[np.where(near, j - (1 << k), 0)])
            move = np.where(same, 1 << k, 0)
            i, j, got = i - move, j - move, got + move
        return got


class WaveletMatrix:
    """Orders within ranges of a sequence of numbers below 2^bits, for many queries at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.before = bits, [], []
        for bit in range(bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            count = np.zeros(len(values) + 1, dtype=np.int64)
            np.cumsum(zero, out=count[1:])
            self.before.append(count)
            self.zeros.append(int(count[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the numbers at low..high-1 are smaller than ``bound``."""
        found = np.zeros(len(low), dtype=np.int64)
        for level, (zeros, before) in enumerate(zip(self.zeros, self.before)):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = before[low], before[high]
            found += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of the given rank (from 0) among those at low..high-1; with ``below`` the range successor."""
        value = np.zeros(len(low), dtype=np.int64)
        for level, (zeros, before) in enumerate(zip(self.zeros, self.before)):
            a, b = before[low], before[high]
            one = rank >= b - a
            value += np.where(one, 1 << (self.bits - 1 - level), 0)
            rank = np.where(one, rank - (b - a), rank)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return value


# ---------------------------------------------------------------- candidates and runs

def periods_of(block: int) -> tuple[int, int]:
    """Least and greatest period whose runs hold an aligned block of this length and its copy one period on."""
    return -(-(2 * block - 1) // 3), -(-(4 * block - 1) // 3) - 1


def _blocks(names: Names, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Aligned blocks that occur twice: first word, interval in ``order``, least and greatest period."""
    parts = []
    busy = np.flatnonzero(names.count[0][names.level[0]] > 1)
    for k in range(1, len(names.level)):
        name, count = names.level[k], names.count[k]
        busy = busy[count[name[busy]] > 1]
        low, high = periods_of(1 << k)
        at = busy[((busy - starts[busy]) & ((1 << k) - 1) == 0) & (ends[busy] - starts[busy] >= LEAST_POWER * low)]
        parts.append((at, name[at], name[at] + count[name[at]], np.full(len(at), low), np.full(len(at), high)))
    if not parts:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(column) for column in zip(*parts))


def find_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word within its text, length and period of every run, by text, first word and period.

    ``words`` are the hashes of all words; text i holds words ``bounds[i]`` to ``bounds[i + 1] - 1``.
    """
    none = tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    n = len(words)
    if n < LEAST_LENGTH:
        return none
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts, ends = bounds[text], bounds[text + 1]
    names = Names(words, ends)
    if len(names.level) < 2:
        return none
    at, low, high, least, most = _blocks(names, starts, ends)
    if not len(at):
        return none
    # only suffixes whose first two words occur twice can be asked for
    kept = names.count[1][names.level[1][names.order]] > 1
    place = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(kept, out=place[1:])
    matrix = WaveletMatrix(names.order[kept], n.bit_length())
    low, high = place[low], place[high]
    before = matrix.below(low, high, np.minimum(at + least, n))
    many = matrix.below(low, high, np.minimum(at + most + 1, n)) - before
    near = many > 0
    at, low, high, least, most, before, many = (x[near] for x in (at, low, high, least, most, before, many))
    one = matrix.nth(low, high, before)
    more = many > 1
    two = one.copy()
    two[more] = matrix.nth(low[more], high[more], before[more] + 1)
    few = many < 3
    seeds = [(at[few], one[few] - at[few]), (at[few & more], two[few & more] - at[few & more])]
    if not few.all():
        s, e, d = at[~few], one[~few], (two - one)[~few]
        right = e + d + names.ahead(e, e + d) - (s + d + names.ahead(s, s + d))
        left = e - names.behind(e, e + d, starts[e]) - (s - names.behind(s, s + d, starts[s]))
        for q in (right, left):  # nought: the block and its copy lie in one stretch of period d
            fits = (q >= least[~few]) & (q <= most[~few]) & (s + q < ends[s])
            seeds.append((s[fits], q[fits]))
    s = np.concatenate([x for x, _ in seeds])
    q = np.concatenate([x for _, x in seeds])
    begin = s - names.behind(s, s + q, starts[s])
    length = s + q + names.ahead(s, s + q) - begin
    fits = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * q)
    begin, length, q = begin[fits], length[fits], q[fits]
    # a stretch is found under multiples of its period too: the least one counts
    by = np.lexsort((q, length, begin))
    begin, length, q = begin[by], length[by], q[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, q = begin[new], length[new], q[new]
    by = np.lexsort((q, begin))
    begin, length, q = begin[by], length[by], q[by]
    return text[begin], begin - starts[begin], length, q


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for the words that no run holds behind its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length by period, compared exactly; ties to the least start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


# ---------------------------------------------------------------- whole batches

Repeat = tuple[int, int]  # word a and period p: from a on, the p words from a are repeated to the text's end


def runs_of_texts(column: pa.Array, repeat: Callable[[int, int], Repeat | None] | None = None
                  ) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text (null: no words), ``repeat(row, n_words)`` applied first where it is given."""
    for first, end, data, offsets in text_chunks(column):
        bounds, _, _, hashes = word_table(data, offsets)
        raw = data.tobytes()
        changed: dict[int, Repeat] = {}
        for row in range(end - first):
            n = int(bounds[row + 1] - bounds[row])
            rule = repeat(first + row, n) if repeat and n else None
            if rule:
                a, p = rule
                own = hashes[bounds[row]:bounds[row + 1]]
                own[a:] = np.resize(own[a:a + p].copy(), n - a)
                changed[row] = rule
        found = find_runs(hashes, bounds)
        of = np.searchsorted(found[0], np.arange(end - first + 1))
        triples = list(zip(*(x.tolist() for x in found[1:])))
        for row in range(end - first):
            words = raw[offsets[row]:offsets[row + 1]].split()
            if row in changed:
                a, p = changed[row]
                tail = words[a:a + p]
                words[a:] = (tail * (-(-(len(words) - a) // p)))[:len(words) - a]
            yield words, triples[of[row]:of[row + 1]]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text's words less those that only repeat, one space between."""
    return b" ".join(compress(words, kept_words(len(words), runs)) if runs else words)


def periodic_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df`` and, behind them, ``runs`` and ``collapsed``.

    ``runs``: array of (start, length, period) in words, by start, then period. ``collapsed``: the words
    that no run holds behind its first period, one space between. A null or blank text has no words, so no
    run and an empty ``collapsed``. Each row is judged on its own: repeated rows come out as often as they
    came. Where ``df`` has such columns already, the new ones get underscores in front. Texts are read whole.
    """
    small_batches(df.sparkSession)
    run_type = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = T.StructType(df.schema.fields + [
        T.StructField(free_name(df, "runs"), T._parse_datatype_string(run_type)),
        T.StructField(free_name(df, "collapsed"), T.StringType())])
    at, names = df.columns.index(text), schema.names
    arrow = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(runs_of_texts(batch.column(at)))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in own] for _, own in found]
            texts = [collapsed(words, own).decode("utf-8") for words, own in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, arrow), pa.array(texts, pa.string())], names=names)

    return df.mapInArrow(add, schema)


def planted_repeat(crc: int, n: int) -> Repeat | None:
    """The contract's planted repeat of a text of n words, from the checksum of its id."""
    if crc % 10 or not n:
        return None
    g = crc // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def run_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_runs, the strongest run's start, length, period and exponent_milli (null without a run),
    runs_sha256 and collapsed_sha256, with the contract's repeats planted first.

    A null text has no words. A row without a key gets no planted repeat. Repeated rows come out as often as
    they came; other columns are not looked at, whatever their names.
    """
    crc = F.crc32(column_of(docs, key).cast("string").cast("binary"))
    rows = docs.select(column_of(docs, key).alias("key"), crc.alias("crc"), column_of(docs, text).alias("text"))

    def digest(batch: pa.RecordBatch) -> list[pa.Array]:
        crcs = batch.column(1).to_pylist()
        rows = []
        for words, runs in runs_of_texts(batch.column(2), lambda row, n: None if crcs[row] is None else planted_repeat(crcs[row], n)):
            best = strongest(runs)
            listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
            rows.append((len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()))
        columns = list(zip(*rows))
        return [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])]

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(rows, digest, f"key {kind}, n_runs bigint, start bigint, length bigint, period bigint, "
                    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string").withColumnRenamed("key", key)
