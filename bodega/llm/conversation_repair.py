"""Cheapest repair of a conversation's structure, decided by the minimum of big integers alone.

A sound conversation is empty or has role initials ``s?(ua)+``. Rows may be kept, given another role or deleted, and
rows with empty text may be inserted. Every way to do so is a path through a graph whose nodes are (row, role
initial reached, letters written so far); a path's weight is one integer: its high digits carry the cost, its low digits, a
fixed number of them, the letters of its edits in order, three bits each, with zeros behind the last. The least integer is
then the cheapest path and among the cheapest the one whose letters come first in ASCII, so a plain minimum
over the graph decides cost, edits and roles at once.

A conversation's rows stream through one task, sorted by Spark, which may spill; four weights, one for each initial that can
be reached, are all that is kept of the rows read, with the digest of what each path would print. Digits would grow with the
conversation: after ``BLOCK`` rows the letters so far are put aside and each path goes on with one digit, its rank among
the four, which orders them just as the letters did. (Two paths at one node never have letters of which one begins
with the other: the longer one would hold more inserts and cost more.)

The digest of one conversation is a chain over its rows, so a conversation is one task's work however long it is; all
work per row before that (faults, order) is not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import column_of, small_batches

BLOCK = 64         # rows whose letters lie in one integer
BATCH_ROWS = 2000  # messages are short; an Arrow batch of them
SPACES = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
_LETTERS = "\0DIKR"  # digits in ASCII order; nought is padding
_DIGIT = {letter: i for i, letter in enumerate(_LETTERS)}
_BITS = 3
_WIDTH = 1 + 3 * BLOCK + 2  # a rank, at most two inserts and one edit a row, two inserts at the end
_HIGH = _BITS * _WIDTH

# What has been written last: nothing, s, u, a. The next role that a new or changed row can have:
_START, _S, _U, _A = range(4)
_NEXT = {_START: _U, _S: _U, _U: _A, _A: _U}
_NAME = {_U: "user", _A: "assistant"}
_FINAL = (_START, _A)


class Path:
    """The best path to a node: its weight, letters written in this block, letters put aside, digest."""

    __slots__ = ("weight", "written", "aside", "digest", "empty")

    def __init__(self, weight: int, written: int, aside: tuple, digest, empty: bool):
        self.weight, self.written, self.aside, self.digest, self.empty = weight, written, aside, digest, empty

    def step(self, letter: str, cost: int) -> int:
        """The weight one edit on: its cost above, its letter in the next free digit."""
        return self.weight + (cost << _HIGH) + (_DIGIT[letter] << _BITS * (_WIDTH - 1 - self.written))


def _written(path: Path, line: bytes | None) -> tuple:
    if line is None:
        return path.digest, path.empty
    digest = path.digest.copy()
    digest.update(line if path.empty else b"\n" + line)
    return digest, False


def _letters(weight: int, first: int) -> str:
    digits = ((weight >> _BITS * (_WIDTH - 1 - i)) & 7 for i in range(first, _WIDTH))
    return "".join(_LETTERS[d] for d in digits if d)


class Repair:
    """The minimum over the graph of one conversation, row by row."""

    def __init__(self):
        self.paths = {_START: Path(0, 0, (), hashlib.sha256(), True)}
        self.rows, self.first = 0, 0

    def _insert(self) -> None:
        """Up to two inserted rows in front of the next one; more never pay."""
        layer = self.paths
        for _ in range(2):
            reached = {}
            for state, path in layer.items():
                to = _NEXT[state]
                weight = path.step(INSERT, COSTS[INSERT])
                known = reached.get(to) or self.paths.get(to)
                if known is None or weight < known.weight:
                    reached[to] = Path(weight, path.written + 1, path.aside, *_written(path, _NAME[to].encode() + b":"))
            if not reached:
                return
            self.paths = self.paths | reached
            layer = reached

    def row(self, role: str, text: str, lost: bool, truncated: bool) -> None:
        """Read one row; ``lost`` rows can only be deleted."""
        if self.rows == BLOCK:
            self._put_aside()
        self.rows += 1
        edits: dict[int, list] = {}  # state reached: weight, path, role written (None: deleted)
        self._insert()
        extra = TRUNCATED_COST if truncated else 0
        initial = {"s": _S, "u": _U, "a": _A}.get(role[:1])
        for state, path in self.paths.items():
            options = [(DELETE, 0, state, None)]
            if not lost:
                options.append((REROLE, extra, _NEXT[state], _NAME[_NEXT[state]]))
                if initial is not None and (initial == _S and state == _START or initial != _S and initial == _NEXT[state]):
                    options.append((KEEP, extra, initial, role))
            for letter, more, to, shown in options:
                weight = path.step(letter, COSTS[letter] + more)
                if to not in edits or weight < edits[to][0]:
                    edits[to] = [weight, path, shown]
        self.paths = {
            to: Path(weight, path.written + 1, path.aside, *_written(path, None if shown is None else f"{shown}:{text}".encode()))
            for to, (weight, path, shown) in edits.items()}

    def _put_aside(self) -> None:
        """Let the letters' order be one digit, and begin a new block of digits."""
        mask = (1 << _HIGH) - 1
        ranked = sorted(self.paths, key=lambda s: self.paths[s].weight & mask)
        fresh = {}
        for rank, state in enumerate(ranked):
            path = self.paths[state]
            weight = (path.weight >> _HIGH << _HIGH) + (rank + 1 << _BITS * (_WIDTH - 1))
            fresh[state] = Path(weight, 1, (path.aside, _letters(path.weight, self.first)), path.digest, path.empty)
        self.paths, self.rows, self.first = fresh, 0, 1

    def best(self) -> tuple[int, str, str]:
        """Cost, letters of the edits and digest of the repaired rows."""
        self._insert()
        path = min((self.paths[s] for s in _FINAL if s in self.paths), key=lambda p: p.weight)
        parts, aside = [_letters(path.weight, self.first)], path.aside
        while aside:
            aside, letters = aside
            parts.append(letters)
        return path.weight >> _HIGH, "".join(reversed(parts)), path.digest.hexdigest()


# ---------------------------------------------------------------- rows and faults

def _shown(df: DataFrame, name: str) -> Column:
    return F.coalesce(column_of(df, name).cast("string"), F.lit(" "))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, gone) with ``blank``, ``duplicate`` and ``truncated``: the first that holds.

    Rows are ordered by turn, nulls first, then role and text. Rows marked ``gone`` have no fault and are no one's
    earlier copy; they only keep their conversation in being. The window is dealt by the conversation alone,
    as the repair is, so that one shuffle serves both.
    """
    here = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = ~F.col("gone") & (here == "")
    copies = Window.partitionBy("conv", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    earlier = ~F.col("gone") & (F.row_number().over(copies) > 1)
    cut = ~F.col("gone") & ~F.right(here, F.lit(1)).isin(".", "!", "?")
    return rows.repartition("conv").select(
        "*", blank.alias("blank"), (~blank & earlier).alias("duplicate"), cut.alias("_cut")
    ).select("conv", "turn", "role", "text", "gone", "blank", "duplicate",
             (F.col("_cut") & ~F.col("blank") & ~F.col("duplicate")).alias("truncated"))


class _Tally:
    """What is returned of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn, role, text, gone, blank, duplicate, truncated) -> None:
        if gone:
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        self.repair.row(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.best())


RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv, turn, role, text, gone), none of role, text and gone null.

    ``gaps``: turns missing between the least and the greatest; faults by kind; ``illegal``: neighbours whose role
    initials are not su, ua or au; ``cost`` and ``audit`` (initials of the edits in order) of the cheapest repair,
    ties to the audit first in ASCII; digest of the repaired rows. Rows without a conversation are one conversation. A
    conversation whose rows are all ``gone`` has noughts, an empty audit and the digest of nothing.
    """
    small_batches(rows.sparkSession, BATCH_ROWS)
    kind = rows.schema["conv"].dataType.simpleString()
    schema = T._parse_datatype_string(f"conv {kind}, {RESULT}")
    kinds = [rows.schema["conv"], *schema.fields[1:]]
    ordered = with_faults(rows).sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "text", "gone")

    def table(tallies: list[_Tally], like: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*(t.result() for t in tallies)))
        types = [like, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, like = None, [], None
        for batch in batches:
            like = batch.schema.field(0).type
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now)
                    now = _Tally(conv)
                now.row(*row)
            if done:
                yield table(done, like)
                done = []
        if now is not None:
            yield table([now], like)

    return ordered.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows (conv, turn, role, text, gone), a repeated row twice.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (``gone``), 1 empties its text, 2 takes its ``.!?``, 3
    repeats it, 4 makes it the user's. A null is one space.
    """
    conv, turn = column_of(conversations, "conv_id"), column_of(conversations, "turn")
    key = F.concat(_shown(conversations, "conv_id"), F.lit(":"), _shown(conversations, "turn"))
    part = F.crc32(key.cast("binary")) % 20
    text = _shown(conversations, "text")
    return conversations.select(
        conv.alias("conv"), turn.alias("turn"),
        F.when(part == 4, F.lit("user")).otherwise(_shown(conversations, "role")).alias("role"),
        F.when(part == 1, F.lit("")).when(part == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (part == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(part == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation after the contract's damage; see ``repair``.

    Nulls in any column are one space (a null turn stays without a number and comes first). Repeated rows are
    rows like any other. Rows of one turn are ordered by role, then text. Other columns are not looked at.
    """
    return repair(damaged(conversations)).withColumnRenamed("conv", "conv_id")
