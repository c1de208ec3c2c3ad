"""Bulk-synchronous best-fit packing of token sequences.

Documents longer than a sequence are cut; the pieces are then packed by sweeps. In a sweep all
pieces still to be placed and all gaps stand in one order by size, every gap takes the largest
piece that no nearer gap takes (the successor match), equal sizes are told apart by rank, the gaps
shrink, and the next sweep begins. Pieces that no gap holds open new sequences.

Lengths are whole numbers up to the capacity, so pieces of one length (and gaps of one size) are
alike: a sweep matches runs of ranks, of which there are few however many documents there are. What
is distributed is what grows: cutting, ranking every piece within its length, and looking up the
run of each piece's rank.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.common import column_of, small_batches
from bodega.session import materialize

CAPACITY = 2048
END_ID = 0
# Words whose tokens a worker remembers before it starts afresh.
CACHE_WORDS = 500_000
SPECIAL = "<|endoftext|>"
# Pieces of one length that one task ranks.
CELL_ROWS = 250_000


# ---------------------------------------------------------------- tokens


class ByteTokens:
    """Token ids of a byte-level BPE vocabulary, as 32-bit words.

    ``ranks_path`` holds the vocabulary as ranks, ``json_path`` the same for the tokenizers library,
    which defines the ids; texts that name the special token go through it.

    Tokens never reach over a single space between two other characters: the space belongs to what
    follows. So a text is cut there, and each part is encoded once per worker.
    """

    _cut = re.compile(r"(?<=\S) (?=\S)")
    _odd = re.compile(r"\s\s|^\s|\s$|[\x1c-\x1f]")

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.full = Tokenizer.from_file(json_path)
        self.cache: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.cache.get(part)
        if found is None:
            found = np.array(self.plain(" " + part), dtype="<u4").tobytes()
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            if len(part) <= 64:
                self.cache[part] = found
        return found

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        parts = self._cut.split(text) if self._odd.search(text) else text.split(" ")
        cache, part = self.cache, self._part
        first = np.array(self.plain(parts[0]), dtype="<u4").tobytes()
        return first + b"".join([cache.get(p) or part(p) for p in parts[1:]])


# The word pattern of the vocabulary: fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_tokens: dict[str, ByteTokens] = {}


def tokens_at(json_path: str, ranks_path: str) -> ByteTokens:
    if json_path not in _tokens:
        _tokens[json_path] = ByteTokens(json_path, ranks_path, PATTERN)
    return _tokens[json_path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, and before them the rest."""
    head = n % capacity
    starts = [0] * bool(head) + list(range(head, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str, key: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row's tokens and end id."""
    small_batches(docs.sparkSession)
    rows = docs.select(column_of(docs, key).cast("long").alias("k"), column_of(docs, text).alias("t"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        encode = tokens_at(json_path, ranks_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(t or "") + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc, i, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    return rows.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


# ---------------------------------------------------------------- sweeps over runs of ranks


def successor_match(pieces: np.ndarray, gaps: np.ndarray) -> list[tuple[int, int, int]]:
    """One sweep: (piece size, gap size, number of matches), each gap taking one piece at most.

    ``pieces[s]`` and ``gaps[g]`` count pieces of size ``s`` and gaps of size ``g``. Going down the
    sizes, a piece takes the smallest gap still free that holds it: gaps lie on a stack, the
    smallest on top.
    """
    above = np.flatnonzero(gaps)[::-1].tolist()
    if not above:
        return []
    sizes = np.flatnonzero(pieces[:above[0] + 1])[::-1].tolist()
    stack: list[list[int]] = []
    out, at = [], 0
    for size in sizes:
        while at < len(above) and above[at] >= size:
            stack.append([above[at], int(gaps[above[at]])])
            at += 1
        left = int(pieces[size])
        while left and stack:
            gap, free = stack[-1]
            n = min(left, free)
            out.append((size, gap, n))
            left -= n
            if n == free:
                stack.pop()
            else:
                stack[-1][1] -= n
        if not stack and at == len(above):
            break
    return out


class Sweeps:
    """Runs of sequences and of ranks, matched sweep by sweep.

    A run of sequences (first id, how many, gap) holds sequences of the same free room. Placing a
    run of pieces (length, first rank, how many) into it is one entry of ``placed``:
    (length, first rank, end rank, sequence of the first rank, pieces a sequence, offset).
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.next_rank = np.zeros(capacity + 1, dtype=np.int64)
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs by gap size
        self.free = np.zeros(capacity + 1, dtype=np.int64)  # gaps by size
        self.sequences = 0
        self.placed: list[tuple[int, int, int, int, int, int]] = []
        self.rounds = 0

    def _put(self, length: int, n: int, first: int, each: int, offset: int) -> None:
        rank = int(self.next_rank[length])
        self.placed.append((length, rank, rank + n, first, each, offset))
        self.next_rank[length] += n
        self.left[length] -= n

    def _open(self, length: int, n: int) -> None:
        """New sequences for ``n`` pieces of one length, as many in each as fit."""
        each = min(self.capacity // length, n)
        full, rest = divmod(n, each)
        for sequences, inside in ((full, each), (1, rest)):
            if not sequences or not inside:
                continue
            self._put(length, sequences * inside, self.sequences, inside, 0)
            room = self.capacity - inside * length
            self._gap(room, (self.sequences, sequences))
            self.sequences += sequences

    def _gap(self, room: int, run: tuple[int, int]) -> None:
        if room:
            self.gaps[room].append(run)
            self.free[room] += run[1]

    def _take(self, gap: int, n: int) -> list[tuple[int, int]]:
        """``n`` sequences of this gap, run by run."""
        self.free[gap] -= n
        out = []
        while n:
            first, size = self.gaps[gap].pop()
            used = min(size, n)
            out.append((first, used))
            if used < size:
                self.gaps[gap].append((first + used, size - used))
            n -= used
        return out

    def sweep(self) -> int:
        """Match all pieces left with all gaps; the number of pieces placed."""
        self.rounds += 1
        matches = successor_match(self.left, self.free)
        shrunk = []
        for length, gap, n in matches:
            for first, size in self._take(gap, n):
                self._put(length, size, first, 1, self.capacity - gap)
                shrunk.append((gap - length, (first, size)))
        for room, run in shrunk:
            self._gap(room, run)
        return sum(n for _, _, n in matches)

    def pack(self) -> list[tuple[int, int, int, int, int, int]]:
        """Place everything: pieces over half a sequence open one each; then sweeps until no gap
        takes a piece, new sequences for the largest length left, and so on."""
        for length in np.flatnonzero(self.left)[::-1].tolist():
            if 2 * length > self.capacity:
                self._open(length, int(self.left[length]))
        while self.left.any():
            while self.sweep():
                pass
            if self.left.any():
                length = int(np.flatnonzero(self.left)[-1])
                self._open(length, int(self.left[length]))
        return self.placed


# ---------------------------------------------------------------- ranks of all pieces


def celled(pieces: DataFrame) -> tuple[DataFrame, dict[int, int], dict[tuple[int, int], int]]:
    """``pieces`` with a cell, the number of each length, and the rank at which each cell begins.

    A length that many pieces share is dealt to cells of about ``CELL_ROWS`` rows by a hash of the
    piece, so many tasks rank it. What is counted here is a row for each length and cell.
    """
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = F.lit(1)
    hot = [x for length, n in totals.items() if n > CELL_ROWS for x in (F.lit(length), F.lit(-(-n // CELL_ROWS)))]
    if hot:
        cells = F.coalesce(F.create_map(*hot)[F.col("length")], cells)
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), cells).cast("int"))
    begins, before = {}, {}
    sizes = pieces.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n")).collect() if hot else [
        {"length": length, "cell": 0, "n": n} for length, n in totals.items()]
    for row in sorted(sizes, key=lambda r: (r["length"], r["cell"])):
        begins[row["length"], row["cell"]] = before.get(row["length"], 0)
        before[row["length"]] = before.get(row["length"], 0) + row["n"]
    return pieces, totals, begins


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces, totals, begins = celled(pieces)
    runs = Sweeps(totals, capacity).pack()
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    for length in totals:
        own = sorted(r[1:] for r in runs if r[0] == length)
        by_length[length] = tuple(np.array(c, dtype=np.int64) for c in zip(*own))
    # bounded by the capacity, not by the number of pieces
    shared = spark.sparkContext.broadcast((begins, by_length))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches):
        begins, by_length = shared.value
        at: dict[tuple[int, int], int] = {}  # rows of each cell seen by this task
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            ranks = np.empty(len(lengths), dtype=np.int64)
            for i, key in enumerate(zip(lengths, batch.column("cell").to_pylist())):
                seen = at.get(key, 0)
                ranks[i] = begins[key] + seen
                at[key] = seen + 1
            lengths = np.array(lengths, dtype=np.int64)
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths):
                first, _, start, each, place = by_length[int(length)]
                rows = np.flatnonzero(lengths == length)
                r = np.searchsorted(first, ranks[rows], side="right") - 1
                inside = ranks[rows] - first[r]
                sequence[rows] = start[r] + inside // each[r]
                offset[rows] = place[r] + inside % each[r] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names[:5]], pa.array(sequence), pa.array(offset)], names=names)

    # a cell lies whole in one partition, in an order that a repeated task finds again
    ordered = pieces.repartition("length", "cell").sortWithinPartitions("length", "cell", "doc_id", "piece", "start", "ids_crc32")
    return ordered.mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, key: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document, and its place in the sequences.

    doc_id, piece, start, length, ids_crc32, sequence_id (from 0) and offset. A document's tokens end
    with id 0. Null and empty texts are that one id. Repeated rows are packed each for itself; a null
    key stays null. Other columns are not looked at; an empty table gives an empty result.

    Tokens are made once; the table of pieces, a few numbers a document, is stored in the shared
    folder. Cells of equal pieces keep their order on a retry, as they are sorted by all columns;
    rows equal in all of them may change places, which changes nothing in the result.
    """
    pieces = materialize(token_pieces(docs, json_path, ranks_path, key, text, capacity), "pieces")
    return place(pieces, capacity)

