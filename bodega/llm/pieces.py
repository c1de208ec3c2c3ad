"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

Text is normalised by the longest prefixes in the model's compiled character map; each normalised
byte remembers the original bytes it came from. Pair merging then runs on the normalised words, and
each piece is projected back through that alignment.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.common import column_of, map_rows

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Words whose encoding a worker remembers before it starts afresh.
CACHE_WORDS = 500_000
NEVER = float("inf")
# Characters of text whose new words are encoded together.
LEARN_CHARS = 1 << 20


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(number, value) of each field of a serialised message; fixed 32-bit values come as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = 4 if kind == 5 else 8
            if kind == 2:
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """The compiled character map: a double-array trie of prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if blob else []
        self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and what replaces it."""
        if not self.units:
            return None
        best, node = None, 0
        unit = self.units[0]
        node ^= self._offset(unit)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if (unit & 0x800000FF) != data[i]:  # label of a child, never that of a leaf
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                start = self.units[node] & 0x7FFFFFFF
                best = i + 1 - at, start
        if best is None:
            return None
        length, start = best
        return length, self.texts[start:self.texts.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


@dataclass
class Encoded:
    """Ids of a text, the normalised pieces' original byte spans, and the decoded text."""
    ids: list[int]
    spans: list[tuple[int, int]]


class _Word(NamedTuple):
    count: int
    size: int     # in characters of the normalised word
    ids: bytes    # 32-bit ids
    ends: bytes   # 32-bit ends of the pieces in the normalised word
    shown: str    # the ids in decimal, joined by spaces
    decoded: str


_COUNT, _SIZE, _IDS, _ENDS, _SHOWN, _DECODED = map(itemgetter, range(6))


class Pairs:
    """Which symbols join to which piece, at what cost, as sorted arrays.

    A symbol is a piece, by its id, or a single character that some piece has but that is none itself.
    """

    def __init__(self, ids: dict[str, int], cost: dict[str, float]):
        known = dict(ids)
        self.extra = count = max(ids.values(), default=-1) + 1  # the first symbol that is no piece
        for piece in ids:
            for c in piece:
                if c not in known:
                    known[c] = count
                    count += 1
        self.base = count
        self.symbol = np.full(0x110000, -1, dtype=np.int64)
        self.length = np.zeros(count, dtype=np.int64)
        for text, i in known.items():
            self.length[i] = len(text)
            if len(text) == 1:
                self.symbol[ord(text)] = i
        found = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = known.get(piece[:cut]), known.get(piece[cut:])
                if a is not None and b is not None:
                    found[a * count + b] = (i, cost[piece])
        self.key = np.array(sorted(found), dtype=np.int64)
        self.piece = np.array([found[k][0] for k in self.key.tolist()], dtype=np.int64)
        self.cost = np.array([found[k][1] for k in self.key.tolist()], dtype=np.float64)

    def find(self, a: np.ndarray, b: np.ndarray, together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that a and b join to and its cost, ``NEVER`` where they do not or are not ``together``."""
        if not len(self.key):
            return np.full(len(a), -1, np.int64), np.full(len(a), NEVER)
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = together & (self.key[at] == key)
        return np.where(hit, self.piece[at], -1), np.where(hit, self.cost[at], NEVER)


@dataclass
class PieceModel:
    """A BPE model file of the sentencepiece library, read by hand."""
    pieces: list[tuple[str, float, int]]
    charmap: CharacterMap
    dummy_prefix: bool
    trim: bool
    byte_fallback: bool
    ids: dict[str, int] = field(default_factory=dict)
    cost: dict[str, float] = field(default_factory=dict)  # of joining to a piece: its score negated
    shown: list[str] = field(default_factory=list)
    byte_ids: list[int] = field(default_factory=list)
    unknown: int = 0
    end: int = -1
    cache: dict[str, _Word] = field(default_factory=dict)
    pairs: Pairs | None = None

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as file:
            raw = file.read()
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                piece = {1: b"", 2: struct.pack("<f", 0), 3: NORMAL} | dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models are read")
        if any(kind in (USER, UNUSED) for _, _, kind in pieces) or trainer.get(24, 0):
            raise ValueError("models with user-defined or unused pieces or trailing space marks are not read")
        model = cls(pieces, CharacterMap(normalizer.get(2, b"")), bool(normalizer.get(3, 1)),
                    bool(normalizer.get(4, 1)), bool(trainer.get(35, 0)))
        model.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        model.cost = {p: -pieces[i][1] for p, i in model.ids.items()}
        model.shown = [str(i) for i in range(len(pieces))]
        if any(SPACE in p.lstrip(SPACE) for p in model.ids):
            raise ValueError("pieces across words are not read")
        model.byte_ids = [i for i, (_, _, kind) in enumerate(pieces) if kind == BYTE]
        model.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        model.end = next((i for i, (p, _, kind) in enumerate(pieces) if kind == CONTROL and p == "</s>"), -1)
        return model

    # ------------------------------------------------------------ normalising

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text (spaces shown as the mark) and, for each of its characters, the first
        original byte it stands for; one more entry holds the original length."""
        data = text.encode("utf-8", "replace")
        if not self.charmap.units and not self.trim:  # characters stand for themselves
            if not data:
                return "", np.zeros(1, np.int64)
            origin = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            origin = np.concatenate([np.zeros(int(self.dummy_prefix), np.int64), origin, [len(data)]])
            return (" " * self.dummy_prefix + text).replace(" ", SPACE), origin
        out, origin, at = [], [], 0
        while at < len(data):
            hit = self.charmap.longest(data, at)
            if hit:
                length, made = hit[0], hit[1].decode("utf-8")
            else:
                lead = data[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                made = data[at:at + length].decode("utf-8")
            out.extend(made)
            origin.extend([at] * len(made))
            at += length
        total = len(data)
        if self.trim:  # outer spaces go, runs become one
            kept, before = [], " "
            for i, c in enumerate(out):
                if c != " " or before != " ":
                    kept.append(i)
                before = c
            while kept and out[kept[-1]] == " ":
                total = origin[kept.pop()]
            out, origin = [out[i] for i in kept], [origin[i] for i in kept]
        if not out:
            return "", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out.insert(0, " ")
            origin.insert(0, origin[0] if self.trim else 0)
        return "".join(out).replace(" ", SPACE), np.array([*origin, total])

    # ------------------------------------------------------------ merging

    def _merge(self, word: str) -> list[str]:
        """Join the best-scored adjacent pair, leftmost first, until no pair is a piece."""
        parts, cost = list(word), self.cost.get
        costs = [cost(a + b, NEVER) for a, b in zip(word, word[1:])]
        while costs and (best := min(costs)) != NEVER:
            at = costs.index(best)
            joined = parts[at] + parts[at + 1]
            parts[at:at + 2] = [joined]
            del costs[at]
            if at:
                costs[at - 1] = cost(parts[at - 1] + joined, NEVER)
            if at < len(costs):
                costs[at] = cost(joined + parts[at + 1], NEVER)
        return parts

    def _merge_long(self, word: str) -> list[str]:
        """The same by a heap, for long runs without a space."""
        cost, n = self.cost.get, len(word)
        parts: list[str | None] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (found := cost(joined := parts[i] + parts[j], NEVER)) != NEVER:
                heapq.heappush(heap, (found, i, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def learn(self, chunks: set[str]) -> None:
        """Encode many new words at once and keep them: all of them take their next merge together.

        Symbols of all words lie in one array, the cost of joining each with its neighbour in another. A
        round joins the cheapest pair of every word, leftmost first, and looks the two new
        neighbours up; words without a pair left are done. Words with characters that no piece has, and very long
        ones, are left to ``word``.
        """
        if self.pairs is None:
            self.pairs = Pairs(self.ids, self.cost)
        chunks = [c for c in chunks if len(c) <= 48]
        if not chunks:
            return
        if len(self.cache) + len(chunks) > CACHE_WORDS:
            self.cache.clear()
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        word = np.repeat(np.arange(len(chunks)), sizes)
        symbol = self.pairs.symbol[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")]
        strange = np.zeros(len(chunks), dtype=bool)
        strange[word[symbol < 0]] = True
        symbol, word = symbol[~strange[word]], word[~strange[word]]
        done = []
        joined, cost = self.pairs.find(symbol[:-1], symbol[1:], word[:-1] == word[1:])
        joined, cost = np.append(joined, -1), np.append(cost, NEVER)
        while len(symbol):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(cost, first)
            going = np.repeat(best != NEVER, counts)
            if not going.all():
                done.append((word[~going], symbol[~going]))
                word, symbol, joined, cost = word[going], symbol[going], joined[going], cost[going]
                best, counts = best[best != NEVER], counts[best != NEVER]
                if not len(symbol):
                    break
            at = np.flatnonzero(cost == np.repeat(best, counts))
            at = at[np.diff(word[at], prepend=-1) != 0]  # the leftmost of each word
            symbol[at] = joined[at]
            left = np.ones(len(symbol), dtype=bool)
            left[at + 1] = False
            word, symbol, joined, cost = word[left], symbol[left], joined[left], cost[left]
            at = at - np.arange(len(at))
            near = np.concatenate([at, at[at > 0] - 1])
            after = np.minimum(near + 1, len(symbol) - 1)
            joined[near], cost[near] = self.pairs.find(
                symbol[near], symbol[after], (word[near] == word[after]) & (after > near))
        word = np.concatenate([w for w, _ in done] or [word])
        symbol = np.concatenate([s for _, s in done] or [symbol])
        by = np.argsort(word, kind="stable")
        word, symbol = word[by], symbol[by]
        strange[word[symbol >= self.pairs.extra]] = True
        ends = np.cumsum(self.pairs.length[symbol])
        first = np.searchsorted(word, np.arange(len(chunks) + 1))
        base = np.concatenate([[0], ends])[first]
        ids = symbol.astype(np.int32)
        ends = (ends - base[word]).astype(np.int32)
        listed, first, shown = ids.tolist(), first.tolist(), self.shown
        raw_ids, raw_ends = ids.tobytes(), ends.tobytes()
        for i, (chunk, other) in enumerate(zip(chunks, strange.tolist())):
            if not other:
                a, b = first[i], first[i + 1]
                self.cache[chunk] = _Word(b - a, len(chunk), raw_ids[4 * a:4 * b], raw_ends[4 * a:4 * b],
                                          " ".join([shown[x] for x in listed[a:b]]), chunk.replace(SPACE, " "))

    def word(self, chunk: str) -> _Word:
        """Encoding of one normalised word with the marks in front of it."""
        found = self.cache.get(chunk)
        if found is not None:
            return found
        parts = self._merge(chunk) if len(chunk) <= 48 else self._merge_long(chunk)
        ids, ends, at = [], [], 0
        whole = True
        for part in parts:
            at += len(part)
            known = self.ids.get(part)
            if known is not None:
                ids.append(known)
                ends.append(at)
                continue
            whole = False
            if self.byte_fallback:
                for byte in part.encode("utf-8"):
                    ids.append(self.byte_ids[byte])
                    ends.append(at)
            elif ids and ids[-1] == self.unknown:  # neighbouring unknown characters are one piece
                ends[-1] = at
            else:
                ids.append(self.unknown)
                ends.append(at)
        shown = self.shown
        made = _Word(len(ids), len(chunk), array("i", ids).tobytes(), array("i", ends).tobytes(),
                     " ".join([shown[i] for i in ids]), chunk.replace(SPACE, " ") if whole else self.decode(ids))
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        if len(chunk) <= 64:
            self.cache[chunk] = made
        return made

    def chunks(self, normal: str) -> list[str]:
        """The normalised text cut before each run of marks: no piece reaches over such a cut."""
        if SPACE * 2 not in normal and not normal.endswith(SPACE) and normal.startswith(SPACE):
            return [SPACE + c for c in normal[1:].split(SPACE)]
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", normal)

    def words(self, normal: str) -> list[_Word]:
        cache, word = self.cache, self.word
        return [cache.get(c) or word(c) for c in self.chunks(normal)] if normal else []

    @staticmethod
    def spans(words: list[_Word], origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end, in the original text, of each piece of the words in order.

        The bytes of one character share its span.
        """
        counts = np.array(list(map(_COUNT, words)), dtype=np.int64)
        lengths = np.array(list(map(_SIZE, words)), dtype=np.int64)
        ends = np.frombuffer(b"".join(map(_ENDS, words)), dtype=np.int32)
        ends = ends + np.repeat(np.cumsum(lengths) - lengths, counts)
        fresh = np.ones(len(ends), dtype=bool)
        fresh[1:] = ends[1:] != ends[:-1]
        own = np.cumsum(fresh) - 1  # which of the distinct spans each piece has
        distinct = ends[fresh]
        begins = np.concatenate([[0], distinct[:-1]]) if len(distinct) else distinct
        return origin[begins[own]], origin[ends]

    def encode(self, text: str | None, add_end: bool = True) -> Encoded:
        """Ids with the original byte span of each; the end id has the empty span behind the text."""
        normal, origin = self.normalize(text or "")
        words = self.words(normal)
        begins, ends = self.spans(words, origin)
        ids = np.frombuffer(b"".join(map(_IDS, words)), dtype=np.int32).tolist()
        spans = list(zip(begins.tolist(), ends.tolist()))
        if add_end:
            ids.append(self.end)
            spans.append((int(origin[-1]), int(origin[-1])))
        return Encoded(ids, spans)

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int], whole: bool = False) -> str:
        """Text of the ids: control ids show nothing, byte ids join to characters (U+FFFD where they
        do not), marks become spaces; with ``whole``, what the dummy prefix added is taken off."""
        out, raw = [], bytearray()
        first = True
        for i in ids:
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                raw.append(int(piece[3:5], 16))
                continue
            if raw:
                out.append(decode_bytes(raw))
                raw.clear()
                first = False
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(UNKNOWN_SURFACE)
            else:
                if whole and first and (self.dummy_prefix or self.trim) and piece.startswith(SPACE):
                    piece = piece.lstrip(SPACE) if self.trim else piece[1:]
                out.append(piece.replace(SPACE, " "))
            first = False
        if raw:
            out.append(decode_bytes(raw))
        return "".join(out)

    def digests(self, texts: Iterable[str | None]) -> Iterator[tuple[int, str, str, int]]:
        """``digest`` of each text; the new words of about ``LEARN_CHARS`` characters are encoded at once."""
        waiting, size = [], 0
        for text in texts:
            waiting.append(self.normalize(text or ""))
            size += len(waiting[-1][0])
            if size >= LEARN_CHARS:
                yield from self._digests(waiting)
                waiting, size = [], 0
        yield from self._digests(waiting)

    def _digests(self, normals: list[tuple[str, np.ndarray]]) -> Iterator[tuple[int, str, str, int]]:
        chunks = [self.chunks(normal) if normal else [] for normal, _ in normals]
        self.learn(set().union(*chunks).difference(self.cache))
        cache, word = self.cache, self.word
        for (normal, origin), own in zip(normals, chunks):
            yield self._digest(normal, origin, [cache.get(c) or word(c) for c in own])

    def digest(self, text: str | None) -> tuple[int, str, str, int]:
        """Number of ids with the end id, SHA-256 of the ids and of the decoded text, bytes that the
        spans cover."""
        return next(self.digests([text]))

    def _digest(self, normal: str, origin: np.ndarray, words: list[_Word]) -> tuple[int, str, str, int]:
        begins, ends = self.spans(words, origin)
        shown = " ".join([*map(_SHOWN, words), str(self.end)])
        decoded = "".join(map(_DECODED, words))
        if (self.dummy_prefix or self.trim) and decoded.startswith(" ") and normal.startswith(SPACE):
            decoded = decoded.lstrip(" ") if self.trim else decoded[1:]
        covered = int((np.maximum(ends, 0) - np.maximum.accumulate(np.concatenate([[0], ends[:-1]]))).sum()) if len(ends) else 0
        return (len(ends) + 1, hashlib.sha256(shown.encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(), covered)


def decode_bytes(raw: bytes) -> str:
    """UTF-8 with U+FFFD for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[at:at + size]).decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_models: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """The model, read once in each Python worker. The file must lie on every machine."""
    if path not in _models:
        _models[path] = PieceModel.load(path)
    return _models[path]


def encode_table(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, begins and ends (bytes of the original text) of every row's whole text.

    A null text is empty and gives the end id alone. Rows are encoded one by one, so repeated keys
    and extra columns do not matter, and an empty table gives an empty result.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        made = [model_at(path).encode(t) for t in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array([m.ids for m in made], pa.list_(pa.int32())),
                pa.array([[s for s, _ in m.spans] for m in made], pa.list_(pa.int64())),
                pa.array([[e for _, e in m.spans] for m in made], pa.list_(pa.int64()))]

    rows = docs.select(column_of(docs, key).cast("long").alias("k"), column_of(docs, text).alias("t"))
    return map_rows(rows, run, f"`{key}` bigint, ids array<int>, begins array<bigint>, ends array<bigint>")


def digest_table(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_table``, but only counts and digests leave the worker: key, n_tokens, ids_sha256,
    decoded_sha256 and covered_bytes (of the original text, by the pieces' spans)."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = model_at(path)
        made = list(model.digests(batch.column(1).to_pylist()))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
        return [batch.column(0), *[pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]]

    rows = docs.select(column_of(docs, key).cast("long").alias("k"), column_of(docs, text).alias("t"))
    return map_rows(rows, run, f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, covered_bytes bigint")
