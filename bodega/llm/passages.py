"""Passages that repeat across documents, found by collinear chaining.

Sampled runs of words (k-mers) that occur in several documents are seeds. Each occurrence is matched
with the seed's first document; the matches of two documents are chained in order by a Fenwick tree
under a gap cost; chains are aligned word by word, which finds their true ends through edits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import column_of, free_name, numbered, rolling, small_batches, text_chunks, word_table
from bodega.session import materialize

K = 8              # words of a seed
WINDOW = 12        # of every run of so many seeds the least is kept, so an exact run of 19 words has one
MIN_WORDS = 50     # of a passage
GAP_COST = 0.1     # of a word between two matches, in each document
MAX_GAP = 48       # words between two matches of one chain
MAX_SHIFT = 24     # and how far apart their diagonals may lie
MARGIN = 32        # words that an alignment may reach beyond its chain
MIN_ALIGNED = 16   # words of an alignment that counts towards a passage
JOIN_GAP = 2       # words between alignments that make one passage
GRID = 32          # slices of texts begin and end on multiples of this


def minimizers(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the sampled seeds of texts lying one after another.

    ``first``: each text's first word, and the total. Of each ``WINDOW`` neighbouring seeds of a text
    the least is kept; a text with fewer keeps its least.
    """
    seeds = rolling(words, K)
    n = len(seeds)
    counts = np.maximum(np.diff(first) - K + 1, 0)
    kept = []
    if n >= WINDOW:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        width = WINDOW + K - 1
        inside = text[:len(words) - width + 1] == text[width - 1:]
        best = seeds[:n - WINDOW + 1].copy()
        at = np.arange(len(best))
        for i in range(1, WINDOW):
            other = seeds[i:n - WINDOW + 1 + i]
            less = other < best
            best[less] = other[less]
            at[less] = np.flatnonzero(less) + i
        kept.append(np.unique(at[inside]))
    for t in np.flatnonzero((counts > 0) & (counts < WINDOW)).tolist():
        kept.append(np.array([first[t] + int(np.argmin(seeds[first[t]:first[t] + counts[t]]))]))
    places = np.concatenate(kept) if kept else np.empty(0, np.int64)
    owner = np.searchsorted(first, places, side="right") - 1
    return owner, places - first[owner], seeds[places]


class Fenwick:
    """Largest value over prefixes, with the index that holds it."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        """Over the places before ``at``."""
        found = (-1e18, -1)
        while at:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


def chain(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Chains of matches (place in one text, place in the other), both places rising.

    A chain's score is ``K`` a match less ``GAP_COST`` a word passed over in either text. The best
    chains are taken one after another; each is cut where a gap or a shift is too wide.
    """
    matches = sorted(set(matches))
    rank = {s: i for i, s in enumerate(sorted({s for _, s in matches}))}
    tree = Fenwick(len(rank))
    score, back = [0.0] * len(matches), [-1] * len(matches)
    at = 0
    while at < len(matches):
        end = at
        while end < len(matches) and matches[end][0] == matches[at][0]:
            d, s = matches[end]
            value, before = tree.upto(rank[s])
            gain = value - GAP_COST * (d + s)
            score[end], back[end] = (K + gain, before) if gain > 0 else (K, -1)
            end += 1
        for i in range(at, end):
            d, s = matches[i]
            tree.put(rank[s], (score[i] + GAP_COST * (d + s), i))
        at = end
    used = [False] * len(matches)
    chains = []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(matches[i])
            i = back[i]
        links.reverse()
        start = 0
        for j in range(1, len(links) + 1):
            if j == len(links) or max(links[j][0] - links[j - 1][0], links[j][1] - links[j - 1][1]) > MAX_GAP + K or abs(
                    links[j][0] - links[j][1] - links[j - 1][0] + links[j - 1][1]) > MAX_SHIFT:
                if j > start:
                    chains.append(links[start:j])
                start = j
    return chains


def document_chains(sources: list[int], places: list[int], source_places: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(source, begin, end, source begin, source end), in words, of a document's chains.

    Chains that lie too far from others to become part of a passage are left out.
    """
    by_source = defaultdict(list)
    for source, d, s in zip(sources, places, source_places):
        by_source[source].append((d, s))
    found = sorted((c[0][0], c[-1][0] + K, source, c[0][1], c[-1][1] + K) for source, m in by_source.items() for c in chain(m))
    out, run, reach = [], [], None
    for item in [*found, None]:
        if item is None or (reach is not None and item[0] > reach + MARGIN):
            if run and reach - run[0][0] + 2 * (WINDOW + K - 1) >= MIN_WORDS:
                out += [(source, d0, d1, s0, s1) for d0, d1, source, s0, s1 in run]
            run, reach = [], None
        if item is not None:
            run.append(item)
            reach = item[1] if reach is None else max(reach, item[1])
    return out


def _best_segment(same: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, matches) of the run of the largest sum of +1 for a match and -1 for none."""
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -1))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    begin = int(np.flatnonzero(sums[:end + 1] == low[end])[-1]) if end else 0
    return begin, end, int(same[begin:end].sum())


def _local_end(a: np.ndarray, b: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(score, end in a, end in b) of the best local alignment within ``band`` of a diagonal.

    +1 for equal words, -1 for others and for each word left out. A row of the table is a word of
    ``a``; what a row passes along itself is a running maximum.
    """
    width = 2 * band + 1
    steps = np.arange(width)
    row = np.zeros(width + 1, dtype=np.int64)  # by offset from the diagonal; one place beyond
    padded = np.concatenate([np.zeros(band + abs(diagonal) + len(a), b.dtype), b, np.zeros(band + abs(diagonal) + len(a), b.dtype)])
    known = np.concatenate([np.zeros(band + abs(diagonal) + len(a), bool), np.ones(len(b), bool), np.zeros(band + abs(diagonal) + len(a), bool)])
    base = band + abs(diagonal) + len(a)
    best = (0, 0, 0)
    for i in range(len(a)):
        at = base + i + diagonal - band
        same = known[at:at + width] & (padded[at:at + width] == a[i])
        new = np.maximum(np.maximum(row[:width] + np.where(same, 1, -1), row[1:] - 1), 0)
        new = np.maximum.accumulate(new + steps) - steps
        top = int(new.argmax())
        if new[top] > best[0]:
            best = int(new[top]), i + 1, i + diagonal - band + top + 1
        row[:width] = new
    return best


def align(a: np.ndarray, b: np.ndarray, begin: int, end: int, b_begin: int, b_end: int) -> tuple[int, int] | None:
    """The words of ``a`` that the alignment around a chain covers, None where it is too short or poor.

    The chain covers ``a[begin:end]`` and ``b[b_begin:b_end]``. Where both are equally long and one diagonal covers
    all of the chain, its words are compared directly; else words were put in or left out, and a banded
    alignment finds the ends, forwards and backwards.
    """
    shift = b_begin - begin
    straight = end - begin == b_end - b_begin
    if straight:
        low, high = max(0, -shift), min(len(a), len(b) - shift)
        first, last, equal = _best_segment(a[low:high] == b[low + shift:high + shift])
        first, last = first + low, last + low
        score = 2 * equal - (last - first)
    if not straight or first > begin or last < end:
        other = b_end - end
        middle, band = (shift + other) // 2, abs(shift - other) + MAX_SHIFT
        score, last, _ = _local_end(a, b, middle, band)
        backwards = (len(b) - len(a)) - middle
        _, first, _ = _local_end(a[::-1], b[::-1], backwards, band)
        first = len(a) - first
    if last - first < MIN_ALIGNED or score < 0.5 * (last - first):
        return None
    return first, last


def merge_spans(spans: list[tuple[int, int, int]], least: int = MIN_WORDS) -> list[tuple[int, int, list[int]]]:
    """(begin, end, sources) of the passages that alignments (begin, end, source) make together."""
    out: list[list] = []
    for begin, end, source in sorted(spans):
        if out and begin <= out[-1][1] + JOIN_GAP:
            out[-1][1] = max(out[-1][1], end)
            out[-1][2].add(source)
        else:
            out.append([begin, end, {source}])
    return [(b, e, sorted(s)) for b, e, s in out if e - b >= least]


# ---------------------------------------------------------------- jobs

def seed_table(docs: DataFrame) -> DataFrame:
    """seed, doc_id, place of every sampled seed of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_chunks(batch.column(1)):
                begins, _, _, words = word_table(data, bounds)
                owner, place, seed = minimizers(words, begins)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), batch.column(0).slice(first, end - first).take(pa.array(owner)), pa.array(place.astype(np.int32))],
                    names=["seed", "doc_id", "place"])

    return docs.mapInArrow(run, "seed bigint, doc_id bigint, place int")


def match_table(docs: DataFrame) -> DataFrame:
    """doc_id, place, source, source_place: each seed of a document and where the first document that
    has the seed has it first. Rows are as many as seeds that repeat, however often they do."""
    seeds = seed_table(docs)
    shared = seeds.groupBy("seed").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source < last").drop("last")
    hits = materialize(seeds.join(materialize(shared, "shared"), "seed"), "hits")
    # stored, so that the join below reads both sides from a shuffle and a hot seed can be split
    home = materialize(hits.where("doc_id = source").groupBy("seed").agg(F.min("place").alias("source_place")), "home")
    return hits.where("doc_id != source").join(home, "seed").select("doc_id", "place", "source", "source_place")


def chain_table(matches: DataFrame) -> DataFrame:
    """doc_id, source, begin, end, source_begin, source_end of all chains.

    A document's matches, one a seed of its own, are chained in one call.
    """
    grouped = matches.groupBy("doc_id").agg(F.collect_list(F.struct("source", "place", "source_place")).alias("m"))
    names = ["doc_id", "source", "begin", "end", "source_begin", "source_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            parts = batch.column(1)
            flat = parts.flatten()
            ends = np.cumsum([0] + [len(x) for x in parts])
            columns = [flat.field(i).to_pylist() for i in range(3)]
            for i, doc in enumerate(batch.column(0).to_pylist()):
                out += [(doc, *c) for c in document_chains(*(c[ends[i]:ends[i + 1]] for c in columns))]
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=names)

    return grouped.mapInArrow(run, "doc_id bigint, source bigint, begin int, end int, source_begin int, source_end int")


def slice_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, low, high, words (32-bit hashes) of the wanted (doc_id, low, high) parts of texts."""
    lists = wanted.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
    rows = docs.join(lists, "doc_id").select("doc_id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = []
            for first, end, data, bounds in text_chunks(batch.column(1)):
                begins, _, _, words = word_table(data, bounds)
                words = words.astype(np.uint32).view(np.int32)
                for i in range(first, end):
                    own = words[begins[i - first]:begins[i - first + 1]]
                    out += [(ids[i], p["low"], p["high"], own[p["low"]:p["high"]]) for p in parts[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.list_(pa.int32()))],
                names=["doc_id", "low", "high", "words"])

    return rows.mapInArrow(run, "doc_id bigint, low int, high int, words array<int>")


def aligned_table(chains: DataFrame, slices: DataFrame) -> DataFrame:
    """doc_id, source, begin, end of the alignments around the chains."""
    own = slices.select("doc_id", "low", "high", "words")
    other = slices.select(F.col("doc_id").alias("source"), F.col("low").alias("source_low"), F.col("high").alias("source_high"),
                          F.col("words").alias("source_words"))
    joined = chains.join(own, ["doc_id", "low", "high"]).join(other, ["source", "source_low", "source_high"]).select(
        "doc_id", "source", "begin", "end", "source_begin", "source_end", "low", "source_low", "words", "source_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, source, *numbers = (batch.column(i).to_pylist() for i in range(8))
            out = []
            for i, (d0, d1, s0, s1, low, source_low) in enumerate(zip(*numbers)):
                a, b = (batch.column(j)[i].values.to_numpy() for j in (8, 9))
                found = align(a, b, d0 - low, d1 - low, s0 - source_low, s1 - source_low)
                if found:
                    out.append((doc[i], source[i], found[0] + low, found[1] + low))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=["doc_id", "source", "begin", "end"])

    return joined.mapInArrow(run, "doc_id bigint, source bigint, begin int, end int")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, begin, end (in words), n_words and sources of every passage of 50 words or more that a
    document with a smaller id has as well, exactly or with words changed, put in or left out.

    The document with the smallest id that has a passage keeps it and is named in ``sources``; what a
    document repeats within itself is no matter here. Words are what stands between ASCII white
    space, in their own case. Rows without key, and null, empty or short texts, have no passage. Rows that share id
    and text are one document. Where rows of one id hold several texts, each text is a document, and those that do not go
    by the id come after all others (``numbered``); their passages are told under the id. Other columns are
    not looked at; an empty table gives an empty result.
    """
    named = docs.select(column_of(docs, key).cast("long").alias("doc_id"), column_of(docs, text).alias("text"))
    rows, _, several = numbered(named, "doc_id", "text", "node")
    rows = rows.where("node IS NOT NULL")
    found = _passages(rows.select(F.col("node").alias("doc_id"), "text"))
    if not several:
        return found
    ids = materialize(rows.select("node", F.col("doc_id").alias("id")).distinct(), "ids")
    own = found.join(ids, F.col("doc_id") == F.col("node")).drop("node", "doc_id")
    each = own.withColumn("source", F.explode("sources")).drop("sources")
    each = each.join(ids.select("node", F.col("id").alias("source_id")), F.col("source") == F.col("node"))
    return each.groupBy(F.col("id").alias("doc_id"), "begin", "end", "n_words").agg(
        F.sort_array(F.collect_set("source_id")).alias("sources"))


def _passages(rows: DataFrame) -> DataFrame:
    """``repeated_passages`` of rows (doc_id, text), where equal ids have equal texts."""
    small_batches(rows.sparkSession)

    def down(c: str):
        return (F.greatest(F.col(c) - MARGIN, F.lit(0)) / GRID).cast("int") * GRID

    def up(c: str):
        return F.ceil((F.col(c) + MARGIN) / GRID).cast("int") * GRID

    chains = materialize(chain_table(match_table(rows)).select(
        "*", down("begin").alias("low"), up("end").alias("high"),
        down("source_begin").alias("source_low"), up("source_end").alias("source_high")), "chains")
    wanted = chains.select("doc_id", "low", "high").unionByName(
        chains.select(F.col("source").alias("doc_id"), F.col("source_low").alias("low"), F.col("source_high").alias("high")))
    slices = materialize(slice_table(rows, wanted), "slices")
    grouped = aligned_table(chains, slices).groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end", "source")).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(doc, b, e, e - b, s) for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for b, e, s in merge_spans([(x["begin"], x["end"], x["source"]) for x in spans])]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=["doc_id", "begin", "end", "n_words", "sources"])

    return grouped.mapInArrow(run, "doc_id bigint, begin int, end int, n_words int, sources array<bigint>")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space behind them."""
    data = text.encode("utf-8", "replace")
    _, starts, _, _ = word_table(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64))
    place = [*starts.tolist(), len(data)]
    n = len(place) - 1
    out, at = [], 0
    for begin, end in sorted(spans):
        out.append(data[at:max(at, place[min(begin, n)])])
        at = max(at, place[min(end, n)])
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def cut_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` without the passages that documents of smaller ids have, and with the length put right
    where there is a column for it. Documents of which no word is left go; documents without such a
    passage are unchanged, as are rows without an id. Rows of one id are cut each by the passages of its own
    text. New columns are named apart from those of ``docs``. The join with the passages sorts and merges at
    any size: they grow with the documents."""
    name, spans = free_name(docs, "_node"), free_name(docs, "_spans")
    rows, _, _ = numbered(docs, key, text, name)
    node = F.col(f"`{name}`")
    found = _passages(rows.where(node.isNotNull()).select(node.alias("doc_id"), column_of(docs, text).alias("text")))
    lists = materialize(found.groupBy(F.col("doc_id").alias(name)).agg(F.collect_list(F.struct("begin", "end")).alias(spans)), "spans")
    joined = rows.join(lists.hint("merge"), name, "left").select(*[column_of(docs, c) for c in docs.columns], spans)
    small_batches(docs.sparkSession)
    at, spans_at = joined.columns.index(text), joined.columns.index(spans)
    chars_at = joined.columns.index(chars) if chars in docs.columns else None
    schema = T.StructType(docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()
            cut = [cut_text(t, [(s["begin"], s["end"]) for s in x]) if x and t else t for t, x in zip(texts, lists)]
            columns = list(batch.columns)
            columns[at] = pa.array(cut, pa.string())
            if chars_at is not None:
                lengths = [len(c) if x else n for c, x, n in zip(cut, lists, batch.column(chars_at).to_pylist())]
                columns[chars_at] = pa.array(lengths, batch.column(chars_at).type)
            del columns[spans_at]
            kept = [not x or bool((c or "").strip()) for c, x in zip(cut, lists)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(kept, pa.bool_()))

    return joined.mapInArrow(run, schema)
