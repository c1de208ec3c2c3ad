"""Near-duplicate documents by ProbMinHash.

A document is a probability distribution over its shingles of five words. Every shingle arrives at
the registers of the signature as a Poisson process whose rate is its weight and whose randomness
depends on the shingle alone; a register keeps the shingle that arrives first. Arrivals later than
the latest of the registers cannot count, so each process ends early. Two signatures agree in a
register with the probability Jaccard similarity of the two documents. Bands of registers give
candidates, and candidates are verified on their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.common import (
    column_of,
    free_name,
    mix,
    numbered,
    rolling,
    small_batches,
    text_chunks,
    word_table,
)
from bodega.llm.components import components
from bodega.session import materialize

WORDS = 5        # of a shingle
SIMILARITY = 0.8
BANDS, ROWS = 40, 6  # a pair of similarity 0.8 misses all bands with probability 5e-6
REGISTERS = BANDS * ROWS
# Texts are compared where sketches (a byte a register) agree in this share: 0.8 lies four standard
# errors above it.
SKETCH_SHARE = 0.7
# Sketches that agree in this share put documents into one group, within which all are compared.
LOOSE_SHARE = 0.5
BLOCK_ROWS = 256
# Parts that the rows of every loose group are dealt to where they meet their group's row.
GROUP_SALTS = 32
# Rounds of leaders in the buckets of one band, before what is left meets in two bands at once.
SINGLE_ROUNDS = 2

MASK = (1 << 64) - 1
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


def shingle_table(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts lying one after another.

    Returns text number, hash and count of each distinct shingle of a text, ordered by text, and the
    texts' digests (two 64-bit words of the sequence of words; the second return has a row a text:
    n_words in the last). A text of one to four words is one shingle.
    """
    first, _, _, words = word_table(data, bounds)
    n_texts = len(bounds) - 1
    n_words = np.diff(first)
    text = np.repeat(np.arange(n_texts), n_words)
    place = (np.arange(len(words)) - np.repeat(first[:-1], n_words)).astype(np.uint64)
    digest = np.zeros((n_texts, 2), dtype=np.uint64)
    some = np.flatnonzero(n_words)
    for i, c in enumerate((_C1, _C2)):
        digest[some, i] = np.add.reduceat(mix(words + c * (place + np.uint64(1))), first[:-1][some]) if len(some) else 0
    runs = rolling(words, WORDS)
    whole = text[:len(runs)] == text[WORDS - 1:] if len(runs) else np.zeros(0, dtype=bool)
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    owner = np.concatenate([text[:len(runs)][whole], short])
    hashed = np.concatenate([runs[whole], digest[short, 0]])
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], hashed[at], np.diff(np.append(at, len(owner))), digest, n_words


def weights(count: np.ndarray) -> np.ndarray:
    """Weight of a shingle that a text repeats ``count`` times: repetition counts, but dampened."""
    return 1 + np.log(count)


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first at each register of each text (zeros for texts without any).

    All texts go on together: in each round every process still running makes its next arrival.
    """
    first = np.full(n_texts * registers, np.inf)
    kept = np.zeros(n_texts * registers, dtype=np.uint64)
    sizes = np.bincount(owner, minlength=n_texts)
    alone = sizes[owner] == 1  # the only shingle of a text is first everywhere
    kept.reshape(n_texts, registers)[owner[alone]] = shingle[alone][:, None]
    owner, shingle, weight = owner[~alone], shingle[~alone], weight[~alone]
    time = np.zeros(len(owner))
    latest = np.full(n_texts, np.inf)
    turn = 0
    while len(owner):
        draw = mix(shingle + np.uint64(int(_C1) * (2 * turn + 1) & MASK))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        running = time < latest[owner]
        if not running.all():
            owner, shingle, weight, time = owner[running], shingle[running], weight[running], time[running]
        register = mix(shingle + np.uint64(int(_C3) * (2 * turn + 2) & MASK)) % np.uint64(registers)
        at = owner * registers + register.astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        kept[at[won]] = shingle[won]
        turn += 1
        texts = np.unique(owner) if turn > 4 else slice(None)
        latest[texts] = first.reshape(n_texts, registers)[texts].max(axis=1)
    return kept.reshape(n_texts, registers)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit word for each band, different for equal rows in different bands."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for i in range(ROWS):
        out = mix(out * _C2 + parts[:, :, i])
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two texts, each given as sorted distinct shingles and their weights:
    the measure that signatures estimate. Where no shingle is repeated it is the plain Jaccard similarity.

    The probability Jaccard similarity is the sum over shared shingles d of
    1 / sum over all shingles e of max(a_e / a_d, b_e / b_d).
    """
    (sa, wa), (sb, wb) = a, b
    if not len(sa) or not len(sb):
        return 0.0
    shared, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    if not len(shared) or (wa.max() == 1 and wb.max() == 1):
        return len(shared) / (len(sa) + len(sb) - len(shared))
    # sort all shingles by the ratio of their weights: at d, those with a_e/b_e over a_d/b_d count a_e/a_d
    both_a = np.concatenate([wa, np.zeros(len(sb) - len(shared))])
    both_b = np.concatenate([np.zeros(len(sa)), np.delete(wb, ib)])
    both_b[ia] = wb[ib]
    with np.errstate(divide="ignore"):
        ratio = both_a / both_b
    order = np.argsort(ratio, kind="stable")
    above = np.concatenate([np.cumsum(both_a[order][::-1])[::-1], [0.0]])
    below = np.concatenate([[0.0], np.cumsum(both_b[order])])
    cut = np.searchsorted(ratio[order], ratio[ia], side="left")
    return float((1 / (above[cut] / both_a[ia] + below[cut] / both_b[ia])).sum())


def text_shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    _, hashed, count, _, _ = shingle_table(data, np.array([0, len(data)], dtype=np.int64))
    return hashed, weights(count)


# ---------------------------------------------------------------- jobs

def signature_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, n_words, digest (16 bytes), sketch (a byte a register) and bands of each row."""
    small_batches(docs.sparkSession, 1000)
    rows = docs.where(column_of(docs, key).isNotNull()).select(
        column_of(docs, key).cast("long").alias("doc_id"), column_of(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_chunks(batch.column(1)):
                owner, shingle, count, digest, n_words = shingle_table(data, bounds)
                signature = signatures(owner, shingle, weights(count), end - first)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(end - first + 1, dtype=np.int32) * BANDS), pa.array(band_hashes(signature).view(np.int64).ravel()))
                sketch = (signature & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n_words), pa.array([d.tobytes() for d in digest], pa.binary()),
                     pa.array([s.tobytes() for s in sketch], pa.binary()), bands],
                    names=["doc_id", "n_words", "digest", "sketch", "bands"])

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, digest binary, sketch binary, bands array<bigint>")


def sketch_shares(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """pairs (a, b) with the share of registers in which the sketches of both agree."""
    joined = pairs.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")).hint("merge"), "a").join(
        sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")).hint("merge"), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).mean(axis=1))], names=["a", "b", "share"])

    return joined.mapInArrow(run, "a bigint, b bigint, share double")


def some_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given doc_id. Ids grow with the documents, so that they are not broadcast
    at any size: small and large tables get one plan."""
    return rows.join(ids.distinct().hint("merge"), "doc_id", "left_semi")


def ids_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def loose_pairs(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """a, b, share: for each bucket of a band, its documents tied to leaders they resemble loosely;
    and doc_id, sketch of the documents that share a bucket with another.

    A bucket's smallest document leads; those whose sketches agree with the leader's in
    ``LOOSE_SHARE`` are tied to it, the rest choose a leader among themselves, and so on until
    every document has a leader or is alone. Each round makes one row a document and bucket, never
    all pairs of a bucket. Documents that share little more than one passage fall into one bucket and
    would need a round each; so from ``SINGLE_ROUNDS`` on, what has no leader yet is put into buckets of
    two bands. A pair of similarity 0.8 shares less than two bands with probability 8e-5.
    """
    members = signed.select(F.explode("bands").alias("h"), F.col("doc_id").alias("b"))
    found, met = None, None
    turn = 0
    while True:
        leaders = members.groupBy("h").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        led = materialize(members.join(leaders, "h").where("a != b").select("h", "a", "b"), "members")
        if met is None:  # who shares no bucket in the first round shares none later
            met = materialize(some_rows(signed.select("doc_id", "sketch"), ids_of(led)), "sketches")
        pairs = materialize(sketch_shares(led.select("a", "b").distinct(), met), "pairs")
        tied = pairs.where(F.col("share") >= LOOSE_SHARE)
        found = tied if found is None else found.unionByName(tied)
        apart = pairs.where(F.col("share") < LOOSE_SHARE).select("a", "b")
        members = materialize(led.join(apart, ["a", "b"], "left_semi").select("h", "b"), "members")
        if members.isEmpty():
            return found.groupBy("a", "b").agg(F.max("share").alias("share")), met
        turn += 1
        if turn == SINGLE_ROUNDS:
            members = band_pairs(members)


def band_pairs(members: DataFrame) -> DataFrame:
    """Members (h, b) in buckets of two bands: one row for each two buckets, both shared, of a document."""
    shared = members.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    lists = members.join(shared, "h").groupBy("b").agg(F.sort_array(F.collect_set("h")).alias("hs"))
    firsts = lists.select("b", "hs", F.posexplode("hs").alias("i", "h"))  # at most as many as bands
    seconds = firsts.select("b", "h", F.explode(F.expr("slice(hs, i + 2, size(hs))")).alias("other"))
    return seconds.select(F.xxhash64("h", "other").alias("h"), "b")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    small_batches(pairs.sparkSession, 100)
    joined = pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).hint("merge"), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")).hint("merge"), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if x not in known:  # leaders come often
                    known = {x: text_shingles(x)} if len(known) > 50 else known | {x: text_shingles(x)}
                keep.append(similarity(known[x], text_shingles(y)) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a bigint, b bigint")


def block_links(ids: list[int], asks: list[bool], parts: list[int], sketches: np.ndarray, texts: list[str]) -> list[tuple[int, int]]:
    """Links that tie the asking documents of a block to others in it of another component.

    Likeliest pairs first; pairs that links found before already tie are not compared.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    shingles: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(i: int):
        if i not in shingles:
            shingles[i] = text_shingles(texts[i])
        return shingles[i]

    pairs = []
    part = np.array(parts)
    for i in np.flatnonzero(asks).tolist():
        share = (sketches == sketches[i]).mean(axis=1)
        pairs += [(-share[j], i, j) for j in np.flatnonzero((share >= SKETCH_SHARE) & (part != part[i])).tolist()]
    out = []
    for _, i, j in sorted(pairs):
        a, b = root(parts[i]), root(parts[j])
        if a != b and similarity(of(i), of(j)) >= SIMILARITY:
            parent[max(a, b)] = min(a, b)
            out.append((ids[i], ids[j]))
    return out


def remaining_links(loose: DataFrame, links: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between documents of one loose group that the links to leaders have not tied.

    In a group of several components, every document outside the largest one meets all documents of
    the group, in blocks of about ``BLOCK_ROWS`` documents; a task holds two such blocks.
    """
    groups = components(loose).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    own = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    placed = materialize(
        groups.join(own, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id")), "groups")
    parts = placed.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("group").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", F.col("part").alias("part"))).alias("top"))
    main = main.where("parts > 1").select(
        "group", F.col("top.part").alias("top"), F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK_ROWS).cast("int").alias("asking"))
    dealt = placed.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(GROUP_SALTS)).cast("int"))
    main = main.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(GROUP_SALTS - 1))))
    rows = dealt.join(main, ["group", "_salt"]).drop("_salt").join(sketches.hint("merge"), "doc_id")
    rows = materialize(rows.join(texts.hint("merge"), "doc_id").withColumn("asks", F.col("part") != F.col("top")), "blocks")
    spread = F.xxhash64("doc_id")
    columns = ["group", "i", "j", "doc_id", "part", "sketch", "text"]
    every = rows.withColumn("j", F.pmod(spread, "blocks").cast("int")).withColumn("i", F.explode(F.expr("sequence(0, asking - 1)")))
    asking = rows.where("asks").withColumn("i", F.pmod(spread, "asking").cast("int")).withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = every.select(*columns, F.lit(False).alias("asks")).unionByName(asking.select(*columns, "asks"))

    def compare(block: pa.Table) -> pa.Table:
        sketches = np.frombuffer(b"".join(block["sketch"].to_pylist()), dtype=np.uint8).reshape(block.num_rows, -1)
        found = block_links(block["doc_id"].to_pylist(), block["asks"].to_pylist(), block["part"].to_pylist(), sketches, block["text"].to_pylist())
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return met.groupBy("group", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _classes(rows: DataFrame, repeated: bool) -> DataFrame:
    """doc_id, class_id, is_kept of rows (doc_id, text), where equal ids have equal texts."""
    def once(df: DataFrame) -> DataFrame:
        return df.dropDuplicates(["doc_id"]) if repeated else df

    all_signed = materialize(signature_table(rows, "doc_id", "text"), "signatures")
    copies = materialize(all_signed.where("n_words > 0").groupBy("digest").agg(F.min("doc_id").alias("first")), "copies")
    signed = materialize(
        once(some_rows(all_signed.where("n_words > 0"), copies.select(F.col("first").alias("doc_id")))
             .select("doc_id", "sketch", "bands")), "signed")
    tied, sketches = loose_pairs(signed)
    loose = materialize(tied, "loose")
    near = materialize(once(some_rows(rows, ids_of(loose))), "near")  # the only texts that move on
    links = materialize(verified(loose.where(F.col("share") >= SKETCH_SHARE), near), "links")
    more = materialize(remaining_links(loose.select("a", "b"), links, sketches, near), "links")
    classes = components(links.unionByName(more)).select(F.col("node").alias("first"), "component")
    named = copies.join(classes, "first", "left").select("digest", F.coalesce("component", "first").alias("class_id"))
    of_rows = all_signed.select("doc_id", "n_words", "digest").join(named, "digest", "left").select(
        "doc_id", F.when(F.col("n_words") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))
    return of_rows.withColumn("is_kept", F.col("doc_id") == F.col("class_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id and is_kept of every row: near duplicates share a class, named by its smallest id.

    Documents are linked when the probability Jaccard similarity of their shingles of five words, weighted by
    how often a text repeats them, is 0.8 or more, and classes are the components of links; is_kept tells the
    smallest. Copies (the same words in the same order) are one document from the start. Words are what stands
    between ASCII white space, in their own case. A text without a word, null or empty, is alone in
    its class. A null id has a null class and is kept. Rows that share id and text are one document. Where rows of one
    id hold several texts, each text is a document: one goes by the id, the others by large numbers of their own
    (``numbered``), so each has the class of its text. Other columns are not looked at; an empty table gives an empty result.
    """
    named = docs.select(column_of(docs, key).cast("long").alias("doc_id"), column_of(docs, text).alias("text"))
    rows, repeated, several = numbered(named, "doc_id", "text", "node")
    some = rows.where("node IS NOT NULL")
    of_rows = _classes(some.select(F.col("node").alias("doc_id"), "text"), repeated)
    if several:
        ids = some.select("node", F.col("doc_id").alias("id")).distinct()
        of_rows = of_rows.join(ids, F.col("doc_id") == F.col("node")).select(F.col("id").alias("doc_id"), "class_id", "is_kept")
    alone = rows.where("node IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("is_kept"))
    return of_rows.unionByName(alone)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, less the near duplicates of a kept one.

    Where rows repeat an id and its text, one row of them stays: the least by a digest of its columns, so that a task run
    again chooses the same. Rows of one id with different texts are documents of their own. Rows without an id
    stay. The join with what goes sorts and merges at any size: what goes grows with the documents.
    """
    name = free_name(docs, "_node")
    rows, repeated, _ = numbered(docs, key, text, name)
    node = F.col(f"`{name}`")
    known = rows.where(node.isNotNull()).select(node.alias("doc_id"), column_of(docs, text).alias("text"))
    classes = materialize(_classes(known, repeated), "classes")
    gone = classes.where("NOT is_kept").select(F.col("doc_id").alias(name)).distinct()
    kept = rows.join(gone.hint("merge"), name, "left_anti")
    columns = [column_of(docs, c) for c in docs.columns]
    if not repeated:
        return kept.select(*columns)
    row = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row")
    once = kept.where(node.isNotNull()).groupBy(node.alias("_of")).agg(row).select("_row.*")
    return once.unionByName(kept.where(node.isNull()).select(*columns))
