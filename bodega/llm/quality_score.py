"""Quality classifier: random Fourier features of document statistics, ridge regression by normal
equations summed over partitions, and isotonic calibration."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import add_columns, bucket_of, column_of
from bodega.llm.host_rules import text_stats
from bodega.session import materialize

FEATURES = 192      # random cosine features of the kernel
RIDGE = 1.0
FIT_ROWS = 200_000  # labelled rows, about, that the weights and the calibration are fitted on
SEED = 20_240_501
BINS = 2000         # score bins of the calibration

_DIGIT, _UPPER, _MARK, _END = (re.compile(p) for p in ("[0-9]", "[A-Z]", "[^\\w\\s]", "[.!?][\"')]*\\s*$"))

STATS = ("log_chars", "log_words", "word_mean", "word_spread", "symbols_a_word", "marks_a_word", "digits_a_char",
         "upper_a_char", "distinct_words", "same_as_next", "repeated_windows", "duplicate_lines", "lines_a_word",
         "ended_lines", "short_words", "single_marks", "top_word")


def statistics(text: str | None) -> list[float]:
    """Seventeen numbers on a whole text; all zero where it has no word."""
    text = text or ""
    n, chars, symbols, dup_lines, repeats = text_stats(text)
    if not n:
        return [0.0] * len(STATS)
    words = text.split()
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    total = max(len(words), 1)
    return [
        math.log1p(len(text)), math.log1p(n), chars / n, float(sizes.std()), symbols / n, len(_MARK.findall(text)) / n,
        len(_DIGIT.findall(text)) / len(text), len(_UPPER.findall(text)) / len(text), len(counts) / total,
        sum(map(str.__eq__, words, words[1:])) / total, repeats / n, dup_lines / max(len(lines), 1), len(lines) / n,
        sum(_END.search(x) is not None for x in lines) / max(len(lines), 1), float((sizes <= 3).mean()),
        float((sizes <= 1).mean()), max(counts.values(), default=0) / total]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    points: tuple[np.ndarray, np.ndarray] | None = None  # calibration: raw score, share of label 1

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random features of standardised statistics, and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -5, 5)
        cosines = np.cos(x @ self.directions + self.phases) * math.sqrt(2 / self.directions.shape[1])
        return np.hstack([cosines, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score from 0 to 1; rows of one calibrated share keep the order of their raw scores."""
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        return 0.99 * np.interp(raw, *self.points) + 0.01 / (1 + np.exp(-8 * (np.clip(raw, -3, 4) - 0.5)))


def isotonic(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing means nearest to ``sums / counts``: neighbours that violate the order pool."""
    blocks: list[list[float]] = []
    for s, n in zip(sums.tolist(), counts.tolist()):
        blocks.append([s, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / n) for s, n, k in blocks])


def stats_matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), len(STATS))


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the features' products with each other and with the label.

    Each partition sums its own rows; Spark adds the partitions' sums entry by entry.
    """
    width = model.directions.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            phi = model.features(stats_matrix(batch.column(0)))
            y = np.array(batch.column(1).to_pylist(), dtype=np.float64)
            total += phi.T @ np.column_stack([phi, y])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["k", "v"])

    sums = rows.select("stats", "y").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(width * (width + 1))
    flat[sums["k"].to_numpy()] = sums["v"].to_numpy()
    flat = flat.reshape(width, width + 1)
    return flat[:, :width], flat[:, width]


def calibration_bins(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean raw score, sum of labels and number of rows of each score bin, by rising score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(stats_matrix(batch.column(0)))), batch.column(1)], names=["raw", "y"])

    raw = rows.select("stats", F.col("y").cast("double").alias("y")).mapInArrow(run, "raw double, y double")
    at = F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("raw"))) * (BINS / 3)).alias("bin")
    got = raw.groupBy(at).agg(F.avg("raw").alias("raw"), F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("raw").collect()
    return tuple(np.array([r[c] for r in got], dtype=np.float64) for c in ("raw", "y", "n"))


def train(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """Fit on ``stats`` (key, stats; one row a key or more) and ``labels`` (key, label).

    Labels that are null, neither 0 nor 1, or contradict each other for a key teach nothing. Four
    fifths of about ``FIT_ROWS`` labelled rows, chosen by a hash of the key, make the normal
    equations, one fifth the calibration. With no label every score is 0.5; with labels of one kind
    the calibration says so.
    """
    known = (
        labels.select(column_of(labels, key).alias("key"), column_of(labels, label).cast("int").alias("y"))
        .where("key IS NOT NULL AND y IN (0, 1)").groupBy("key")
        .agg(F.min("y").alias("y"), F.max("y").alias("high")).where("y = high").drop("high"))
    rows = stats.withColumnRenamed(key, "key").join(known, "key")
    n = rows.count()
    hashed = F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1 << 30))
    rows = rows.where(hashed < int(min(1.0, FIT_ROWS / max(n, 1)) * (1 << 30)))
    fold = F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(5))
    rows = materialize(rows.select("stats", "y", fold.alias("fold")).repartition(16), "labelled")
    moments = rows.select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).orderBy("i").collect()
    rng = np.random.default_rng(SEED)
    dims = len(STATS)
    model = Model(np.zeros(dims), np.ones(dims), rng.standard_normal((dims, FEATURES)) / math.sqrt(dims), rng.uniform(0, 2 * math.pi, FEATURES))
    if not moments:
        return model
    model.mean = np.array([r["mean"] for r in moments])
    model.scale = np.maximum(np.array([r["sd"] for r in moments]), 1e-6)
    products, targets = normal_equations(rows.where("fold > 0"), model)
    penalty = np.full(len(targets), RIDGE)
    penalty[-1] = 1e-6
    model.weights = np.linalg.solve(products + np.diag(penalty), targets)
    raw, y, count = calibration_bins(rows.where("fold = 0"), model)
    if not len(raw):  # too few labels to calibrate: the raw score as it is
        raw, y, count = np.array([0.0, 1.0]), np.array([0.0, 1.0]), np.ones(2)
    model.points = raw, isotonic(y, count)
    return model


def document_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(column_of(docs, key).alias("doc_id"), column_of(docs, text).alias("text"))
    made = add_columns(rows, "text", lambda t: (statistics(t),), [("stats", "array<double>", pa.list_(pa.float64()))])
    return materialize(made.drop("text"), "stats")


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Labels of rows whose crc32 of the key, modulo 3, is 1 are never read. Null and empty texts have
    statistics of zero and are scored by them. A null key is not held out. Repeated rows are scored
    one by one; other columns are not looked at; an empty table gives an empty result.

    Texts are read once; statistics, a few numbers a document, are stored in the shared folder.
    """
    stats = document_stats(docs, key, text)
    model = train(stats.where(bucket_of("doc_id", 3) != 1), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(shared.value.score(stats_matrix(batch.column(1))))], names=["doc_id", "score"])

    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = stats.mapInArrow(run, schema)
    return scored.select("doc_id", F.coalesce(bucket_of("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
