"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader under an elastic net; the scores are then
calibrated by a temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import bucket_of, column_of, free_name, small_batches

ORDERS = 3               # n-grams of one to so many characters
BUCKETS = 1 << 14        # hashed n-grams
SAMPLE_A_LANGUAGE = 1000  # documents a language that the weights and the temperature are fitted on
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
EPOCHS = 3
UNKNOWN = "und"
MIN_SCORE = 0.3

_SPACE = np.uint32(32)
_letters = np.zeros(0, dtype=bool)


def letter_table() -> np.ndarray:
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the n-grams of each whole text.

    Letters are lower-cased; what stands between them counts as one space.
    """
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    all_codes = np.concatenate(codes)
    letter = letter_table()[all_codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    keep[1:] |= rows[1:] != rows[:-1]
    c, rows, letter = np.where(letter, all_codes, _SPACE)[keep], rows[keep], letter[keep]
    keys = []
    h = np.zeros(len(c), dtype=np.uint32)
    width = np.uint32(32 - BUCKETS.bit_length() + 1)
    for n in range(1, ORDERS + 1):
        h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
        if not len(h):
            break
        whole = rows[:len(h)] == rows[n - 1:]
        if n == 1:
            whole = whole & letter
        bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> width
        keys.append((rows[:len(h)].astype(np.int64) * BUCKETS + bucket)[whole])
    counts = np.bincount(np.concatenate(keys), minlength=1) if keys else np.zeros(1, np.int64)
    at = np.flatnonzero(counts)
    return at // BUCKETS, at % BUCKETS, counts[at]


def text_groups(column: pa.Array, rows: int = 64, chars: int = 1 << 20) -> Iterator[list[str | None]]:
    """Texts in lists of at most ``rows`` texts and about ``chars`` characters."""
    group, size = [], 0
    for text in column.to_pylist():
        group.append(text)
        size += len(text or "")
        if len(group) == rows or size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray       # of each bucket
    weights: np.ndarray   # buckets and, last, the bias; by language
    temperature: float = 1.0

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, value): damped counts times idf, each row of length one."""
        row, bucket, count = grams(texts)
        value = (1 + np.log(count)) * self.idf[bucket]
        norm = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
        return row, bucket, value / np.maximum(norm, 1e-12)[row]

    def logits(self, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(row, value * self.weights[bucket, k], minlength=n) + self.weights[-1, k]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(*self.vectors(texts), len(texts)) / self.temperature)
        best = p.argmax(axis=1)
        seen = np.fromiter(map(has_letter, texts), dtype=bool, count=len(texts))
        return ([self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)],
                np.where(seen, p[np.arange(len(texts)), best], 0.0))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn_weights(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Follow-the-regularised-leader with per-coordinate rates, L1 and L2, over sparse examples."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros_like(z)

    def weights(at) -> np.ndarray:
        zs = z[at]
        l1 = np.where(np.asarray(at) == BUCKETS, 0.0, L1)[:, None]
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for bucket, value, label in examples:
            at = np.append(bucket, BUCKETS)
            x = np.append(value, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean() + 1e-4 * t * t

    low, high, cut = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(learn: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all of ``learn`` (text), and the number of texts.

    Each partition counts for itself; Spark sums the counts by bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for texts in text_groups(batch.column(0)):
                seen[:-1] += np.bincount(grams(texts)[1], minlength=BUCKETS)
            seen[-1] += batch.num_rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "n"])

    rows = learn.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in rows:
        seen[r["bucket"]] = r["n"]
    return seen[:-1], int(seen[-1])


def train(learn: DataFrame) -> Model:
    """Fit on ``learn`` (key, text, lang; no nulls in lang).

    Document frequencies cover every row. Weights and temperature are fitted on about
    ``SAMPLE_A_LANGUAGE`` rows of each language, chosen by a hash of the key: three quarters for the
    weights, the rest for the temperature. Rows of no letter teach nothing.
    """
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)))
    df, total = document_frequencies(learn.select("text"))
    model = Model(languages, np.log((1 + total) / (1 + df)) + 1, np.zeros((BUCKETS + 1, len(languages))))

    hashed = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = F.when(F.col("lang") == lang, hashed < int(min(1.0, SAMPLE_A_LANGUAGE / n) * (1 << 30))).otherwise(chosen)
    sample = learn.where(chosen).select("text", "lang", F.xxhash64("key", "text").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(0)):
                row, bucket, value = model.vectors(texts)
                ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(at, len(texts)), batch.column(2).slice(at, len(texts)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(value.astype(np.float32)))],
                    names=["lang", "h", "bucket", "value"])
                at += len(texts)

    found = sample.mapInArrow(run, "lang string, h bigint, bucket array<int>, value array<float>").toArrow()
    order = np.argsort(found["h"].to_numpy(), kind="stable")
    langs = found["lang"].to_pylist()
    buckets, values = found["bucket"].combine_chunks(), found["value"].combine_chunks()
    examples = []
    for i in order.tolist():
        b, v = (x[i].values for x in (buckets, values))
        if len(b):
            examples.append((b.to_numpy(), v.to_numpy().astype(np.float64), languages.index(langs[i])))
    held = examples[3::4]
    model.weights = learn_weights([e for i, e in enumerate(examples) if i % 4 != 3], len(languages))
    if held:
        row = np.repeat(np.arange(len(held)), [len(b) for b, _, _ in held])
        logits = model.logits(row, np.concatenate([b for b, _, _ in held]), np.concatenate([v for _, v, _ in held]), len(held))
        model.temperature = fit_temperature(logits, np.array([k for _, _, k in held]))
    return model


def learning_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Text and language of the rows outside the held-out fifth, by crc32 of the key; rows without
    key, text or language teach nothing."""
    return docs.where(bucket_of(key, 5) != 0).select(
        column_of(docs, key).cast("string").alias("key"), column_of(docs, text).alias("text"),
        column_of(docs, lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")


def with_language(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` and the predicted language and score of each whole text.

    Texts that are null, empty or without a letter get ``und`` and 0, and so does every text where
    nothing could be learned. Only the text is looked at.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType(docs.schema.fields + [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for texts in text_groups(batch.column(at)):
                n, s = shared.value.predict(texts)
                names += n
                scores.append(s)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows of ``docs``.

    A row with a null key is not held out and teaches nothing. Repeated rows are predicted one by
    one; other columns are not looked at; an empty table gives an empty result.
    """
    model = train(learning_rows(docs, key, text, lang))
    rows = docs.select(column_of(docs, key).alias("doc_id"), column_of(docs, text).alias("text"))
    return with_language(rows, model).select(
        "doc_id", F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is told with a score of ``MIN_SCORE`` or more."""
    model = train(learning_rows(docs, key, text, lang))
    pred, score = free_name(docs, "_lang"), free_name(docs, "_score")
    judged = with_language(docs, model, text, pred, score)
    return judged.where((F.col(pred) != UNKNOWN) & (F.col(score) >= MIN_SCORE)).drop(pred, score)
