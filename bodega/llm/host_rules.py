"""Host-level quality rules: rule failures per host, shrunk by an empirical beta prior."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.common import add_columns, column_of, free_name
from bodega.session import materialize

WORD = re.compile("[^\x20\x09-\x0D]+")
SYMBOLS = re.compile("[#*$%&|<>]")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host goes when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5

STATS = [(n, "bigint", pa.int64()) for n in
         ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]


def repeat_words(words: list[str]) -> int:
    """Words lying in a window of three words that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    inside = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            inside[i] = inside[i + 1] = inside[i + 2] = 1
    return sum(inside)


def dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    counts = Counter(lines)
    return sum(n - 1 for line, n in counts.items() if n > 1 and WORD.search(line))


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    return (len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), dup_lines(text), repeat_words(words))


def with_stats(docs: DataFrame, text: str = "text", names: list[str] | None = None) -> DataFrame:
    """``docs`` and the five counts of each text, under ``names``."""
    names = names or [n for n, _, _ in STATS]
    return add_columns(docs, text, text_stats, [(n, t, k) for n, (_, t, k) in zip(names, STATS)])


def base_rule(n_words: str, n_repeat_words: str):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat_words) > MAX_REPEAT_PERCENT * F.col(n_words))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and weight of the beta prior that fits the hosts' failure rates, by moments.

    ``hosts``: one row a host with ``n`` documents and ``failed`` ones. The spread of the rates
    beyond what drawing documents explains gives the weight; hosts that do not differ give a prior
    as heavy as the corpus. No host: mean 0 and weight 1.
    """
    rate = F.col("failed") / F.col("n")
    sums = hosts.agg(
        F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("n").alias("hosts"),
        F.sum(F.col("n") * rate).alias("s1"), F.sum(F.col("n") * rate * rate).alias("s2")).first()
    if not sums["n"]:
        return 0.0, 1.0
    n = float(sums["n"])
    mean = sums["failed"] / n
    drawn = mean * (1 - mean)
    spread = sums["s2"] / n - mean * mean - drawn * sums["hosts"] / n
    if drawn <= 0 or spread <= drawn / (n + 1):
        return mean, n
    return mean, max(drawn / spread - 1, 1.0)


def host_rates(stats: DataFrame, host: str, failed: str) -> DataFrame:
    """host, n, failed, rate (shrunk) and bad: one row for each host other than null."""
    hosts = (
        stats.where(column_of(stats, host).isNotNull()).groupBy(column_of(stats, host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(failed).cast("long")).alias("failed")))
    hosts = materialize(hosts, "hosts")
    mean, weight = beta_prior(hosts)
    rate = (F.col("failed") + mean * weight) / (F.col("n") + weight)
    return hosts.withColumn("rate", rate).withColumn("bad", F.col("rate") > MAX_HOST_RATE)


def host_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each row of ``docs``: its key, the counts, base_failed, host_rate and kept.

    A text fails the base rules with fewer than 50 words or with over half of its words in repeated
    windows of three. A host is bad when its failure rate, shrunk by the beta prior fitted over all
    hosts, is above ``MAX_HOST_RATE``; every document of a bad host goes.

    Null and empty texts have no word and so fail. A null host is no host: only the base rules judge
    its documents. Repeated rows are judged and counted one by one. Other columns are not looked at.
    An empty table gives an empty result.

    Texts are read once; what is stored and joined is a row of counts. The join by host is left to
    Spark, which broadcasts the host table only below its size limit and splits hot hosts beyond it.
    """
    rows = docs.select(column_of(docs, key).alias("doc_id"), column_of(docs, host).cast("string").alias("host"),
                       column_of(docs, text).alias("text"))
    stats = materialize(with_stats(rows).drop("text").withColumn("base_failed", base_rule("n_words", "n_repeat_words")), "rules")
    rates = host_rates(stats, "host", "base_failed").select("host", F.col("rate").alias("host_rate"), "bad")
    return (
        stats.join(rates, "host", "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("bad"), F.lit(False)))
        .select("doc_id", *[n for n, _, _ in STATS], "base_failed", "kept", "host_rate"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs``, unchanged, that the base rules and their host's verdict let pass."""
    names = []
    for name, _, _ in STATS:
        names.append(free_name(docs, f"_{name}"))
    failed, bad = free_name(docs, "_failed"), free_name(docs, "_bad")
    joined, key = free_name(docs, "_host"), column_of(docs, host).cast("string")
    judged = materialize(with_stats(docs, text, names).withColumn(failed, base_rule(names[0], names[4]))
                         .drop(*names).withColumn(joined, key), "rules")
    rates = host_rates(judged, joined, failed)
    rates = rates.select(F.col("host").alias(joined), F.col("bad").alias(bad))
    return (
        judged.join(rates, joined, "left")
        .where(~F.col(failed) & ~F.coalesce(F.col(bad), F.lit(False)))
        .select(*[column_of(docs, c) for c in docs.columns]))
