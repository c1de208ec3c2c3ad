"""Exact membership of URL rules by a cascade of Bloom filters, in DataFrame functions alone.

Level 0 encodes the listed keys. Some keys of the corpus that are not listed pass it too; level 1
encodes those, level 2 the listed keys that pass level 1, and so on until no key of the other kind
passes. Over the complete universe of the corpus's keys the answer is then exact: a key is listed
if the first level that it does not pass has an odd number. No join is needed to judge a URL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm.common import column_of
from bodega.session import materialize

# Rules (host, path, verdict) of the registered query: fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
BITS_A_KEY = 24
HASHES = 8
# Bits of all levels that one task holds: 32 MB.
MAX_BITS = 1 << 28

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands behind the first ``://``: the host up to /, ? or #, with A-Z in lower case, and
    the path up to ? or #. Both are empty where the url is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All rules that would fit: each suffix of the host's labels with each prefix of the path that
    is as long as some rule's path."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(F.length(path) >= n, F.substr(path, F.lit(1), n))),
        lambda p: p.isNotNull()) if lengths else F.array().cast("array<string>")
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def positions(key: Column, bits: int, level: int) -> list[Column]:
    """Bit positions of a key in a level's filter."""
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits)) for i in range(HASHES)]


@dataclass
class Level:
    bits: int
    words: list[int]

    def passes(self, key: Column, level: int) -> Column:
        words = F.lit(self.words)
        out = F.lit(True)
        for p in positions(key, self.bits, level):
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            out = out & (F.call_function("shiftright", word, F.pmod(p, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


def level_of(keys: DataFrame, level: int) -> Level:
    """The filter of a table of keys: bits set by an aggregate over its 64-bit words.

    Its size follows the number of keys, which are the listed ones or the few false positives of the
    level before, never the corpus.
    """
    n = keys.count()
    bits = max(64, -(-n * BITS_A_KEY // 64) * 64)
    if bits > MAX_BITS:
        raise ValueError(f"{n} keys need {bits} bits, over {MAX_BITS}; split the list by a hash of the key")
    at = keys.select(F.explode(F.array(*positions(F.col("key"), bits, level))).alias("p"))
    rows = at.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(p, 64) AS INT))")).alias("bits")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row["w"]] = row["bits"]
    return Level(bits, words)


class Cascade:
    """Filters by level; ``contains`` is exact for every key of the universe it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.levels[i].passes(key, i), F.lit(i % 2 == 1)).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, most_levels: int = 64) -> Cascade:
    """The cascade of ``listed`` (one column, key) over ``universe`` (key; may repeat).

    The universe is read once, for level 1: only keys that pass level 0 go on, so what is shuffled
    and stored is the false positives. Later levels draw on the two sets before.
    """
    listed = materialize(listed.where(F.col("key").isNotNull()).distinct(), "listed")
    levels = [level_of(listed, 0)]
    passing = universe.where(levels[0].passes(F.col("key"), 0)).distinct()
    other = materialize(passing.join(listed, "key", "left_anti"), "passing")
    inside, outside = other, listed  # the set the next level encodes, and the one it must not pass
    while not inside.isEmpty():
        if len(levels) == most_levels:
            raise ValueError("the cascade does not end")
        level = len(levels)
        levels.append(level_of(inside, level))
        inside, outside = materialize(outside.where(levels[-1].passes(F.col("key"), level)), "passing"), inside
    return Cascade(levels)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    ``rules``: host, path (beginning with /), verdict. A rule fits a url whose host is the rule's or
    lies below it and whose path begins with the rule's; of those that fit, the longest decides
    (host and path written together; a null rule where none fits, with the ``default`` verdict:
    what is not on the list passes). A rule given twice counts once, and blocks if either copy
    does. Rules with a null host or path fit nothing.

    A null url, or one without ``://``, has an empty host and path. Repeated rows are judged one by
    one; other columns are not looked at; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    rule_keys = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), "verdict").where("key IS NOT NULL")
    rule_keys = materialize(rule_keys, "rules")
    lengths = sorted(r["n"] for r in rule_keys.select("n").distinct().collect())
    host, path = host_and_path(column_of(pages, url))
    rows = pages.select(column_of(pages, key).alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    listed = rule_keys.select("key").distinct()
    known = build_cascade(listed, keyed.select(F.explode("keys").alias("key")))
    blocked = build_cascade(rule_keys.where("verdict = 'block'").select("key"), listed)
    fitting = F.filter("keys", known.contains)
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))
    return keyed.select("page_id", "host", "path", longest["key"].alias("rule")).withColumn(
        "verdict",
        F.when(F.col("rule").isNull(), F.lit(default)).when(blocked.contains(F.col("rule")), "block").otherwise("allow"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
