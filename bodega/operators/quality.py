"""Column quality report, run summary and data rules."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bodega.functions.measures import percent
from bodega.operators.conform import ACCEPTED, REASON
from bodega.schemas import NULL_REASON
from bodega.session import materialize


def _long_form(row: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return row.unpivot(ids, columns, name, value)


def quality_report(tagged: DataFrame, table: str, original: int | Column, batch_id: str) -> DataFrame:
    """Per column of the accepted rows: null count and share; per table: rejects and conformity.

    ``tagged`` carries ``error_reason``. One aggregate over the table whatever its width.
    ``rejected_records`` counts null rejects, ``fk_rejected`` the foreign-key rejects.
    """
    ok = F.col(REASON) == ACCEPTED
    columns = [c for c in tagged.columns if c != REASON]
    original = F.lit(original) if isinstance(original, int) else original
    row = tagged.agg(
        F.count_if(ok).alias("_total"),
        F.count_if(F.col(REASON) == NULL_REASON).alias("rejected_records"),
        F.count_if(~F.col(REASON).isin(ACCEPTED, NULL_REASON)).alias("fk_rejected"),
        *[F.count_if(ok & F.col(c).isNull()).alias(c) for c in columns],
    )
    facts = ["_total", "rejected_records", "fk_rejected"]
    return _long_form(row, facts, columns, "column_name", "null_count").select(
        F.lit(table).alias("table_name"),
        "column_name",
        "null_count",
        percent(F.col("null_count"), F.col("_total")).alias("null_percentage"),
        "rejected_records",
        "fk_rejected",
        percent(F.col("_total"), original).alias("conform_percentage"),
        F.lit(batch_id).alias("batch_id"),
    )


def run_summary(tagged: DataFrame, table: str, original: int) -> DataFrame:
    """One row per table: rows read, rows after dedup, rows kept, rows rejected."""
    ok = F.col(REASON) == ACCEPTED
    return tagged.agg(
        F.count("*").alias("dedup_count"),
        F.count_if(ok).alias("final_count"),
        F.count_if(F.col(REASON) == NULL_REASON).alias("rejected_count"),
        F.count_if(~ok & (F.col(REASON) != NULL_REASON)).alias("fk_rejected_count"),
    ).select(F.lit(table).alias("table_name"), F.lit(original).cast("long").alias("original_count"), "*")


@dataclass(frozen=True)
class Rule:
    """A named rule over one table; ``violation`` is true on a row that breaks it."""

    name: str
    violation: Column


def not_null(name: str, column: str) -> Rule:
    return Rule(name, F.col(column).isNull())


def in_range(name: str, column: str, low: float | None = None, high: float | None = None) -> Rule:
    outside = [F.col(column) < low] if low is not None else []
    outside += [F.col(column) > high] if high is not None else []
    return Rule(name, reduce(lambda a, b: a | b, outside))


def check_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(test_name, violations) for all rules of one table from one aggregate."""
    row = df.agg(*[F.count_if(rule.violation).alias(rule.name) for rule in rules])
    return _long_form(row, [], [rule.name for rule in rules], "test_name", "violations")


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows (or keys) that occur more than once, with their number of copies.

    Copies are combined before the shuffle, so a row with very many copies is no hot spot.
    """
    return df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("copies")).where("copies > 1")


def check_table(df: DataFrame, rules: list[Rule], duplicates: str) -> DataFrame:
    """(test_name, violations) of row rules and of the rule that no row occurs twice, named ``duplicates``.

    One pass: a 128-bit hash of each row is shuffled together with the rules it breaks, and the sums
    are observed while the hashes seen twice are stored. Only rows under such a hash are then
    compared in full, so a few copies do not send the table through another shuffle.
    """
    spark = df.sparkSession
    columns = [F.col(f"`{c}`") for c in df.columns]
    a, b = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    broken = [F.coalesce(r.violation, F.lit(False)).cast("long").alias(f"r{i}") for i, r in enumerate(rules)]
    hashed = df.select(a.alias("a"), b.alias("b"), *broken).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("copies"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rules))])
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    observed = hashed.observe(seen, F.count(F.lit(1)).alias("n"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rules))])
    twice = materialize(observed.where("copies > 1").select(F.col("a").alias("_a"), F.col("b").alias("_b")), "twice")
    surplus = 0
    if not twice.isEmpty():
        suspects = df.join(twice, (a == F.col("_a")) & (b == F.col("_b")), "left_semi")
        surplus = duplicate_rows(suspects).agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    counts = [(r.name, int(seen.get.get(f"r{i}") or 0)) for i, r in enumerate(rules)]
    return spark.createDataFrame([*counts, (duplicates, int(surplus))], "test_name string, violations bigint")


def check_no_duplicates(df: DataFrame, name: str) -> DataFrame:
    """Surplus rows: row count minus distinct row count."""
    return check_table(df, [], name)


def rule_results(*checks: DataFrame) -> DataFrame:
    """(test_name, passed) over all checks."""
    return reduce(DataFrame.unionByName, checks).select(
        "test_name", (F.col("violations") == 0).alias("passed"))
