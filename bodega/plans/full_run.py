"""Bronze, silver, gold in sequence; each stage needs the previous one's success."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Row, SparkSession

from bodega.functions.measures import AsOf
from bodega.plans.bronze import BronzeRun, ingest_all
from bodega.plans.gold import GoldRun, build_gold
from bodega.plans.silver import SilverRun, conform_all
from bodega.sources.origins import Source


class StageFailed(RuntimeError):
    """A stage did not succeed, so the following ones were not started."""


@dataclass(frozen=True)
class RunResult:
    log: list[Row]
    summaries: list[Row]
    rules: list[Row]
    gold: GoldRun


def run_medallion(spark: SparkSession, source: Source, root: str, as_of: AsOf = None,
                  catalog: str | None = None, strict: bool = False, newest_per_key: bool | None = None,
                  **bronze_options) -> RunResult:
    """One complete run below ``root``. Logs, summaries and rule results are a few rows each.

    A table that fails to load is in the log and the run goes on with what bronze holds of it, which
    may be nothing: gold tables that need it are then not built. ``strict`` stops after bronze
    instead. ``newest_per_key`` decides for silver, see ``SilverRun``.
    """
    bronze = BronzeRun(f"{root}/bronze", **bronze_options)
    log = ingest_all(spark, source, bronze).collect()
    failed = [row["table_name"] for row in log if row["status"] == "FAILED"]
    if failed and strict:
        raise StageFailed(f"bronze failed for {', '.join(failed)}: "
                          + "; ".join(r["error_message"] for r in log if r["status"] == "FAILED"))
    silver = SilverRun(f"{root}/silver", bronze, newest_per_key=newest_per_key, catalog=f"{catalog}_silver" if catalog else None)
    summaries = conform_all(spark, silver).collect()
    gold = GoldRun(f"{root}/gold", silver, as_of, catalog=f"{catalog}_gold" if catalog else None)
    return RunResult(log, summaries, build_gold(spark, gold), gold)
