"""Steps that do not need each other, at the same time: small tables fill the cores that large ones leave idle."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 4  # tables whose jobs may run at the same time


@dataclass(frozen=True)
class Outcome:
    """What a step returned, or the error it ended with, or the failed steps that kept it from starting."""

    value: Any = None
    seconds: float = 0.0
    error: Exception | None = None
    kept_by: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return self.error is None and not self.kept_by


def run_steps(spark: SparkSession, steps: Mapping[str, Callable[[], Any]], needs: Mapping[str, Sequence[str]] | None = None,
              at_once: int = AT_ONCE) -> dict[str, Outcome]:
    """Run every step once those it needs have succeeded, at most ``at_once`` at a time; outcomes in the order of ``steps``.

    Needs outside ``steps`` count as met. A step that fails stops only those that need it, directly or through others.
    Each step's jobs run in a pool of its name, so that under ``spark.scheduler.mode`` FAIR a large table does not hold
    up a small one. A step must not change the session's settings: all share them.
    """
    waits = {name: {n for n in (needs or {}).get(name, ()) if n in steps} for name in steps}
    outcomes: dict[str, Outcome] = {}
    running: dict[Future, str] = {}

    def work(name: str) -> Outcome:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        start = time.monotonic()
        try:
            return Outcome(steps[name](), time.monotonic() - start)
        except Exception as error:  # noqa: BLE001 - the caller decides what a failed step means
            return Outcome(None, time.monotonic() - start, error)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, at_once), "steps") as pool:
        while len(outcomes) < len(steps):
            known = len(outcomes)
            for name in steps:
                if name in outcomes or name in running.values():
                    continue
                if kept := tuple(n for n in steps if n in waits[name] and n in outcomes and not outcomes[n].ok):
                    outcomes[name] = Outcome(kept_by=kept)
                elif waits[name] <= outcomes.keys() and len(running) < max(1, at_once):
                    running[pool.submit(inheritable_thread_target(spark)(work), name)] = name
            if running:
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    outcomes[running.pop(done)] = done.result()
            elif len(outcomes) == known:
                raise ValueError(f"steps need each other: {', '.join(n for n in steps if n not in outcomes)}")
    return {name: outcomes[name] for name in steps}
