"""Running named stages in order: dry runs, missing inputs, stop on failure, and skipping what is already done."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Stage:
    """run() makes the outputs from the inputs; settings are what else they depend on."""

    name: str
    run: Callable[[], None]
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    settings: dict = field(default_factory=dict)
    required: bool = True


def exists(spark: SparkSession, path: str) -> bool:
    """Asked through Spark's file system, whatever the store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def fingerprint(stage: Stage) -> str:
    """SHA-256 of the stage's name, files and settings as canonical JSON."""
    told = {"name": stage.name, "inputs": list(stage.inputs), "outputs": list(stage.outputs), "settings": stage.settings}
    return hashlib.sha256(json.dumps(told, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def execute(stages: Iterable[Stage], there: Callable[[str], bool], done: dict[str, str] | None = None, dry: bool = False) -> list[tuple[str, str, str, float, str]]:
    """(name, status, fingerprint, seconds, detail) of each stage, in order.

    skipped: done has the same fingerprint and the outputs are there. missing_input: an input is
    neither there nor made by an earlier stage that ran. planned: a dry run would run it. ok,
    failed: it ran. After a required stage failed or lacked an input the others are not_run.
    """
    log, made, stopped = [], set(), False
    for s in stages:
        key, begin, detail = fingerprint(s), time.time(), ""
        missing = [p for p in s.inputs if p not in made and not there(p)]
        if stopped:
            status = "not_run"
        elif (done or {}).get(s.name) == key and all(map(there, s.outputs)):
            status = "skipped"
        elif missing:
            status, detail = "missing_input", ",".join(missing)
        elif dry:
            status = "planned"
        else:
            try:
                s.run()
                status = "ok"
            except Exception as e:  # noqa: BLE001  a stage's failure is a row of the log
                status, detail = "failed", f"{type(e).__name__}: {e}"
        if status in ("ok", "planned", "skipped"):
            made.update(s.outputs)
        stopped = stopped or (s.required and status in ("failed", "missing_input"))
        log.append((s.name, status, key, round(time.time() - begin, 3), detail))
    return log


def job_log(spark: SparkSession, log: list[tuple]) -> DataFrame:
    return spark.createDataFrame(log, "stage string, status string, fingerprint string, seconds double, detail string")


def until_settled(cost: Callable[[], float], step: Callable[[], None], most: int, least_gain: float = 1e-6) -> tuple[int, float]:
    """Steps until the cost no longer falls by least_gain, at most so many: the number of steps and the last cost."""
    last = cost()
    for n in range(1, most + 1):
        step()
        now = cost()
        if now >= last - least_gain:
            return n, now
        last = now
    return most, last
