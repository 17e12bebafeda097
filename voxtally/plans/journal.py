"""The steps that ran on a folder, as a table: one row for every attempt, appended and never changed.

What was tried last, what succeeded last and whether a step's outputs are still
current are queries over this table. ``export`` writes their answer as the JSON
summary that people and scripts read. Capturing log lines is separate.
"""

from __future__ import annotations

import contextlib
import json
import logging
import os
import time
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File and key names that readers of the summary know.
TABLE, SUMMARY, LOGS = "runs.parquet", "manifest.json", "logs"
SUMMARY_KEYS = {"good": "stages", "tried": "last_attempt"}
ROW = (
    "step string, run string, began double, seconds double, outcome string, error string, made_from string, "
    "inputs map<string,string>, results map<string,string>"
)


def attempts(spark: SparkSession, folder) -> DataFrame:
    """All attempts, oldest first in ``began``; an untouched folder has none."""
    path = os.path.join(folder, TABLE)
    return spark.read.schema(ROW).parquet(path) if os.path.isdir(path) else spark.createDataFrame([], ROW)


def latest(rows: DataFrame, good: bool = False) -> DataFrame:
    """The last attempt, or the last one that succeeded, of every step."""
    rows = rows.filter("outcome = 'done'") if good else rows
    newest = F.max_by(F.struct(*rows.columns), F.struct("began", "run")).alias("row")
    return rows.groupBy("step").agg(newest).select("row.*")


def is_current(spark: SparkSession, folder, step: str, made_from: str, outputs: list[str]) -> bool:
    """Whether the outputs are there and the last good attempt made them from the same things."""
    if not all(map(os.path.exists, outputs)):
        return False
    return not latest(attempts(spark, folder), good=True).filter((F.col("step") == step) & (F.col("made_from") == made_from)).isEmpty()


def cells_digest(cells: DataFrame) -> str:
    """Digest of the content, the same for the same rows in any files or order."""
    row_hash = F.xxhash64(*sorted(cells.columns)).cast("decimal(38,0)")
    return ":".join(map(str, cells.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_hash), F.lit(0))).first()))


def export(spark: SparkSession, folder) -> dict:
    """Write the summary of a folder from its table, whole or not at all."""
    rows = attempts(spark, folder)
    found = {key: {r.step: r.asDict() for r in latest(rows, kind == "good").collect()} for kind, key in SUMMARY_KEYS.items()}
    target = Path(folder) / SUMMARY
    part = target.with_suffix(f".{uuid.uuid4().hex[:8]}")
    part.write_text(json.dumps(found, indent=1, sort_keys=True))
    part.replace(target)
    return found


@contextlib.contextmanager
def log_lines(path: Path, level: int = logging.INFO) -> Iterator[None]:
    """Also write this package's log lines to a file while the context is open."""
    path.parent.mkdir(parents=True, exist_ok=True)
    own = logging.getLogger("voxtally")
    before, sink = own.level, logging.FileHandler(path, encoding="utf-8")
    sink.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    own.addHandler(sink)
    own.setLevel(min(level, before or level))
    try:
        yield
    finally:
        own.removeHandler(sink)
        own.setLevel(before)
        sink.close()


@contextlib.contextmanager
def attempt(spark: SparkSession, folder, step: str, inputs: dict | None = None, made_from: str = "") -> Iterator[dict]:
    """Run the body as one attempt: put results into the yielded mapping; an error is recorded and goes on."""
    run, began, results = uuid.uuid4().hex[:8], time.time(), {}
    outcome, error = "failed", None
    os.makedirs(folder, exist_ok=True)
    with log_lines(Path(folder) / LOGS / f"{step}-{time.strftime('%Y%m%dT%H%M%S', time.gmtime(began))}-{run}.log"):
        try:
            yield results
            outcome = "done"
        except BaseException as problem:
            error = f"{type(problem).__name__}: {problem}"
            logging.getLogger(__name__).error("%s failed: %s", step, error)
            raise
        finally:
            words = [{k: v if isinstance(v, str) else json.dumps(v, default=str) for k, v in (m or {}).items()} for m in (inputs, results)]
            row = (step, run, began, time.time() - began, outcome, error, made_from, *words)
            spark.createDataFrame([row], ROW).coalesce(1).write.mode("append").parquet(os.path.join(folder, TABLE))
