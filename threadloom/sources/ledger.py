"""The run ledger: a row per job with counts taken while it writes; run histories and batch reports of earlier layouts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.posts import latest_per_key
from threadloom.sources.leaves import read_runs

LEDGER = "run_id string, job string, success boolean, error string, started_at timestamp, seconds double, counts map<string,long>"
REPORT = "episode_dir string, episode_title string, success boolean, error string, transcribed_at string, processing_time_seconds double, segment_count long, word_count long, speakers_detected int"
BATCH = "failures array<struct<episode_dir:string>>, gaps array<struct<episode_dir:string,has_audio:boolean>>"


def logged(df: DataFrame, job: str, write: Callable[[DataFrame], None], ledger: str, counts: dict[str, Column]) -> str:
    """Run write(df) and append a row to the ledger; the result is the run's id.

    The counts (aggregates of long type) are observed by the tasks that write, so nothing is read twice; a task that runs again counts
    once. A failed run gets a row too, without counts, and its error is raised.
    """
    run_id, began, started = uuid.uuid4().hex, time.time(), datetime.now(timezone.utc)
    seen, error = Observation(run_id), None
    try:
        write(df.observe(seen, *[c.cast("long").alias(k) for k, c in counts.items()]))
    except Exception as e:
        error = f"{type(e).__name__}: {e}"[:2000]
        raise
    finally:
        found = {} if error else {k: v or 0 for k, v in seen.get.items()}
        row = (run_id, job, error is None, error, started, round(time.time() - began, 2), found)
        df.sparkSession.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return run_id


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def canonical(runs: DataFrame) -> DataFrame:
    """The last run of each job that succeeded."""
    return latest_per_key(runs.filter("success"), ["job"], F.desc("started_at"), F.desc("run_id"))


def read_run_history(spark: SparkSession, root: str) -> DataFrame:
    """Successful runs below root with episode_id and run_id, both from the path of their reports.

    Reports lie in <episode>/transcript/runs/<run>/; those of the legacy layout, in <episode>/transcript/, count as run 'legacy' for
    episodes without a versioned run that succeeded. Broken reports are passed over. One scan reads both layouts.
    """
    path = r"([^/]+)/transcript/(?:runs/([^/]+)/)?extraction_report\.json$"
    rows = spark.read.schema(REPORT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "extraction_report.json").json(root).select("*", F.url_decode("_metadata.file_path").alias("_path"))
    named = rows.withColumns({"episode_id": F.regexp_extract("_path", path, 1), "run_id": F.regexp_extract("_path", path, 2)}).filter("success and episode_id <> ''").drop("_path")
    return read_runs(named.filter("run_id <> ''"), named.filter("run_id = ''").drop("run_id"))


def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, episode_dir) of the last batch report of a folder, by name: its 'failure's, and its 'gap's that have audio."""
    rows = spark.read.schema(BATCH).option("multiLine", True).option("pathGlobFilter", "batch_*.json").json(folder).select("failures", "gaps", F.col("_metadata.file_name").alias("name"))
    last = rows.agg(F.max_by(F.struct("failures", "gaps"), "name").alias("r"))
    part = lambda kind, items: last.select(F.lit(kind).alias("kind"), F.explode(items).alias("i")).select("kind", "i.episode_dir")
    return part("failure", F.col("r.failures")).unionByName(part("gap", F.filter("r.gaps", lambda g: g["has_audio"])))
