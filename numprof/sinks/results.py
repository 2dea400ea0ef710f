"""JSON result sink.

All results live below one root, in folders ``engine=…/run_id=…/job=…``.  A
write only ever replaces its own run: it overwrites the partitions of its
engine and ``run_id``, so a retried run is idempotent and no other run's
results are touched.  ``job_id`` stays in the rows; ``job`` is ``all`` for a
batch (one file per job would mean millions of small files at scale) and one
folder per job with ``per_job_files=True``.  Both kinds share the layout, so
they may share a root.  A finished write appends a commit record
(:mod:`numprof.sinks.runs`); the reader opens committed runs that no
compaction has retired, and keeps the newest record of each job and engine.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from numprof.functions.fixed import ENGINES
from numprof.sinks.runs import commit_run, run_path

ALL_JOBS = "all"


def new_run_id() -> str:
    """A run id of its own; pass a fixed one to make a run retry-stable."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def job_folder(job_id: Column) -> Column:
    """Value of the ``job`` partition: URL-encoded, so distinct ids (also the
    empty and the NULL one) have distinct folders."""
    coded = F.replace(F.url_encode(job_id.cast("string")), F.lit("*"), F.lit("%2A"))
    return F.coalesce(F.concat(F.lit("id-"), coded), F.lit("null"))


def job_path(root: str, engine: str, run_id: str, job_id: Column | None = None) -> Column:
    """Folder of a run's results, or of one job's, as it is named on disk."""
    base = run_path(root, engine, run_id)
    if job_id is None:
        return F.lit(f"{base}/job={ALL_JOBS}")
    # The writer escapes the one special character that is left.
    return F.concat(F.lit(base + "/job="), F.replace(job_folder(job_id), F.lit("%"), F.lit("%25")))


def write_results(df: DataFrame, root: str, engine: str, per_job_files: bool = False, run_id: str | None = None) -> str:
    """Write result rows of one engine as JSON below ``root`` and commit the
    run (an action).

    Returns the run id, a fresh one unless given; writing again with the same
    id replaces what that run wrote.  Rows are counted while they are written.
    """
    if engine not in ENGINES:
        raise ValueError(f"engine must be one of {ENGINES}")
    run_id = run_id or new_run_id()
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError("run_id may hold letters, digits, '.', '_' and '-' only")
    out = df.withColumns({"written_at": F.lit(time.time_ns() // 1000).cast("long"), "engine": F.lit(engine), "run_id": F.lit(run_id),
                          "job": job_folder(F.col("job_id")) if per_job_files else F.lit(ALL_JOBS)})
    rows = Observation()
    (out.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("engine", "run_id", "job")
        .json(root))
    commit_run(df.sparkSession, root, engine, run_id, rows.get["n"])
    return run_id


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """Write one string column as plain text lines (an action)."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
