"""End-to-end jobs: read → compute → write, with wall-clock timing.

These are the only functions that run actions.  Each is idempotent: the
result is materialised in the shared checkpoint folder, then written below
its own run id, so a retried run (same ``run_id``) replaces its own output
and no other.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprof.operators.jobs import analyze_jobs
from numprof.operators.results import array_results, job_results, receipts
from numprof.plans.stats_join import materialize
from numprof.sinks.results import new_run_id, write_results
from numprof.sources.files import read_numeric_csv, read_numeric_text, read_requests, read_results


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` cached for the block and release it afterwards.

    Worth it for text/CSV input that is parsed twice (statistics, then
    z-scores); for Parquet a second scan of one pruned column is usually
    cheaper than caching the whole input.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def run_profile_job(spark: SparkSession, input_path: str, job_id: str, kind: str = "dataframe",
                    output_root: str | None = None, job_col: str | None = None,
                    cache_input: bool = False, run_id: str | None = None) -> DataFrame:
    """Profile numeric input and time it (``processing_time_ms``).

    ``kind="dataframe"`` reads headerless CSV (bad fields → NULL rows);
    ``kind="rdd"`` reads text lines (bad lines dropped).  With
    ``output_root`` the record is written below it, one folder per job.
    """
    start = time.monotonic()
    if kind == "dataframe":
        rows = read_numeric_csv(spark, input_path)
    else:
        rows = read_numeric_text(spark, input_path, on_malformed="drop")
    if cache_input:
        with persisted(rows) as cached:
            rec = materialize(job_results(cached, "value", job_col=job_col, job_id=job_id, kind=kind))
    else:
        rec = materialize(job_results(rows, "value", job_col=job_col, job_id=job_id, kind=kind))
    elapsed_ms = int((time.monotonic() - start) * 1000)
    out = rec.withColumn("processing_time_ms", F.lit(elapsed_ms).cast("long"))
    if output_root:
        engine = "spark_dataframe" if kind == "dataframe" else "spark_rdd"
        write_results(out, output_root, engine, per_job_files=job_col is None, run_id=run_id)
    return out


def run_array_job(spark: SparkSession, requests_path: str, output_root: str | None = None,
                  per_job_files: bool = False, run_id: str | None = None) -> DataFrame:
    """Standardise every request's array; write the array results and
    return one receipt per request."""
    requests = read_requests(spark, requests_path)
    run_id = run_id or new_run_id()
    if output_root:
        write_results(array_results(requests), output_root, "gpu_processed", per_job_files, run_id)
    return receipts(requests, output_root or "", per_job_files, run_id)


def run_analysis(spark: SparkSession, results_root: str, job_ids: DataFrame | None = None) -> DataFrame:
    """Analyse every stored job (or exactly ``job_ids``) in one pass; a root
    without results yet gives no job, or missing results for ``job_ids``."""
    return analyze_jobs(read_results(spark, results_root, missing_ok=True), job_ids)
