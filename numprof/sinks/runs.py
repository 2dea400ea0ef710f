"""Commit records of stored runs.

Every finished write appends one record below ``<root>/_commits``: the run, its
engine, how many rows it holds and which runs it retires.  A run is live from
its newest record on, until a later record of its engine retires it.  A record
is one small file that appears by a rename, so a run becomes readable, and the
runs it replaces go, in one step; a write that failed leaves nothing to read.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMITS = "_commits"
COMMIT_SCHEMA = "engine string, run_id string, records bigint, committed_at bigint, retires array<string>"


def run_path(root: str, engine: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/engine={engine}/run_id={run_id}"


def commit_run(spark: SparkSession, root: str, engine: str, run_id: str, records: int, retires: list[str] = ()) -> None:
    """Append the record that makes a run live and retires others (an action)."""
    row = (engine, run_id, records, time.time_ns() // 1000, list(retires))
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/{COMMITS}")


def commits(spark: SparkSession, root: str) -> DataFrame | None:
    """All commit records with the file each stands in; None without a log."""
    try:
        log = spark.read.schema(COMMIT_SCHEMA).json(f"{root.rstrip('/')}/{COMMITS}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.select("*", F.col("_metadata.file_path").alias("file"))


def run_states(log: DataFrame) -> DataFrame:
    """One row per run: its newest record and whether it is ``live``."""
    newest = Window.partitionBy("engine", "run_id").orderBy(F.desc("committed_at"), F.desc("file"))
    runs = log.withColumn("__copy", F.row_number().over(newest)).filter("__copy = 1").drop("__copy")
    gone = log.select("engine", F.explode("retires").alias("run_id"), "committed_at").groupBy("engine", "run_id").agg(F.max("committed_at").alias("retired_at"))
    joined = runs.join(gone, ["engine", "run_id"], "left")
    return joined.withColumn("live", F.coalesce(F.col("retired_at") < F.col("committed_at"), F.lit(True)))


def live_runs(spark: SparkSession, root: str, engines=None) -> list[tuple[str, str, int]] | None:
    """(engine, run id, rows) of the live runs: one entry per run that was
    committed since the last compaction.  None if the root keeps no log."""
    log = commits(spark, root)
    if log is None:
        return None
    live = run_states(log).filter("live")
    if engines:
        live = live.filter(F.col("engine").isin(list(engines)))
    return sorted((r["engine"], r["run_id"], r["records"]) for r in live.select("engine", "run_id", "records").collect())
