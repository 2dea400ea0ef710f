"""Compaction of stored results: one run per engine instead of many.

``compact_results`` writes the newest record of every job as one new run and
commits it with the list of runs it read, so readers see either all old runs or
the new one.  ``vacuum_results`` then deletes what no reader can open any more.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprof.functions.fixed import ENGINES
from numprof.sinks.results import ALL_JOBS, new_run_id
from numprof.sinks.runs import commit_run, commits, live_runs, run_path, run_states
from numprof.sources.files import newest_records, stored_records


def _as_lines(df: DataFrame, engine: str, run_id: str) -> DataFrame:
    """Records as the JSON lines they were read from; the band statistics, a
    list or a map, go back as the text they are."""
    plain = [c for c in df.columns if c not in ("engine", "run_id", "job", "category_stats")]
    head = F.to_json(F.struct(*plain))
    body = F.expr("substring(line, 1, length(line) - 1)")
    stats = F.concat(F.when(F.col("line") == "{}", "").otherwise(","), F.lit('"category_stats":'), "category_stats")
    lines = df.select(head.alias("line"), "category_stats")
    return lines.select(F.concat(body, F.coalesce(stats, F.lit("")), F.lit("}")).alias("value"), F.lit(engine).alias("engine"),
                        F.lit(run_id).alias("run_id"), F.lit(ALL_JOBS).alias("job"))


def compact_results(spark: SparkSession, root: str, engines=None) -> dict[str, str]:
    """Write the current results of each engine as one run and retire the runs
    they came from (an action); returns the new run per engine.

    An engine with one live run, or none, is left alone.  Records keep the
    time they were written at, so a run committed meanwhile stays live and its
    newer records win.  A compaction that fails leaves the old runs live.
    """
    runs = live_runs(spark, root, engines or ENGINES)
    if runs is None:
        raise ValueError(f"{root} keeps no commit log")
    done = {}
    for engine in sorted({e for e, _, _ in runs}):
        old = [(run, n) for e, run, n in runs if e == engine]
        if len(old) < 2:
            continue
        run_id = f"compact-{new_run_id()}"
        current = newest_records(stored_records(spark, root, [(engine, run, n) for run, n in old]))
        _as_lines(current, engine, run_id).write.mode("append").partitionBy("engine", "run_id", "job").text(root)
        written = spark.read.text(run_path(root, engine, run_id)).count() if any(n for _, n in old) else 0
        commit_run(spark, root, engine, run_id, written, [run for run, _ in old])
        done[engine] = run_id
    return done


def vacuum_results(spark: SparkSession, root: str, older_than_s: float = 7 * 24 * 3600) -> int:
    """Delete the folders and commit records of runs that were retired at
    least so many seconds ago, and folders of their age that were never
    committed (an action); returns how many folders went.

    Readers that listed the runs before they were retired must have ended by
    then.  A folder goes before its record, so an interrupted call can be
    repeated.
    """
    log = commits(spark, root)
    if log is None:
        return 0
    before = int((time.time() - older_than_s) * 1e6)
    states = run_states(log)
    retired = states.filter(~F.col("live") & (F.col("retired_at") <= before)).select("engine", "run_id").collect()
    known = {(r["engine"], r["run_id"]) for r in states.select("engine", "run_id").collect()}
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0

    def delete(path: str) -> None:
        nonlocal gone
        gone += bool(fs.delete(path_of(path), True))

    for engine in ENGINES:
        top = path_of(f"{root.rstrip('/')}/engine={engine}")
        for s in fs.listStatus(top) if fs.exists(top) else []:
            run = s.getPath().getName().removeprefix("run_id=")
            if (engine, run) not in known and s.getModificationTime() * 1000 <= before:
                delete(run_path(root, engine, run))
    for r in retired:
        delete(run_path(root, r["engine"], r["run_id"]))
    if retired:
        # A run's retiring record stays until that run is retired itself.
        names = spark.createDataFrame(retired, "engine string, run_id string")
        for r in log.join(names, ["engine", "run_id"], "left_semi").select("file").distinct().collect():
            fs.delete(path_of(r["file"]), False)
    return gone
