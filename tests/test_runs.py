"""Commit records, compaction and vacuum of stored runs."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

import numprof as nprof
from numprof.sinks import compaction
from numprof.sinks.runs import commit_run, live_runs, run_path
from numprof.sources.files import read_results


def rows(spark, *jobs):
    return spark.createDataFrame(list(jobs), "job_id string, processing_time_ms bigint, record_count bigint")


def times(df):
    return {r["job_id"]: r["processing_time_ms"] for r in df.collect()}


def many_runs(root, n):
    """n runs that each rewrite job a and add a job of their own, as their writes leave them."""
    os.makedirs(f"{root}/_commits")
    with open(f"{root}/_commits/part-00000.json", "w") as log:
        for k in range(n):
            run = f"run-{k:04d}"
            os.makedirs(f"{run_path(root, 'spark_rdd', run)}/job=all")
            with open(f"{run_path(root, 'spark_rdd', run)}/job=all/part-0.json", "w") as f:
                for job in ("a", f"own-{k}"):
                    f.write(json.dumps({"job_id": job, "processing_time_ms": k, "record_count": 1, "written_at": k, "category_stats": {"low": {"count": k, "average": 0.5}}}) + "\n")
            log.write(json.dumps({"engine": "spark_rdd", "run_id": run, "records": 2, "committed_at": k, "retires": []}) + "\n")


def test_a_thousand_runs_are_read_through_one(spark, tmp_path):
    root = str(tmp_path / "results")
    many_runs(root, 1000)
    before = read_results(spark, root)
    assert len(before.inputFiles()) == 1000
    want = sorted(map(str, before.collect()))
    assert len(want) == 1001 and times(before)["a"] == 999
    new = nprof.compact_results(spark, root)
    assert live_runs(spark, root) == [("spark_rdd", new["spark_rdd"], 1001)]
    after = read_results(spark, root)
    # Nothing below the old runs is listed or opened any more.
    assert after.inputFiles() and all(f"run_id={new['spark_rdd']}" in f for f in after.inputFiles())
    assert sorted(map(str, after.collect())) == want
    assert nprof.compact_results(spark, root) == {}
    assert nprof.vacuum_results(spark, root, older_than_s=3600) == 0
    time.sleep(1.1)  # folder times are whole seconds on some stores
    assert nprof.vacuum_results(spark, root, older_than_s=0) == 1000
    assert os.listdir(f"{root}/engine=spark_rdd") == [f"run_id={new['spark_rdd']}"]
    assert sorted(map(str, read_results(spark, root).collect())) == want


def test_uncommitted_run_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    nprof.write_results(rows(spark, ("a", 1, 1)), root, "spark_rdd", run_id="good")
    # A write that died before its commit.
    rows(spark, ("a", 99, 1)).withColumn("written_at", F.lit(1 << 60)).write.json(f"{run_path(root, 'spark_rdd', 'dead')}/job=all")
    assert times(read_results(spark, root)) == {"a": 1}


def test_retried_run_lives_again_after_compaction(spark, tmp_path):
    root = str(tmp_path)
    for run, t in (("one", 1), ("two", 2)):
        nprof.write_results(rows(spark, (run, t, 1)), root, "spark_rdd", run_id=run)
    nprof.compact_results(spark, root)
    nprof.write_results(rows(spark, ("one", 7, 1)), root, "spark_rdd", run_id="one")
    assert times(read_results(spark, root)) == {"one": 7, "two": 2}
    assert len(live_runs(spark, root)) == 2
    nprof.compact_results(spark, root)
    assert times(read_results(spark, root)) == {"one": 7, "two": 2} and len(live_runs(spark, root)) == 1


def test_failed_compaction_leaves_the_old_runs(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for run, t in (("one", 1), ("two", 2)):
        nprof.write_results(rows(spark, (run, t, 1)), root, "spark_rdd", run_id=run)

    def fail(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "commit_run", fail)
    with pytest.raises(RuntimeError):
        nprof.compact_results(spark, root)
    monkeypatch.undo()
    assert [r for _, r, _ in live_runs(spark, root)] == ["one", "two"] and times(read_results(spark, root)) == {"one": 1, "two": 2}
    time.sleep(1.1)
    assert nprof.vacuum_results(spark, root, older_than_s=0) == 1  # what the failed one wrote
    assert times(read_results(spark, root)) == {"one": 1, "two": 2}


def test_compaction_keeps_all_kinds_of_records(spark, tmp_path):
    root = str(tmp_path)
    vals = spark.createDataFrame([(k, float(v)) for k in ("x", "y") for v in (1, 2, 30, None or 4)], "k string, value double")
    for part in ("x", "y"):
        some = vals.filter(F.col("k") == part)
        nprof.write_results(nprof.job_results(some, job_col="k"), root, "spark_dataframe")
        nprof.write_results(nprof.job_results(some, job_col="k", kind="rdd"), root, "spark_rdd")
        arrays = spark.createDataFrame([(part, [1.0, None, float("nan")]), (None, [])], "job_id string, result array<double>")
        nprof.write_results(arrays, root, "gpu_processed")
    before = sorted(map(str, read_results(spark, root).collect()))
    assert sorted(nprof.compact_results(spark, root)) == ["gpu_processed", "spark_dataframe", "spark_rdd"]
    assert sorted(map(str, read_results(spark, root).collect())) == before
    # Band statistics stay a list or map of their own, not a text.
    line = spark.read.text(run_path(root, "spark_rdd", [r for e, r, _ in live_runs(spark, root) if e == "spark_rdd"][0])).first()[0]
    assert isinstance(json.loads(line)["category_stats"], dict)


def test_empty_runs_and_roots(spark, tmp_path):
    root = str(tmp_path)
    nprof.write_results(rows(spark), root, "spark_rdd", run_id="none")
    assert live_runs(spark, root) == [("spark_rdd", "none", 0)] and read_results(spark, root).count() == 0
    nprof.write_results(rows(spark), root, "spark_rdd", run_id="none2")
    nprof.compact_results(spark, root)
    assert read_results(spark, root).count() == 0
    assert nprof.vacuum_results(spark, str(tmp_path / "nothing")) == 0
    with pytest.raises(ValueError):
        nprof.compact_results(spark, str(tmp_path / "nothing"))


def test_engines_open_their_own_runs(spark, tmp_path):
    root = str(tmp_path)
    for engine in ("spark_rdd", "spark_dataframe"):
        nprof.write_results(rows(spark, ("a", 1, 1)), root, engine)
    assert all("engine=spark_rdd" in f for f in read_results(spark, root, engines=["spark_rdd"]).inputFiles())
    commit_run(spark, root, "spark_rdd", "gone", 0, [])
    assert read_results(spark, root).count() == 2
