"""Job analytics details and source/sink behaviour."""

from pyspark.sql import functions as F

import pytest
from pyspark.errors import AnalysisException

from numprof.operators.jobs import analyze_flat, chart_series, results_long, speedup_report
from numprof.operators.results import job_results
from numprof.sinks.results import write_results
from numprof.sources.files import read_results, uniform_values


def _flat(spark, pairs):
    rdd = spark.createDataFrame([(j, r, 1) for j, r, _ in pairs],
                                "job_id string, processing_time_ms long, record_count long")
    df = spark.createDataFrame([(j, d) for j, _, d in pairs], "job_id string, processing_time_ms long")
    return analyze_flat(results_long(rdd=rdd, df=df))


def test_speedup_report_truncates_exactly(spark):
    rep = {r["job_id"]: r for r in speedup_report(_flat(spark, [
        ("a", 129, 100), ("b", 100, 300), ("c", 100, 100), ("d", 0, 0), ("e", 2, 3)])).collect()}
    assert rep["a"]["ratio_text"] == "1.29" and rep["a"]["winner"] == "DataFrame"
    assert rep["a"]["message"] == "DataFrame is 1.29x faster than RDD"
    assert rep["b"]["ratio_text"] == "3.00" and rep["b"]["message"] == "RDD is 3.00x faster than DataFrame"
    assert rep["c"]["ratio_text"] == "1.00" and rep["c"]["winner"] == "RDD"
    assert rep["d"]["ratio"] is None and rep["d"]["message"] is None
    assert rep["e"]["ratio_text"] == "1.50"


def test_chart_series_rows(spark):
    rows = chart_series(_flat(spark, [("job-with-a-long-id", 2000, 1000), ("z", 0, 0)])).collect()
    by = {(r["job_id"], r["chart"], r["position"]): r for r in rows}
    t1 = by[("job-with-a-long-id", "time_comparison", 1)]
    t2 = by[("job-with-a-long-id", "time_comparison", 2)]
    assert t1["job_label"] == "job-with"
    assert (t1["label"], t1["caption"], t1["is_winner"]) == ("RDD", "2,000ms", False)
    assert (t2["label"], t2["caption"], t2["is_winner"]) == ("DataFrame", "1,000ms", True)
    s2 = by[("job-with-a-long-id", "speedup", 2)]
    assert (s2["label"], s2["value"], s2["caption"]) == ("DataFrame", 2.0, "2.00x")
    # both times zero: speedup 0, so only the time chart is drawn
    assert {k[1] for k in by if k[0] == "z"} == {"time_comparison"}


def test_uniform_values_range_count_and_determinism(spark):
    rows = spark.range(5000, numPartitions=4)
    a = uniform_values(rows, seed=7)
    st = a.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()[0]
    assert st["n"] == 5000 and -100 <= st["lo"] and st["hi"] < 100
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in uniform_values(rows, seed=7).collect())


def test_results_reader_prunes_engine_partitions(spark, tmp_path):
    root = str(tmp_path / "res")
    vals = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, value double")
    write_results(job_results(vals, job_col="k"), root, "spark_dataframe")
    write_results(job_results(vals, job_col="k", kind="rdd"), root, "spark_rdd")
    # rewriting one engine leaves the other engine's results in place
    write_results(job_results(vals, job_col="k", kind="rdd"), root, "spark_rdd")
    both = read_results(spark, root)
    assert sorted((r["engine"], r["job_id"]) for r in both.collect()) == [
        ("spark_dataframe", "a"), ("spark_dataframe", "b"), ("spark_rdd", "a"), ("spark_rdd", "b")]
    only = read_results(spark, root, engines=["spark_rdd"])
    assert only.inputFiles() and all("engine=spark_rdd" in f for f in only.inputFiles())
    got = {r["job_id"]: r for r in only.collect()}
    assert got["a"]["category_map"]["medium"]["count"] == 2 and got["a"]["category_list"] is None


def test_nested_results_collapse_repeated_copies(spark):
    from numprof.operators.jobs import nested_results
    row = ("hot", "spark_rdd", 10, 5, 1.0, 2.0, 0.0, None, "RDD", None)
    other = ("cold", "spark_dataframe", 7, 3, 1.0, 2.0, 0.0, 0.5, "DataFrame", None)
    schema = ("job_id string, engine string, processing_time_ms long, record_count long, avg_value double, "
              "max_value double, min_value double, std_dev double, processing_type string, result array<double>")
    res = spark.createDataFrame([row] * 500 + [other], schema)
    got = {r["job_id"]: r["results"] for r in nested_results(res).collect()}
    assert got["hot"]["spark_rdd"]["processing_time_ms"] == 10 and got["hot"]["spark_dataframe"] is None
    assert got["cold"]["spark_dataframe"]["processing_type"] == "DataFrame"
    plan = nested_results(res)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_max" in plan and "SortAggregate" not in plan


def test_analysis_over_an_empty_results_root(spark, tmp_path):
    from numprof.operators.jobs import analyze_flat
    with pytest.raises(AnalysisException):
        read_results(spark, str(tmp_path / "nothing-here"))
    res = read_results(spark, str(tmp_path / "nothing-here"), missing_ok=True)
    assert res.count() == 0
    ids = spark.createDataFrame([("j1",)], "job_id string")
    r = analyze_flat(res, ids).collect()[0]
    assert r["gpu_status"] == "failed" and r["error"] == "Missing results for comparison"


def test_every_batch_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "res")
    schema = "job_id string, processing_time_ms long, record_count long"

    def rows(*r):
        return spark.createDataFrame(list(r), schema)
    write_results(rows(("j1", 1, 10), ("", 2, 20), (None, 3, 30)), root, "spark_rdd", per_job_files=True)
    write_results(rows(("j2", 4, 40), ("a/b c*", 5, 50)), root, "spark_rdd")
    run = write_results(rows(("j3", 6, 60)), root, "spark_rdd")
    write_results(rows(("j3", 7, 70)), root, "spark_rdd", run_id=run)          # a retry replaces its own run
    write_results(rows(("j1", 90, 7), ("a/b c*", None, 1)), root, "spark_rdd", per_job_files=True)  # newest whole record wins
    got = {r["job_id"]: (r["processing_time_ms"], r["record_count"]) for r in read_results(spark, root).collect()}
    assert got == {"j1": (90, 7), "": (2, 20), None: (3, 30), "j2": (4, 40), "a/b c*": (None, 1), "j3": (7, 70)}
    with pytest.raises(ValueError):
        write_results(rows(("j", 1, 1)), root, "spark_rdd", run_id="a/b")


def test_storage_path_is_the_folder_on_disk(spark, tmp_path):
    import json
    import os
    from numprof.plans.jobs import run_array_job
    src = tmp_path / "req.json"
    src.write_text("\n".join(json.dumps({"job_id": j, "data": [1.0, 2.0]}) for j in ("a/b", "x y", "50%", "é*=", "")) + "\n")
    for r in run_array_job(spark, str(src), str(tmp_path / "res"), per_job_files=True).collect():
        assert os.path.isdir(r["storage_path"]), r["storage_path"]


def test_unusable_payload_is_a_processing_error(spark, tmp_path):
    from numprof.operators.results import receipts
    from numprof.sources.files import read_requests
    src = tmp_path / "req.json"
    src.write_text("""{"job_id":"a","data":[1,"abc",3]}
{"job_id":"b","data":"oops"}
{"job_id":"c"}
{"job_id":"d","data":null}
{"job_id":"e","data":[1,null,3.5e2]}
{"job_id":"f","data":[[1],[2]]}
{"job_id":"g","data":{"x":1}}
{"job_id":"h","data":[]}
""")
    df = receipts(read_requests(spark, str(src)), "out")
    got = {r["job_id"]: (r["status"], r["http_status"], r["processed_count"]) for r in df.collect()}
    assert got == {"a": ("error", 500, None), "b": ("error", 500, None), "c": ("error", 400, None), "d": ("error", 500, None),
                   "e": ("success", 200, 3), "f": ("error", 500, None), "g": ("error", 500, None), "h": ("success", 200, 0)}
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_null_time_copies_and_null_elements(spark):
    from numprof.operators.arrays import standardize_arrays, standardize_arrays_long
    from numprof.operators.jobs import analyze_flat, results_long, speedup_report
    rdd = spark.createDataFrame([("a", 100, 1), ("c", 90, 7), ("c", 10, 5_000_000)], "job_id string, processing_time_ms long, record_count long")
    df = spark.createDataFrame([("a", None), ("c", 5)], "job_id string, processing_time_ms long")
    gpu = spark.createDataFrame([("a", None)], "job_id string, result array<double>")
    flat = analyze_flat(results_long(rdd=rdd, df=df, gpu=gpu))
    assert [r["job_id"] for r in speedup_report(flat).collect()] == ["c"]
    got = {r["job_id"]: r for r in flat.collect()}
    assert (got["c"]["rdd_time_ms"], got["c"]["rdd_record_count"]) == (90, 7)     # one whole copy, not a blend
    assert got["a"]["gpu_processed_count"] == 0 and got["a"]["gpu_status"] == "completed"
    arr = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, None), (3, [None])], "id int, data array<double>")
    wide = {r["id"]: r["result"] for r in standardize_arrays(arr).collect()}
    assert wide == {1: [-1.0, None, 1.0], 2: None, 3: [None]}
    assert [r["normalized_value"] for r in standardize_arrays_long(arr.filter("id = 1"), ["id"]).orderBy("pos").collect()] == [-1.0, None, 1.0]


def test_all_null_job_keeps_its_record(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", 3.0)], "k string, value double")
    for kind in ("rdd", "dataframe"):
        got = {r["job_id"]: (r["record_count"], len(r["category_stats"])) for r in job_results(df, job_col="k", kind=kind).collect()}
        assert got["a"][0] == 0 and got["b"][0] == 2 and (kind != "rdd" or got["a"][1] == 0)
