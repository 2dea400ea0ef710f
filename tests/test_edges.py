"""Edge rows of FIXTURES.md, one test each."""

import math

from pyspark.sql import functions as F

from support import lines_file, values_df
from numprof.functions.columns import band
from numprof.operators.categories import category_stats
from numprof.operators.jobs import analyze_flat, recommendations, results_long
from numprof.operators.matrix import matmul_coo, matmul_tiled
from numprof.operators.profile import profile
from numprof.operators.results import job_results, receipts
from numprof.operators.standardize import standardize
from numprof.sinks.results import write_results
from numprof.sources.files import read_numeric_csv, read_numeric_text, read_results


def _cats(rec):
    return {r["category"]: r["count"] for r in rec.select(F.explode("category_stats").alias("c"))
            .select("c.category", "c.count").collect()}


def test_malformed_null_flavour(spark, tmp_path):
    rows = read_numeric_csv(spark, lines_file(tmp_path, ["1.0", "abc", "2.5"]))
    rec = job_results(rows, job_id="j").collect()[0]
    assert rec["record_count"] == 2
    cats = {c["category"]: c["count"] for c in rec["category_stats"]}
    assert sum(cats.values()) == 3
    std = standardize(rows).collect()
    bad = [r for r in std if r["value"] is None]
    assert len(bad) == 1 and bad[0]["category"] == "medium"


def test_malformed_drop_flavour(spark, tmp_path):
    rows = read_numeric_text(spark, lines_file(tmp_path, ["1.0", "abc", "2.5"]))
    assert sorted(r["value"] for r in rows.collect()) == [1.0, 2.5]


def test_extra_field_and_quotes(spark, tmp_path):
    path = lines_file(tmp_path, ["3.0,4.0", '"1.5"'])
    assert sorted(r["value"] for r in read_numeric_csv(spark, path).collect()) == [1.5, 3.0]
    assert read_numeric_text(spark, path).count() == 0


def test_blank_lines(spark, tmp_path):
    path = lines_file(tmp_path, ["", "   ", "2.0"])
    assert [r["value"] for r in read_numeric_csv(spark, path).collect()] == [2.0]
    assert [r["value"] for r in read_numeric_text(spark, path).collect()] == [2.0]


def test_special_spellings_drop_flavour(spark, tmp_path):
    kept = ["Infinity", "NaN", "1e400"]
    dropped = ["Inf", "infinity", "nan"]
    vals = [r["value"] for r in read_numeric_text(spark, lines_file(tmp_path, kept + dropped)).collect()]
    assert len(vals) == 3
    assert sum(math.isnan(v) for v in vals) == 1
    assert sum(v == math.inf for v in vals) == 2


def test_job_id_leading_zeros_roundtrip(spark, tmp_path):
    root = str(tmp_path / "res")
    rec = job_results(values_df(spark, [1.0, 2.0]), job_id="001")
    write_results(rec, root, "spark_dataframe", per_job_files=True)
    back = read_results(spark, root).collect()
    assert [r["job_id"] for r in back] == ["001"]
    assert back[0]["engine"] == "spark_dataframe"


def test_empty_input(spark):
    empty = values_df(spark, [])
    p = profile(empty).collect()
    assert len(p) == 1 and p[0]["record_count"] == 0 and p[0]["avg_value"] is None
    rec = job_results(empty, job_id="e").collect()
    assert len(rec) == 1 and rec[0]["record_count"] == 0 and rec[0]["std_dev"] is None
    assert rec[0]["category_stats"] == []


def test_one_row(spark):
    df = values_df(spark, [1.0])
    assert profile(df).collect()[0]["std_dev"] is None
    assert profile(df, ddof=0).collect()[0]["std_dev"] == 0.0
    for ddof in (0, 1):
        r = standardize(df, ddof=ddof).collect()[0]
        assert r["normalized_value"] is None and r["category"] == "medium"


def test_constant_column(spark):
    df = values_df(spark, [5.0, 5.0, 5.0])
    assert profile(df).collect()[0]["std_dev"] == 0.0
    rows = standardize(df).collect()
    assert all(r["normalized_value"] is None and r["category"] == "medium" for r in rows)
    rec = job_results(df, job_id="c", kind="rdd").collect()[0]
    assert rec["category_stats"]["medium"]["count"] == 3


def test_nan_input(spark):
    df = values_df(spark, [float("nan"), 1.0, 2.0])
    rows = standardize(df).collect()
    assert all(math.isnan(r["normalized_value"]) for r in rows)
    assert {r["category"] for r in rows} == {"high"}
    rows = standardize(df, ddof=0, nan_is_medium=True).collect()
    assert {r["category"] for r in rows} == {"medium"}


def test_exact_bounds(spark):
    df = values_df(spark, [1.0, -1.0, 1.0000001, -1.0000001], "z")
    got = {r["z"]: r["b"] for r in df.select("z", band("z").alias("b")).collect()}
    assert got == {1.0: "medium", -1.0: "medium", 1.0000001: "high", -1.0000001: "low"}
    stats = spark.createDataFrame([(0.0, 1.0)], "avg_value double, std_dev double")
    std = standardize(values_df(spark, [1.0, -1.0]), stats=stats).collect()
    assert {r["category"] for r in std} == {"medium"}


def test_null_job_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 10.0), (None, 30.0)], "k string, value double")
    prof = {r["k"]: r["avg_value"] for r in profile(df, keys=["k"]).collect()}
    assert prof == {"a": 2.0, None: 20.0}
    std = standardize(df, keys=["k"]).collect()
    assert len(std) == 4 and all(r["normalized_value"] is not None for r in std)
    rec = {r["job_id"]: r["record_count"] for r in job_results(df, job_col="k").collect()}
    assert rec == {"a": 2, None: 2}


def _analysis(spark, rdd_rows, df_rows):
    rdd = spark.createDataFrame(rdd_rows, "job_id string, processing_time_ms long, record_count long")
    df = spark.createDataFrame(df_rows, "job_id string, processing_time_ms long")
    return {r["job_id"]: r for r in analyze_flat(results_long(rdd=rdd, df=df)).collect()}


def test_comparison_tie(spark):
    r = _analysis(spark, [("t", 100, 5)], [("t", 100)])["t"]
    assert (r["faster_method"], r["speedup"], r["performance_improvement_pct"]) == ("RDD", 1.0, 0.0)
    assert r["recommendations"] == ["RDD API showed 0.0% better performance for this dataset"]


def test_both_times_zero(spark):
    r = _analysis(spark, [("z", 0, 5)], [("z", 0)])["z"]
    assert (r["faster_method"], r["speedup"], r["performance_improvement_pct"]) == ("RDD", 0.0, None)
    assert r["recommendations"] == []


def test_one_result_missing(spark):
    a = _analysis(spark, [("x", 1, 1)], [("m", 50)])
    r = a["m"]
    assert r["error"] == "Missing results for comparison" and r["speedup"] is None
    assert r["recommendations"] == ["Unable to generate recommendations due to missing results"]
    assert r["gpu_status"] == "failed" and r["gpu_processed_count"] == 0


def test_size_advice(spark):
    a = _analysis(spark, [("s", 100, 100000), ("l", 100, 100001)], [("s", 50), ("l", 50)])
    assert a["s"]["recommendations"] == ["Use DataFrame API for 50.0% better performance"]
    assert a["l"]["recommendations"][1:] == [
        "Consider using more partitions for large datasets",
        "Enable adaptive query execution for better resource utilization"]
    rec = recommendations(analyze_flat(results_long(
        rdd=spark.createDataFrame([("l", 100, 100001)], "job_id string, processing_time_ms long, record_count long"),
        df=spark.createDataFrame([("l", 50)], "job_id string, processing_time_ms long"))))
    assert [r["position"] for r in rec.orderBy("position").collect()] == [0, 1, 2]


def test_request_without_data(spark):
    req = spark.createDataFrame([("j1", None, None), (None, "normalize", [1.0, 3.0])],
                                "job_id string, type string, data array<double>")
    got = {r["job_id"]: r for r in receipts(req, "out", per_job_files=True).collect()}
    assert got["j1"]["error"] == "No data provided" and got["j1"]["http_status"] == 400
    ok = got["unknown"]
    assert ok["status"] == "success" and ok["processed_count"] == 2
    assert ok["storage_path"] == "out/engine=gpu_processed/run_id=latest/job=id-unknown"


def test_identity_product(spark):
    n = 7
    a = spark.createDataFrame([(i, j, float(i * 10 + j + 1)) for i in range(n) for j in range(n)],
                              "row_id long, col_id long, v double")
    eye = spark.createDataFrame([(i, i, 1.0) for i in range(n)], "row_id long, col_id long, v double")
    want = sorted(tuple(r) for r in a.collect())
    assert sorted(tuple(r) for r in matmul_coo(a, eye).collect()) == want
    assert sorted(tuple(r) for r in matmul_tiled(a, eye, block=3).collect()) == want


def test_run_profile_job_cached_and_written(spark, tmp_path):
    from numprof.plans.jobs import run_profile_job
    path = lines_file(tmp_path, ["1.0", "abc", "3.0"])
    out = str(tmp_path / "res")
    rec = run_profile_job(spark, path, "007", kind="dataframe", output_root=out, cache_input=True).collect()[0]
    assert rec["record_count"] == 2 and rec["processing_time_ms"] >= 0
    back = read_results(spark, out).collect()[0]
    assert back["job_id"] == "007" and back["avg_value"] == 2.0


def test_array_job_receipts_point_at_written_results(spark, tmp_path):
    import json
    from numprof.plans.jobs import run_array_job
    src = tmp_path / "req.json"
    src.write_text("\n".join(json.dumps(r) for r in [
        {"job_id": "001", "data": [1.0, 2.0, 3.0]}, {"job_id": "x", "type": "normalize"}]) + "\n")
    out = str(tmp_path / "res")
    got = {r["job_id"]: r for r in run_array_job(spark, str(src), out, per_job_files=True).collect()}
    assert got["x"]["error"] == "No data provided"
    back = read_results(spark, out).collect()
    assert [(r["job_id"], r["engine"]) for r in back] == [("001", "gpu_processed")]
    assert [round(v, 6) for v in back[0]["result"]] == [-1.224745, 0.0, 1.224745]
    import os
    assert os.path.isdir(got["001"]["storage_path"])


def test_analysis_for_given_job_ids(spark):
    rdd = spark.createDataFrame([("a", 10, 1)], "job_id string, processing_time_ms long, record_count long")
    df = spark.createDataFrame([("a", 5)], "job_id string, processing_time_ms long")
    ids = spark.createDataFrame([("a",), ("ghost",)], "job_id string")
    got = {r["job_id"]: r for r in analyze_flat(results_long(rdd=rdd, df=df), ids).collect()}
    assert set(got) == {"a", "ghost"}
    assert got["a"]["faster_method"] == "DataFrame" and got["a"]["speedup"] == 2.0
    assert got["ghost"]["error"] == "Missing results for comparison"
    assert got["ghost"]["gpu_status"] == "failed"


def test_repeated_coordinates_sum_in_both_forms(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 1, 4.0)], "row_id long, col_id long, v double")
    b = spark.createDataFrame([(0, 0, 10.0), (1, 1, 1.0)], "row_id long, col_id long, v double")
    want = {(0, 0): 30.0, (1, 1): 4.0}
    assert {(r[0], r[1]): r[2] for r in matmul_coo(a, b).collect()} == want
    assert {(r[0], r[1]): r[2] for r in matmul_tiled(a, b, block=2).collect()} == want


def test_negative_indices_in_tiles(spark):
    a = spark.createDataFrame([(-3, -1, 2.0), (-3, 4, 1.0)], "row_id long, col_id long, v double")
    b = spark.createDataFrame([(-1, -5, 3.0), (4, -5, 5.0), (4, 2, 7.0)], "row_id long, col_id long, v double")
    want = {(r[0], r[1]): r[2] for r in matmul_coo(a, b).collect()}
    assert want == {(-3, -5): 11.0, (-3, 2): 7.0}
    assert {(r[0], r[1]): r[2] for r in matmul_tiled(a, b, block=3).collect()} == want


def test_two_key_columns(spark):
    df = spark.createDataFrame([("x", 1, 1.0), ("x", 1, 3.0), ("x", 2, 10.0), ("x", 2, 30.0),
                                (None, 1, 5.0), (None, 1, 7.0)], "a string, b int, value double")
    std = standardize(df, keys=["a", "b"], ddof=0)
    got = sorted((r["a"], r["b"], r["value"], r["normalized_value"]) for r in std.collect()
                 if r["a"] is not None)
    assert got == [("x", 1, 1.0, -1.0), ("x", 1, 3.0, 1.0), ("x", 2, 10.0, -1.0), ("x", 2, 30.0, 1.0)]
    nulls = [r["normalized_value"] for r in std.collect() if r["a"] is None]
    assert sorted(nulls) == [-1.0, 1.0]
    cats = category_stats(std, ["a", "b"]).collect()
    assert sum(r["count"] for r in cats) == 6 and {r["category"] for r in cats} == {"medium"}
