"""Algebraic laws over the real test tables."""

from pyspark.sql import functions as F

from support import SF01
from numprof.operators.arrays import standardize_arrays, standardize_arrays_long, array_stats
from numprof.operators.categories import category_stats
from numprof.operators.matrix import array_rows_to_coo, matmul_coo, matmul_tiled
from numprof.operators.profile import profile
from numprof.operators.results import job_results
from numprof.operators.standardize import standardize


def test_zscores_have_mean_zero_and_unit_sd(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    for ddof, sd_fn in ((1, F.stddev_samp), (0, F.stddev_pop)):
        z = standardize(ev, "value", ["event_type"], ddof=ddof)
        for r in z.groupBy("event_type").agg(F.avg("normalized_value").alias("m"),
                                              sd_fn("normalized_value").alias("s")).collect():
            assert abs(r["m"]) < 1e-9 and abs(r["s"] - 1.0) < 1e-9


def test_category_counts_add_up(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    cats = category_stats(standardize(ev, "value"))
    assert cats.agg(F.sum("count")).collect()[0][0] == ev.count()


def test_flavours_known_counts(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    low = {}
    for ddof in (0, 1):
        c = {r["category"]: r["count"] for r in category_stats(standardize(ev, "value", ddof=ddof)).collect()}
        low[ddof] = c["low"]
        assert c["high"] == 1349
    assert low == {1: 94, 0: 98}


def test_variance_ratio(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    s = profile(o, "o_totalprice", ddof=1, extended=True).collect()[0]
    p = profile(o, "o_totalprice", ddof=0, extended=True).collect()[0]
    n = s["record_count"]
    assert abs(s["variance"] / p["variance"] - n / (n - 1)) < 1e-12


def test_array_long_form_equals_array_form(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    a = (standardize_arrays(e, "embedding").select("vec_id", F.posexplode("result").alias("pos", "z")))
    b = standardize_arrays_long(e, ["vec_id"], "embedding")
    diff = a.join(b, ["vec_id", "pos"]).select(F.max(F.abs(F.col("z") - F.col("normalized_value")))).collect()[0][0]
    assert a.count() == b.count() == 500 * 64 and diff < 1e-9
    st = array_stats(e, "embedding").agg(F.max(F.abs(F.col("variance") - F.col("std_dev") ** 2))).collect()[0][0]
    assert st < 1e-9


def test_tiled_equals_coordinate(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    a = array_rows_to_coo(e, "vec_id", "embedding", transpose=True)
    b = array_rows_to_coo(e, "vec_id", "embedding")
    x = matmul_coo(a, b)
    y = matmul_tiled(a, b, block=32)
    j = x.join(y, ["row_id", "col_id"], "full")
    r = j.select(F.count(F.lit(1)).alias("n"), F.max(F.abs(x["v"] - y["v"])).alias("d")).collect()[0]
    assert r["n"] == 64 * 64 and r["d"] < 1e-6


def test_list_and_map_kinds_agree_on_counts(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_type", "value")
    k1 = job_results(ev, "value", job_col="event_type", kind="dataframe")
    k2 = job_results(ev, "value", job_col="event_type", kind="rdd")
    c1 = {(r["job_id"], r["category"]): r["count"] for r in
          k1.select("job_id", F.explode("category_stats").alias("c")).select("job_id", "c.category", "c.count").collect()}
    c2 = {(r["job_id"], r["category"]): r["count"] for r in
          k2.select("job_id", F.explode("category_stats").alias("category", "c")).select("job_id", "category", "c.count").collect()}
    assert sum(c1.values()) == sum(c2.values()) == 10000
    assert set(c1) == set(c2)


def test_smoke_flow_uniform_values_as_one_request(spark):
    """1000 uniform values in [-100, 100) sent as one array request; the
    standardised result has mean 0 and population deviation 1."""
    from numprof.operators.arrays import process_requests
    from numprof.sources.files import uniform_values
    vals = uniform_values(spark.range(1000), seed=3)
    req = vals.agg(F.collect_list("value").alias("data")).select(
        F.lit(None).cast("string").alias("job_id"), F.lit(None).cast("string").alias("type"), "data")
    out = process_requests(req).collect()[0]
    assert out["status"] == "success" and out["job_id"] == "unknown" and out["type"] == "normalize"
    res = out["result"]
    assert len(res) == 1000 and all(-100 <= v < 100 for v in out["data"])
    mean = sum(res) / len(res)
    sd = (sum((x - mean) ** 2 for x in res) / len(res)) ** 0.5
    assert abs(mean) < 1e-9 and abs(sd - 1) < 1e-9


def test_band_stats_equals_category_stats_of_standardize(spark):
    from numprof.operators.categories import band_stats
    df = spark.createDataFrame(
        [("a", v) for v in (1.0, 2.0, 3.0, 10.0, -5.0, float("nan"))]
        + [("b", v) for v in (5.0, 5.0, 5.0)] + [(None, v) for v in (1.0, None, 4.0, 9.0)],
        "k string, value double")
    for ddof, nan_medium, shape in ((1, False, "dataframe"), (0, True, "rdd"), (0, False, "dataframe")):
        for keys in ([], ["k"]):
            a = category_stats(standardize(df, "value", keys, ddof, nan_is_medium=nan_medium, low=-0.5,
                                           high=0.8), keys, "value", shape)
            b = band_stats(df, "value", keys, ddof, nan_is_medium=nan_medium, shape=shape, low=-0.5, high=0.8)
            assert a.columns == b.columns
            norm = lambda rows: sorted((tuple("nan" if isinstance(x, float) and x != x else x for x in r)
                                        for r in rows), key=repr)
            assert norm(a.collect()) == norm(b.collect()), (ddof, nan_medium, shape, keys)


def test_derived_deviation_is_bit_identical(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    for ddof, fn in ((1, F.stddev_samp), (0, F.stddev_pop)):
        got = profile(o, "o_totalprice", ["o_orderstatus"], ddof=ddof, extended=True)
        ref = o.groupBy("o_orderstatus").agg(fn("o_totalprice").alias("ref"))
        rows = got.join(ref, "o_orderstatus").collect()
        assert len(rows) == 3 and all(r["std_dev"] == r["ref"] for r in rows)
    one = spark.createDataFrame([(1.0,)], "value double")
    r = profile(one, extended=True).collect()[0]
    assert r["std_dev"] is None and r["variance"] is None
