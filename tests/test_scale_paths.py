"""The non-broadcast path and hot keys, on generated rows (tests only)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from numprof.operators.categories import category_stats
from numprof.operators.profile import profile
from numprof.operators.standardize import standardize


def _skewed(spark, n=30000):
    # key 0 holds a third of all rows; NULL keys are a group of their own
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.sin(F.col("id")) * 100).alias("value"))


def test_shuffled_path_matches_broadcast_path(spark):
    df = _skewed(spark)
    fast = {(r["k"], r["category"]): (r["count"], r["avg_normalized"])
            for r in category_stats(standardize(df, "value", ["k"]), ["k"]).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        std = standardize(df, "value", ["k"])
        plan = std._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan
        slow = {(r["k"], r["category"]): (r["count"], r["avg_normalized"])
                for r in category_stats(std, ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert fast.keys() == slow.keys()
    assert any(k[0] is None for k in fast)
    for key, (n, m) in fast.items():
        assert slow[key][0] == n and abs(slow[key][1] - m) < 1e-9
    assert sum(n for (k, _), (n, _) in fast.items() if k == 0) == 10000


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark):
    """A third of the rows in one key, no NULL key: a skewed read in the final plan."""
    from numprof.operators.categories import band_stats
    from numprof.operators.results import job_results
    rows = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("k"), F.sin(F.col("id")).alias("value")).repartition(16)
    lowered = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
               "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in lowered}
    try:
        for k, v in lowered.items():
            spark.conf.set(k, v)
        assert "skewed" in _final_plan(band_stats(rows, "value", ["k"]))
        assert "skewed" in _final_plan(job_results(rows, "value", job_col="k"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=2, max_size=60))
def test_profile_and_bands_match_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "value double")
    p = profile(df, ddof=0).collect()[0]
    arr = np.array(xs)
    assert p["record_count"] == len(xs)
    assert np.isclose(p["avg_value"], arr.mean(), rtol=1e-9, atol=1e-6)
    assert np.isclose(p["std_dev"], arr.std(), rtol=1e-6, atol=1e-6)
    cats = {r["category"]: r["count"] for r in category_stats(standardize(df, ddof=0)).collect()}
    assert sum(cats.values()) == len(xs)
    sd = arr.std()
    if sd > 1e-3:
        z = (arr - arr.mean()) / sd
        clear = np.abs(np.abs(z) - 1.0) > 1e-6   # skip values on the band edges
        if clear.all():
            assert cats.get("high", 0) == int((z > 1).sum())
            assert cats.get("low", 0) == int((z < -1).sum())


def test_broadcast_modes(spark):
    df = _skewed(spark, 3000)
    want = {(r["k"], r["category"]): r["count"]
            for r in category_stats(standardize(df, "value", ["k"]), ["k"]).collect()}
    for mode, join in (("always", "BroadcastHashJoin"), ("never", "ShuffledHashJoin")):
        std = standardize(df, "value", ["k"], broadcast=mode)
        assert join in std._jdf.queryExecution().sparkPlan().toString()
        # no statistics were materialised: the stats aggregate is part of the plan
        assert "ExistingRDD" not in std._jdf.queryExecution().sparkPlan().toString()
        got = {(r["k"], r["category"]): r["count"] for r in category_stats(std, ["k"]).collect()}
        assert got == want
