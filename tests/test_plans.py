"""Physical-plan properties that matter at scale."""

from numprof.operators.arrays import standardize_arrays
from numprof.plans import registry
from numprof.plans.stats_join import attach_by_keys, table_size

from support import SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs_are_partial(plan):
    """Every SinglePartition exchange carries partial aggregates only."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "partial_" in lines[i + 1], "\n".join(lines[i:i + 3])


def test_global_zscore_keeps_fact_side_unshuffled(spark):
    plan = _plan(registry.zscore_categories(spark, SF01))
    assert "Subquery" in plan and "Join" not in plan
    _single_partition_inputs_are_partial(plan)
    assert "partial_count" in plan and "partial_avg" in plan
    assert "ReadSchema: struct<value:double>" in plan


def test_keyed_zscore_broadcasts_checked_stats(spark):
    plan = _plan(registry.categories_by_job(spark, SF01))
    assert "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan


def test_no_query_funnels_rows_into_one_task(spark):
    for name, build in registry.queries().items():
        _single_partition_inputs_are_partial(_plan(build(spark, SF01)))


def test_only_matrix_joins_shuffle_unaggregated_rows(spark):
    import re
    for name, build in registry.queries().items():
        if name.startswith("matrix_multiply"):
            continue
        lines = _plan(build(spark, SF01)).splitlines()
        for i, line in enumerate(lines):
            if "__block" in line:  # uniform_input: one row per 4,096 draws, before they are drawn
                continue
            if re.search(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", line):
                assert re.search("partial_|, Partial$", lines[i + 1]), (name, line, lines[i + 1])


def test_large_stats_are_not_broadcast(spark):
    rows = spark.range(1000).selectExpr("id AS k", "cast(id AS double) AS value")
    stats = spark.range(1000).selectExpr("id AS k", "1.0 AS s")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
        plan = attach_by_keys(rows, stats, ["k"])._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = attach_by_keys(rows, stats, ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_table_size_measures_long_strings(spark):
    short = spark.createDataFrame([("a", 1.0)] * 10, "k string, v double")
    long = spark.createDataFrame([("x" * 1000, 1.0)] * 10, "k string, v double")
    assert table_size(short) == 10 * (16 + 16) + 10
    assert table_size(long) == 10 * (16 + 16) + 10 * 1000


def test_no_python_udfs_outside_tiled_matmul(spark):
    for name, build in registry.queries().items():
        if name in ("matrix_multiply_tiled", "timed_profile"):
            continue
        plan = _plan(build(spark, SF01))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "MapInPandas" not in plan, name


def test_array_moments_evaluated_once_per_row(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    plan = _plan(standardize_arrays(e, "embedding"))
    # the per-element lambda over the array reads only lambda variables:
    # no aggregate, no square root, recomputed per element
    # the array is cast once; each of the two passes over it appears once
    assert plan.count("cast(embedding") == 1
    assert plan.count("aggregate(") == 2
    # the per-element lambda of the final transform reads only lambda
    # variables: no aggregate and no square root per element
    inner = plan[plan.rindex("transform(lambda"):plan.index(" AS result")]
    assert "aggregate(" not in inner and "SQRT" not in inner.upper()


def test_adaptive_threshold_governs_measured_broadcasts(spark):
    rows = spark.range(100).selectExpr("id % 5 AS k", "cast(id AS double) AS value")
    stats = spark.range(5).selectExpr("id AS k", "1.0 AS s")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
        plan = attach_by_keys(rows, stats, ["k"])._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_cluster_conf_scales_with_input():
    from numprof.session import cluster_conf, row_partitions
    big = cluster_conf(100 << 40, 8000, "hdfs://shared/ckpt")
    maps = (100 << 40) // int(big["spark.sql.files.maxPartitionBytes"])
    partitions = int(big["spark.sql.shuffle.partitions"])
    assert partitions >= 2 * 8000 and maps * partitions < 5e9 and maps <= 200_000
    assert big["spark.checkpoint.dir"] == "hdfs://shared/ckpt"
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert int(cluster_conf(1 << 20, 16, "/c")["spark.sql.shuffle.partitions"]) == 48
    assert row_partitions(100 << 40, 8000) == 102_400 and row_partitions(1, 16) == 48


def test_plain_equality_join_when_no_key_is_null(spark):
    from numprof.operators.standardize import standardize
    clean = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (2, 9.0)], "k long, value double")
    plan = _plan(standardize(clean, keys=["k"]))
    assert "BroadcastHashJoin [k" in plan and "isnull" not in plan
    dirty = clean.union(spark.createDataFrame([(None, 4.0), (None, 6.0)], "k long, value double"))
    std = standardize(dirty, keys=["k"])
    assert "isnull" in _plan(std)
    got = {(r["k"], r["value"]): r["normalized_value"] for r in std.collect()}
    assert got[(None, 4.0)] == -0.7071067811865475 and got[(1, 3.0)] == 0.7071067811865475
