"""Presence of request data, seeded draws, and the choice between the two matrix products."""

import hashlib

from pyspark.sql import functions as F

from numprof.operators.matrix import matmul, matmul_coo, product_cost
from numprof.operators.results import receipts
from numprof.sources import files


def test_null_data_is_present(spark, tmp_path):
    lines = ['{"job_id":"absent"}', '{"job_id":"null","data":null}', '{"job_id":"text","data":"x"}', '{"job_id":"ok","data":[1,null,2]}', "", "  \t",
             '[{"job_id":"in list","data":[1]},{"job_id":"list null","data":null}]', '{"job_id":"inner","meta":{"data":[1]}}', "not json", '{"job_id":"empty","data":[]}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    got = {r["job_id"]: (r["http_status"], r["processed_count"]) for r in receipts(files.read_requests(spark, str(tmp_path / "r.json")), "out").collect()}
    assert got == {"absent": (400, None), "null": (500, None), "text": (500, None), "ok": (200, 3), "in list": (200, 1), "list null": (500, None),
                   "inner": (400, None), "unknown": (400, None), "empty": (200, 0)}


def test_draws_are_the_documented_ones(spark, monkeypatch):
    monkeypatch.setattr(files, "DRAW_BLOCK", 4)
    jobs = spark.createDataFrame([("a", 11, 5), ("b", 4, 5), ("c", 0, 1), ("d", None, 1), ("e", -3, 1), (None, 2, None)], "job string, n int, seed int")
    got = sorted(map(tuple, files.uniform_draws(jobs, "job", "n", "seed", -1, 3).collect()), key=str)
    want = []
    for job, n, seed in (("a", 11, "5"), ("b", 4, "5"), (None, 2, "NULL")):
        for i in range(n):
            bits = int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:13], 16)
            want.append((job, i, bits / (1 << 52) * 4 - 1))
    assert got == sorted(want, key=str)


def test_a_hot_job_draws_in_many_tasks(spark):
    jobs = spark.createDataFrame([("hot", 200_000, 1), ("cold", 10, 2)], "job string, n int, seed int")
    out = files.uniform_draws(jobs, "job", "n", "seed")
    with_task = out.filter("job = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(with_task) >= 4 and sum(r["count"] for r in with_task) == 200_000
    v = out.agg(F.avg("value"), F.stddev_samp("value"), F.min("value"), F.max("value")).first()
    assert abs(v[0]) < 1 and abs(v[1] - 57.735) < 1 and v[2] >= -100 and v[3] < 100


def dense(spark, n, m):
    return spark.range(n * m).selectExpr(f"id div {m} row_id", f"id % {m} col_id", "double(id % 7 + 1) v")


def test_density_chooses_the_form(spark):
    a, b = dense(spark, 40, 200), dense(spark, 200, 40)
    full = product_cost(a, b, 32)
    assert full.method == "tiled" and full.join_rows == 40 * 200 * 40 and full.tile_ops == 2 * 7 * 2 * 32 ** 3
    diagonal = spark.range(2000).selectExpr("id row_id", "id col_id", "double(id) v")
    thin = product_cost(diagonal, diagonal, 128)
    assert thin.method == "join" and thin.join_rows == 2000 and thin.tile_ops == 16 * 128 ** 3
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "MapInArrow" in plan(matmul(a, b, 32)) and "MapInArrow" not in plan(matmul(diagonal, diagonal))
    key = lambda df: sorted((r[0], r[1], round(r[2], 6)) for r in df.collect())
    assert key(matmul(a, b, 32)) == key(matmul_coo(a, b))


def test_cost_of_negative_null_and_empty(spark):
    cells = spark.createDataFrame([(-1, -1, 1.0), (-130, 5, 2.0), (5, -1, None), (None, 1, 1.0), (1, 5, 1.0)], "row_id bigint, col_id bigint, v double")
    got = product_cost(cells, cells.select(F.col("col_id").alias("row_id"), F.col("row_id").alias("col_id"), "v"))
    assert got.join_rows == 1 + 4 and got.tile_ops == (1 + 4) * 128 ** 3  # inner -1: one row; inner 5: rows -130 and 1, two tiles
    none = cells.limit(0)
    assert product_cost(none, cells).join_rows == 0 and matmul(none, cells).count() == 0


def test_hot_inner_index_counts_as_dense(spark):
    hot = spark.range(3000).selectExpr("id row_id", "0L col_id", "1.0D v")
    other = spark.range(3000).selectExpr("0L row_id", "id col_id", "1.0D v")
    assert product_cost(hot, other).join_rows == 9_000_000
