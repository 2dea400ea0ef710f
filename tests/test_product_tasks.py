"""The coordinate product goes to tasks by the rows that its join makes."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from numprof.operators import matrix
from numprof.operators.matrix import matmul, matmul_coo, product_cost
from numprof.plans import registry
from tests.support import SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df):
    """Keys and partitions of every hash exchange."""
    found = re.findall(r"hashpartitioning\((.*?), (\d+)\)", _plan(df))
    return [(re.sub(r"#\d+L?", "", keys), int(n)) for keys, n in found]


def _matrix(spark, cells):
    return spark.createDataFrame(cells, "row_id long, col_id long, v double")


def _skewed():
    """Cells of A and B: inner 0 heavy on both sides, 1 on the left, 2 on the
    right, 3 in A only, the others thin; repeats and nulls among them."""
    a = [(r, 0, r + 1.0) for r in range(90)] + [(r, 1, 2.0) for r in range(1500)] + [(7, 2, 3.0)]
    a += [(r, 3, 1.0) for r in range(2000)] + [(r, 10 + r % 50, 1.0) for r in range(200)]
    b = [(0, c, c - 4.0) for c in range(80)] + [(1, 5, 1.0)] + [(2, c, 0.5) for c in range(1700)]
    b += [(10 + c % 50, c, -1.0) for c in range(150)]
    return a + a[:40] + [(1, 0, None), (None, 0, 1.0), (1, None, 1.0)], b + b[:30] + [(0, 1, None), (None, 1, 1.0)]


def _product(a, b):
    by_k, out = defaultdict(list), defaultdict(float)
    for k, c, v in b:
        if None not in (k, c, v):
            by_k[k].append((c, v))
    for r, k, v in a:
        if None not in (r, k, v):
            for c, w in by_k[k]:
                out[r, c] += v * w
    return dict(out)


def test_partitions_follow_the_rows_of_the_join(spark):
    # 9,000 cells, but 25 indices that make 32,400 rows and one that makes 20 million
    a = spark.range(4500).selectExpr("id row_id", "0L col_id", "1.0D v").union(
        spark.range(4500).selectExpr("id row_id", "1 + id % 25 col_id", "1.0D v"))
    out = matmul_coo(a, a.selectExpr("col_id row_id", "row_id col_id", "v"))
    assert [s for s in _shuffles(out) if s[0] == "k, deal" and s[1] >= 20], _shuffles(out)
    thin = matmul_coo(a.filter("col_id > 0"), a.filter("col_id > 0").selectExpr("col_id row_id", "row_id col_id", "v"))
    assert {s[0] for s in _shuffles(thin)} == {"k", "row_id, col_id"}


def test_heavy_inner_index_is_dealt_whole(spark, monkeypatch):
    monkeypatch.setattr(matrix, "TASK_ROWS", 500)
    a, b = _skewed()
    ad, bd = _matrix(spark, a), _matrix(spark, b)
    want = _product(a, b)
    cost = product_cost(ad, bd, 512)
    assert cost.hot == 3 and cost.method == "join"
    for out in (matmul_coo(ad, bd), matmul(ad, bd, 512)):
        assert "deal" in _plan(out)
        rows = out.collect()
        assert {(r[0], r[1]): r[2] for r in rows} == want and len(rows) == len(want)
    left = ad.dropna().selectExpr("col_id k", "row_id o", "v")
    right = bd.dropna().selectExpr("row_id k", "col_id o", "v")
    da, db = (m.groupBy("k", "deal").count() for m in matrix._deal(left, right))
    work = da.withColumnRenamed("count", "m").join(db, ["k", "deal"]).select((F.col("m") * F.col("count")).alias("rows"))
    most, total = work.agg(F.max("rows"), F.sum("rows")).first()
    assert total == cost.join_rows and most <= 2 * 500


def test_same_matrix_on_both_sides_counts_once(spark, monkeypatch):
    monkeypatch.setattr(matrix, "TASK_ROWS", 50)
    cells = [(i, j, float(i - j)) for i in range(12) for j in range(9)]
    m = _matrix(spark, cells)
    assert product_cost(m, m).join_rows == 12 * 9 * 9
    assert {(r[0], r[1]): r[2] for r in matmul_coo(m, m).collect()} == _product(cells, cells)


def test_sparse_query_groups_bounded_tasks_not_scan_splits(spark, monkeypatch):
    monkeypatch.setattr(registry, "TASK_CELLS", 1000)
    monkeypatch.setattr(matrix, "TASK_ROWS", 3000)
    rows = spark.read.parquet(f"{SF01}/lineitem.parquet")
    out = registry.matrix_multiply_sparse(spark, SF01)
    shuffles = _shuffles(out)
    assert ("l_orderkey", -(-rows.count() // 1000)) in shuffles
    cells = rows.select("l_orderkey", "l_partkey").distinct().groupBy("l_orderkey").count()
    made = cells.agg(F.sum(F.col("count") ** 2)).first()[0]
    assert ("k", -(-int(made) // 3000)) in shuffles
    lines = _plan(out).splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(l_orderkey" in line:
            assert "HashAggregate" not in lines[i + 1], lines[i + 1]
