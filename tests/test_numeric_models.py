"""Array and matrix operators against numpy on random inputs."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from numprof.operators.arrays import array_stats, standardize_arrays
from numprof.operators.matrix import matmul_coo, matmul_tiled

finite = st.floats(min_value=-1e4, max_value=1e4, allow_nan=False, width=32)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(finite, min_size=0, max_size=40), min_size=1, max_size=12))
def test_arrays_match_numpy(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id long, data array<double>")
    stats = {r["id"]: r for r in array_stats(df, "data").collect()}
    out = {r["id"]: r["result"] for r in standardize_arrays(df, "data").collect()}
    for i, a in enumerate(arrays):
        x = np.asarray(a, dtype=np.float64)
        if x.size == 0:
            assert stats[i]["mean"] is None and out[i] == []
            continue
        assert np.isclose(stats[i]["mean"], x.mean(), rtol=1e-9, atol=1e-9)
        assert np.isclose(stats[i]["std_dev"], x.std(), rtol=1e-9, atol=1e-9)
        if x.std() == 0:
            assert all(v is None for v in out[i])
        else:
            assert np.allclose(out[i], (x - x.mean()) / x.std(), rtol=1e-9, atol=1e-9)


cells = st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.integers(-5, 5)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(cells, cells, st.sampled_from([2, 3, 4, 16]))
def test_products_match_numpy(spark, a_cells, b_cells, block):
    def dense(entries):
        m = np.zeros((10, 10))
        on = np.zeros((10, 10))
        for r, c, v in entries:
            m[r, c] += v          # repeated coordinates add up
            on[r, c] = 1
        return m, on

    a, a_on = dense(a_cells)
    b, b_on = dense(b_cells)
    want_v = a @ b
    touched = (a_on @ b_on) > 0
    want = {(r, c): want_v[r, c] for r, c in zip(*np.nonzero(touched))}
    schema = "row_id long, col_id long, v double"
    ad = spark.createDataFrame([(r, c, float(v)) for r, c, v in a_cells], schema)
    bd = spark.createDataFrame([(r, c, float(v)) for r, c, v in b_cells], schema)
    for got_df in (matmul_coo(ad, bd), matmul_tiled(ad, bd, block=block)):
        got = {(r["row_id"], r["col_id"]): r["v"] for r in got_df.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), finite), min_size=1, max_size=60),
       st.sampled_from(["auto", "always", "never"]), st.sampled_from([0, 1]))
def test_keyed_zscores_match_pandas(spark, rows, mode, ddof):
    import pandas as pd
    from numprof.operators.standardize import standardize
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id long, k string, value double")
    got = {r["id"]: r["normalized_value"] for r in standardize(df, "value", ["k"], ddof=ddof, broadcast=mode).collect()}
    pdf = pd.DataFrame([(i, k if k is not None else "<null>", v) for i, (k, v) in enumerate(rows)],
                       columns=["id", "k", "value"])
    g = pdf.groupby("k")["value"]
    mu, sd = g.transform("mean"), g.transform(lambda s: s.std(ddof=ddof))
    for i, m, s, v in zip(pdf["id"], mu, sd, pdf["value"]):
        if not np.isfinite(s) or s == 0:
            assert got[i] is None
        else:
            assert abs(got[i] - (v - m) / s) < 1e-6 * max(1.0, abs((v - m) / s))


@pytest.mark.parametrize("seed", range(4))
def test_tiled_equals_coordinate_on_hard_values(spark, seed):
    """Infinity, NaN, NULL, repeats, sparse and full inputs, narrow last strips."""
    rng = np.random.default_rng(seed)
    odd = [float("inf"), float("-inf"), float("nan"), None, 0.0]

    def cells(rows, cols, share):
        out = []
        for r in range(rows):
            for c in range(cols):
                if rng.random() < share:
                    v = float(rng.integers(-4, 5)) if rng.random() < 0.9 or seed == 3 else odd[rng.integers(len(odd))]
                    out += [(r - 3, c - 2, v)] * int(rng.integers(1, 3) if seed == 2 else 1)
        return spark.createDataFrame(out, "row_id long, col_id long, v double")
    share = 1.0 if seed == 3 else 0.4
    a, b = cells(13, 9, share), cells(9, 41, share).selectExpr("row_id + 1 AS row_id", "col_id", "v")
    key = lambda rows: {(r[0], r[1]): "nan" if r[2] != r[2] else r[2] for r in rows}
    want = key(matmul_coo(a, b).collect())
    assert want and key(matmul_tiled(a, b, block=5).collect()) == key(matmul_tiled(a, b, block=37).collect()) == want


def test_tall_times_small_fills_the_tasks(spark):
    tall = spark.range(2000).selectExpr("id AS row_id", "explode(sequence(0, 3)) AS col_id").selectExpr("row_id", "cast(col_id AS long) col_id", "cast(row_id + col_id AS double) v")
    small = spark.range(4).selectExpr("id AS row_id", "explode(sequence(0, 3)) AS col_id").selectExpr("row_id", "cast(col_id AS long) col_id", "1.0D v")
    from numprof.operators.matrix import _spread
    copies, right = _spread(tall, small, 64)
    assert right and copies >= spark.sparkContext.defaultParallelism
    out = matmul_tiled(tall, small, block=64)
    assert out.count() == 8000 and out.filter("v <> 4 * row_id + 6").count() == 0


def test_empty_product(spark):
    none = spark.createDataFrame([], "row_id long, col_id long, v double")
    assert matmul_tiled(none, none).collect() == [] == matmul_coo(none, none).collect()
