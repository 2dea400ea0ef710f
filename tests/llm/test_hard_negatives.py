"""Hard negatives against brute force over all pairs."""

import math

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from numprof.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, row string"


def brute(rows, n_pos=5, n_neg=10):
    """rows of (id, vector, label)."""
    rows = [(i, [math.floor(256 * x) if abs(x) < 1 << 53 else int(x) * 256 for x in v], l) for i, v, l in rows
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda s, i: (-s, i is None, i or 0)
    long = lambda v: v if -1 << 63 <= v < 1 << 63 else None
    out = []
    for k, (i, v, l) in enumerate(rows):
        if i is None or i % 100:
            continue
        s = [sum(a * b for a, b in zip(v, w)) for _, w, _ in rows]
        order = sorted(range(len(rows)), key=lambda j: first(s[j], rows[j][0]))
        for p in [j for j in order if rows[j][2] == l and j != k][:n_pos]:
            found = [j for j in order if rows[j][2] != l and 30 * s[p] <= 100 * s[j] <= 90 * s[p]][:n_neg]
            out += [(i, rows[p][0], r, rows[j][0], long(s[p]), long(s[j])) for r, j in enumerate(found, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, "x", "y") for i, v, l in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect()), key=str)


def some_rows(n, seed, dim=3):
    import random
    r = random.Random(seed)
    return [(i * 25 % 1000, [r.choice([-0.5, 0.0, 0.25, 0.9, r.random()]) for _ in range(dim)], r.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 7, "cell_anchors": 2}])
def test_ties_and_many_cells(spark, options):
    rows = some_rows(60, 1)
    want = brute(rows)
    assert want and mined(spark, rows, **options) == want


def test_unusable_rows_null_ids_repeats_and_lengths(spark):
    rows = some_rows(30, 2) + [
        (100, None, 1), (200, [1.0, None, 1.0], 1), (300, [float("nan"), 1.0, 1.0], 1), (400, [float("inf"), 0.0, 0.0], 0), (500, [1.0, 1.0, 1.0], None),
        (None, [0.9, 0.9, 0.9], 0), (None, [0.5, 0.5, 0.5], 1), (600, [0.9], 1), (700, [], 2), (0, [0.9, 0.9, 0.9], 0), (0, [0.9, 0.9, 0.9], 0)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, cell_rows=5, cell_anchors=1) == brute(rows)


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 2.0], 0), (2, [5e29, 0.0], 1), (3, [3e29, 1e18], 1), (4, [1e10, 1e9], 2), (100, [3e9, 1.0], 2)]
    assert mined(spark, rows) == brute(rows) != []


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 0), (2, [0.5], 1)]) == []


@given(st.tuples(st.integers(0, 1 << 62), st.integers(-1 << 90, 1 << 90), st.booleans(), st.none() | st.integers(-1 << 63, (1 << 63) - 1)))
def test_key_round_trip(t):
    assert hn.unpack(hn.pack(*t)) == t


@given(st.lists(st.integers(-1 << 80, 1 << 80), min_size=2), st.lists(st.integers(-300, 300), min_size=2))
def test_packed_order(big, small):
    for values in (big, small):
        assert sorted(values, key=hn.pack_int) == sorted(values)


def test_query_against_brute_force(spark):
    from numprof.llm import queries
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op11_hard_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
