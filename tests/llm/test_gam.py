"""Additive model: features, fitting, held-out accuracy."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from numprof.llm import gam, queries

SF = "/root/testdata/sf0.01"


def test_features():
    f = dict(zip(gam.FEATURES, gam.measure("Aa bb bb!\nx1 | é\nx1 | é\n\n")))
    n, chars = 9, 2 + 2 + 3 + 2 + 1 + 2 + 2 + 1 + 2
    assert f["log_words"] == pytest.approx(np.log1p(n)) and f["word_length"] == pytest.approx(chars / n)
    assert f["distinct_words"] == pytest.approx(6 / n) and f["equal_neighbours"] == 0 and f["longest_word"] == 3
    assert f["capitals"] == pytest.approx(1 / chars) and f["bars"] == pytest.approx(2 / n) and f["exclamations"] == pytest.approx(1 / n)
    assert f["repeated_lines"] == pytest.approx(1 / 3) and f["non_ascii"] == pytest.approx(4 / chars) and f["words_per_line"] == pytest.approx(3)
    assert gam.measure(None) == gam.measure("") == gam.measure(" \n\t") == (0.0,) * len(gam.FEATURES)
    assert dict(zip(gam.FEATURES, gam.measure("a a a b")))["equal_neighbours"] == pytest.approx(0.5)


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # pure interaction
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    for row in x[:20]:
        z = model.intercept
        for j, (e, t) in enumerate(zip(model.edges, model.tables)):
            z += t[sum(row[j] >= c for c in e)]
        for (a, b), t in model.pairs.items():
            z += t[sum(row[a] >= c for c in model.pair_edges[a]), sum(row[b] >= c for c in model.pair_edges[b])]
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-z)))
    fresh = rng.random((500, 3))
    assert np.mean((model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))) > 0.9


def test_main_effects_and_degenerate_samples():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 2))
    y = (np.abs(x[:, 0]) > 1).astype(float)
    assert np.mean((gam.fit(x, y).score(x) > 0.5) == y) > 0.95
    assert gam.fit(np.empty((0, 2)), np.empty(0)).score(np.zeros((1, 2)))[0] == pytest.approx(0.5)
    assert gam.fit(np.zeros((9, 2)), np.ones(9)).score(np.zeros((1, 2)))[0] > 0.8


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = [r for r in queries.op5_gam_quality(spark, SF).collect()]
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.93


def test_edges(spark, frame):
    docs = frame([(1, None, 0.5), (2, "", 0.5), (None, "some words here", 0.5), (3, "w " * 100_000, 0.5), (3, "w " * 100_000, 0.5)], "doc_id int, text string, score double")
    labels = frame([(1, 1), (2, None), (None, 0), (1, 0), (9, 1)], "doc_id int, quality int")
    out = gam.quality_scores(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert [r["score"] for r in gam.quality_scores(docs, labels.limit(0)).collect()] == [pytest.approx(0.5)] * 5
    assert gam.quality_scores(docs.limit(0), labels).collect() == []
