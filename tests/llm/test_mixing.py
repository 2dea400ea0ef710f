"""Water-filling and sampling against direct versions."""

import hashlib
import re

import pytest

from numprof.llm import mixing


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), cap=3):
    """Clamp and reshare by weight until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        target |= {s: float(cap * sizes[s]) for s in over}
        free -= over
    return target


def brute_mix(rows, seed=42):
    """Per row: size, source_size, target, times, taken."""
    size = [len(re.findall("[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    h = [int(hashlib.md5("|".join([str(seed), "~" if i is None else str(i), "~" if t is None else t]).encode()).hexdigest()[:15], 16) for i, t, _ in rows]
    sizes = {}
    for n, (_, _, s) in zip(size, rows):
        sizes[s] = sizes.get(s, 0) + n
    target, cut = brute_targets(sizes), {}
    for s, n in sizes.items():
        whole = int(target[s] // n) if n else 0
        part, run, cut[s] = target[s] - whole * n, 0, 0
        by_hash = {}
        for k, r in enumerate(rows):
            if r[2] == s:
                by_hash[h[k]] = by_hash.get(h[k], 0) + size[k]
        for x in sorted(by_hash):
            if part > 0 and run + by_hash[x] >= part:
                cut[s] = x + 1 if run + by_hash[x] - part < part - run else x
                break
            run += by_hash[x]
    out = []
    for k, (_, _, s) in enumerate(rows):
        times = min((int(target[s] // sizes[s]) if sizes[s] else 0) + (h[k] < cut[s]), 3)
        out.append({"size": size[k], "source_size": sizes[s], "target": target[s], "times": times, "taken": size[k] * times})
    return out


def rows_of(n, sources, seed):
    import random
    r = random.Random(seed)
    return [(k, " ".join("w" * r.randint(1, 5) for _ in range(r.choice([0, 1, 5, 40]))), sources[min(int(r.expovariate(0.7)), len(sources) - 1)])
            for k in range(n)]


CASES = [
    rows_of(300, ["b", "a", "", "é", None, "Z"], 1),
    rows_of(500, ["only"], 2),
    [(1, "a b c", "x"), (2, None, "y"), (3, "", "z"), (None, "d e", None), (None, "d e", None), (1, "a b c", "x")],
    [(k, "w " * (1000 if k == 0 else 1), "big" if k < 40 else f"s{k}") for k in range(60)],
    [(1, "", "x"), (2, None, None)],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("few", [0, 1 << 16])
def test_mix_matches_brute_force(spark, frame, monkeypatch, rows, few):
    monkeypatch.setattr(mixing, "FEW_ROWS", few)
    docs = frame([(*r, 1) for r in rows], "doc_id int, text string, source string, size int")
    got = sorted(mixing.mix_sizes(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["size"]))
    want = sorted(zip(rows, brute_mix(rows)), key=lambda x: (x[0][0] is None, x[0][0], x[1]["size"]))
    for r, ((i, _, _), b) in zip(got, want, strict=True):
        assert r["doc_id"] == i and r["target"] == pytest.approx(b["target"])
        assert {k: r[k] for k in ("size", "source_size", "times", "taken")} == {k: b[k] for k in ("size", "source_size", "times", "taken")}
        assert r["taken"] <= 3 * r["size"]


def test_mix_repeats_rows_and_keeps_columns(spark, frame):
    rows = CASES[0]
    docs = frame([(*r, k) for k, r in enumerate(rows)], "doc_id int, text string, source string, cut int")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    want = sorted(k for k, b in enumerate(brute_mix(rows)) for _ in range(b["times"]))
    assert sorted(r["cut"] for r in out.collect()) == want == sorted(r["cut"] for r in mixing.mix(docs).collect())


def test_taken_words_come_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_sizes(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    for _, s in rows.groupby("source"):
        assert abs(s["taken"].sum() - s["target"].iloc[0]) <= s["size"].max() / 2 + 1


def test_empty_table(spark, frame):
    docs = frame([], "doc_id int, text string, source string")
    assert mixing.mix_sizes(docs).collect() == [] and mixing.mix(docs).collect() == []
