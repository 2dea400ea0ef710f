"""MinHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from numprof.llm import tensor_minhash as tm

SCHEMA = "doc_id bigint, text string, c string, cls string, n int"


def brute(rows):
    sets = []
    for _, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for blank in "\t\n\x0b\x0c\r":
            w = w.replace(blank, " ")
        w = [x for x in w.split(" ") if x]
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), first, doc_id == first))
    return sorted(out, key=str)


def grouped(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], SCHEMA)
    return sorted(map(tuple, tm.near_duplicates(df, **options).collect()), key=str)


def family(seed, n, words=120, edits=3):
    """Texts that drift apart: each a few words away from an earlier one."""
    r = random.Random(seed)
    out = [[r.choice("abcdefgh") + str(r.randrange(500)) for _ in range(words)]]
    while len(out) < n:
        t = list(r.choice(out))
        for _ in range(r.randrange(edits + 1)):
            t[r.randrange(len(t))] = f"new{r.randrange(10 ** 6)}"
        out.append(t)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("tile_bytes", [tm.TILE_BYTES, 4000])
def test_families_against_all_pairs(spark, monkeypatch, tile_bytes):
    monkeypatch.setattr(tm, "TILE_BYTES", tile_bytes)
    texts = family(1, 80) + family(2, 30, 60, 8) + family(3, 10, 40, 0) + [f"lone {i} text of its own words {i}" for i in range(10)]
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    assert grouped(spark, rows) == brute(rows)


def test_shared_passage_is_no_link(spark):
    r = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(60))) for i in range(60)]
    got = grouped(spark, rows)
    assert got == brute(rows) and all(row[3] for row in got)


def test_edge_rows(spark):
    rows = [(1, None), (2, None), (3, ""), (4, " \t\n"), (5, "one"), (6, "ONE"), (7, "one two three"), (8, "One two three"), (9, "a b c d"),
            (9, "a b c d"), (9, "other words on one id"), (10, "A b c d"), (None, "a b c d"), (None, "no id has this text"), (None, "no id has this text"), (None, None),
            (11, "x " * 50_000), (12, "x x x x")]
    assert grouped(spark, rows) == brute(rows)


def test_exactly_at_the_threshold(spark):
    a, b = ([f"{c}{i}" for i in range(43)] for c in "ab")  # 40 shingles each
    cut = [(1, " ".join(a)), (2, " ".join(a[:35])), (3, " ".join(b)), (4, " ".join(b[:34]))]  # 32 and 31 of 40
    got = grouped(spark, cut, rows=1, m=60)
    assert got == brute(cut) and [r[2] for r in got] == [1, 1, 3, 4]


def test_empty_table(spark):
    assert grouped(spark, []) == []


def test_tile_links_span_all_links():
    r = np.random.default_rng(3)
    sets = [np.unique(r.choice(40, 30)).astype(np.uint64) for _ in range(60)]
    want = [(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]

    def roots(links):
        root = list(range(60))
        for _ in range(60):
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    for known in (list(range(60)), [min(i, 20) for i in range(60)]):
        found = tm.tile_links(list(range(60)), [s.tobytes() for s in sets], [True] * 60, known, 80)
        base = [(i, known[i]) for i in range(60)]
        assert set(found) | {(j, i) for i, j in found} <= set(want) | {(j, i) for i, j in want}
        assert roots(base + found) == roots(base + want)


def test_halves_agree_with_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.concatenate([a[:900], np.unique(r.integers(0, 1 << 63, 100).astype(np.uint64))])
    s = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = np.mean(tm.halves(a, 1, 600) == tm.halves(b, 1, 600))
    assert abs(same - s) < 0.05


def test_deduplicate_keeps_one_of_each(spark):
    rows = [(3, "a b c d e"), (2, "A b c d e"), (5, "something else here now"), (7, None)]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    out = tm.deduplicate(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [2, 5, 7]


def test_query_against_all_pairs(spark):
    from numprof.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op13_tensor_minhash(spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
