"""SimHash near-duplicates against all pairs, compared directly."""

import random

import numpy as np
import pytest
import xxhash

from numprof.llm import simhash


def brute_print(text, k=3):
    words, lower = [], (text or "")
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in lower)
    word = ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, r=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= r:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(x, low.get(find(i), x))
    return [low.get(find(i)) for i in range(len(ids))]


TEXTS = ["The cat  sat on the\tmat", "the CAT sat on the mat", "", None, "  \n\t", "one", "One", "two words", "Élan élan ÉLAN x",
         "a b c", "a b c a b c a b c a b c", "\x85 \xa0 is no white space", "word " * 3000, "word " * 3000 + "end"]


def test_fingerprint_matches_brute_force(spark, frame):
    got = {r["id"]: r["fp"] for r in simhash.fingerprints(frame(list(enumerate(TEXTS)), "doc_id int, text string")).collect()}
    assert got == {i: int(np.uint64(brute_print(t)).astype(np.int64)) for i, t in enumerate(TEXTS)}


def test_native_hash_agrees(spark):
    row = spark.sql("SELECT xxhash64('the cat sat') h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"the cat sat", 42)


def family(seed, n):
    """Prints with dense clusters, bit chains and far points."""
    rng = np.random.default_rng(seed)
    far = rng.integers(0, 1 << 63, n // 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = list(far)
    for center in far[:4]:
        for _ in range(n // 8):
            p = int(center)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                p ^= 1 << int(b)
            out.append(np.uint64(p))
    chain = int(far[-1])
    for b in range(0, 40, 2):
        chain ^= 3 << b
        out.append(np.uint64(chain))
    out += [np.uint64(0), np.uint64(1), np.uint64(2 ** 64 - 1)]
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("seed,shard_rows,leaf", [(1, 40, 8), (2, 10_000, 16), (3, 100, 128)])
def test_components_match_all_pairs(spark, monkeypatch, seed, shard_rows, leaf):
    monkeypatch.setattr(simhash, "LEAF_ROWS", leaf)
    prints = family(seed, 600)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint")
    links = simhash.near_links(df, len(prints), shard_rows=shard_rows)
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    ids = [int(x) for x in prints.view(np.int64)]
    want = brute_components(ids, [int(p) for p in prints])
    assert [got.get(i, i) for i in ids] == want


@pytest.mark.parametrize("seed", [1, 4])
def test_large_shards_are_cut_again(spark, monkeypatch, seed):
    """A first tree of a few shards only: groups stay bounded, links whole."""
    for name, value in {"MAX_SAMPLE": 32, "SAMPLE_PER_SHARD": 8, "SHARD_SLACK": 2, "GUEST_RATIO": 3, "CUT_ROWS": 60}.items():
        monkeypatch.setattr(simhash, name, value)
    prints = family(seed, 600)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint")
    placed = simhash.shards(df, len(prints), shard_rows=10).toPandas()
    assert placed[placed["part"] == 0].groupby("fp")["home"].sum().max() == 1 and placed[placed["home"]]["fp"].nunique() == len(prints)
    sizes = placed.groupby(["shard", "part"])["home"].agg(["sum", "count"])
    assert placed["shard"].str.count(r"\.").max() > 1 and (placed["part"] > 0).any()
    assert sizes["sum"].max() <= 20 and (sizes["count"] - sizes["sum"]).max() <= 60
    at = {}
    for shard, part, fp, home in placed.itertuples(index=False):
        at.setdefault(fp, {})[shard, part] = home
    ids = prints.view(np.int64)
    near = np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, 1))
    for i, j in near.tolist():
        a, b = at[int(ids[i])], at[int(ids[j])]
        assert any(a[g] or b[g] for g in a.keys() & b.keys())
    links = simhash.near_links(df, len(prints), shard_rows=10)
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert [got.get(int(i), int(i)) for i in ids] == brute_components([int(i) for i in ids], [int(p) for p in prints])


def test_every_pair_meets_in_one_home_shard():
    prints = family(5, 900)
    rng = np.random.default_rng(0)
    nodes = simhash.shard_tree(rng.choice(prints, 300, replace=False), 20)
    assert len(nodes) > 5
    home, seen = {}, {}
    for shard, at, resident in simhash.route(nodes, prints, 2):
        for i in at.tolist():
            seen.setdefault(i, set()).add(shard)
            if resident:
                assert i not in home
                home[i] = shard
    assert len(home) == len(prints)
    near = np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, 1))
    assert len(near) > 100
    assert all(home[i] in seen[j] or home[j] in seen[i] for i, j in near.tolist())


def test_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 300)], "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 500: 300}


def test_documents_end_to_end(spark, frame):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 6
    rows = [(7, base, 1), (3, base, 2), (9, base.upper(), 3), (None, base, 4), (20, "", 5), (21, None, 6), (22, " \n", 7),
            (30, "quite another text with its own words in it", 8), (30, "quite another text with its own words in it", 9),
            (None, "nameless words only here", 10), (None, "nameless words only here", 11)]
    docs = frame(rows, "doc_id int, text string, fingerprint int")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(docs).collect() if r["doc_id"] or r["component_id"])
    prints = [brute_print(t) for _, t, _ in rows]
    want = brute_components([i for i, _, _ in rows], prints)
    assert got == sorted((i or -1, w) for (i, _, _), w in zip(rows, want) if i or w)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 3, 20, 30]


def test_empty_table(spark, frame):
    docs = frame([], "doc_id int, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.deduplicate(docs).collect() == []


def test_one_id_on_several_texts_keeps_a_row_of_every_group(spark, frame):
    a, b, c = (f"text {x} with a number of words of its own {x * 9}" for x in "abc")
    kept = lambda rows: sorted((r["doc_id"], r["text"]) for r in simhash.deduplicate(frame(rows, "doc_id int, text string, f int")).collect())
    assert kept([(5, a, 0), (5, b, 0), (3, b.upper(), 0)]) == [(3, b.upper()), (5, a)]
    assert kept([(1, a, 0), (1, b, 0), (1, b, 0), (2, a, 0), (2, b, 0), (2, c, 0), (9, c, 0)]) == [(1, a), (1, b), (2, c)]


def dealt(spark, monkeypatch, links, step=7):
    """Components of links that stand on several tasks, and the tables written for them."""
    names = []
    monkeypatch.setattr(simhash, "written", lambda df, name, write=simhash.written: names.append(name) or write(df, name))
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "9", "128m")):
            spark.conf.set(k, v)
        df = spark.createDataFrame(links, "u bigint, v bigint").repartition(step)
        return {r["node"]: r["root"] for r in simhash.components(df).collect()}, names
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def least_nodes(links):
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in links:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {x: find(x) for x in root}


@pytest.mark.parametrize("link_rows", [simhash.LINK_ROWS, 20])
def test_components_of_links_on_several_tasks(spark, monkeypatch, link_rows):
    """A large, dense component ends after few tables (13 before tasks made stars of their links)."""
    monkeypatch.setattr(simhash, "LINK_ROWS", link_rows)
    rng = random.Random(11)
    order = rng.sample(range(-500, 500), 1000)
    chain = list(zip(order[:300], order[1:301]))
    dense = [(rng.choice(order[400:600]), rng.choice(order[400:600])) for _ in range(1500)]
    hub = [(order[700], x) for x in order[701:950]]
    links = chain + dense + hub + [(5, 5)]
    got, names = dealt(spark, monkeypatch, links)
    want = least_nodes([(u, v) for u, v in links if u != v])
    assert got == want
    if link_rows > 20:
        names = dealt(spark, monkeypatch, dense)[1]
        assert len(names) <= 5, names
