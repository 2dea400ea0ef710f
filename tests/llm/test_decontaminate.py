"""Window hits against direct search."""

import hashlib
import random
import re

import pytest

from numprof.llm import decontaminate
from numprof.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items, n=10):
    words, hit, found = brute_words(text), set(), set()
    for item, t in items:
        w = brute_words(t)
        k = min(n, len(w))
        windows = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    return words, hit, found


LONG = "Alpha beta, gamma! delta epsilon zeta eta theta iota kappa lambda mu nu xi"
ITEMS = [(1, LONG), (10, LONG.upper()), (2, "short item, five words"), (3, ""), (4, None), (None, "nameless item here"), (5, "été 日本 x1"), (6, "..."),
         (7, " ".join(f"w{k % 5}" for k in range(25)))]
DOCS = [LONG, "pre " + LONG.replace(" ", "--") + " post", " ".join(LONG.split()[:9]), " ".join(LONG.split()[3:13]), None, "", "...",
        "SHORT item five\nwords short item five words", "nameless ITEM here", "ÉTÉ 日本 x1", "été 日本 X1 été", " ".join(f"w{k % 5}" for k in range(60)),
        "x " * 30_000 + LONG + " y" * 30_000, "alpha beta gamma delta epsilon zeta eta theta iota KAPPA\x85", "short item", LONG + " " + LONG]


@pytest.mark.parametrize("max_windows", [1_000_000, 30])
def test_contamination_matches_brute_force(spark, frame, max_windows):
    docs = frame([(k, t, "x") for k, t in enumerate(DOCS)] + [(None, LONG, "x")], "doc_id int, text string, n_words string")
    bench = frame(ITEMS, "item_id int, text string")
    got = {r["doc_id"]: r for r in dc.contamination(docs, bench, max_windows=max_windows).collect()}
    for k, t in [*enumerate(DOCS), (None, LONG)]:
        words, hit, found = brute_hits(t, ITEMS)
        r = got[k]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(words), len(hit), len(found), bool(hit)), t
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert sorted(x for s, e in zip(r["spans"][::2], r["spans"][1::2]) for x in range(s, e)) == sorted(hit)


def test_random_texts(spark, frame):
    r = random.Random(5)
    words = ["a", "b", "c"]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(1, 14)))) for k in range(6)] + [(9, " ".join("ab" for _ in range(12)))]
    windows = dc.WindowSet([(str(i), t) for i, t in items], 4)
    texts = [" ".join(r.choice(words + ["ab", "zz"]) for _ in range(r.randint(0, 60))) for _ in range(200)]
    for t, (spans, found) in zip(texts, dc.find(windows, [dc.words_of(t) for t in texts])):
        _, hit, want = brute_hits(t, items, 4)
        assert {x for s, e in spans for x in range(s, e)} == hit and found == want


def test_removal(spark, frame):
    docs = frame([(k, t, 1) for k, t in enumerate(DOCS)], "doc_id int, text string, __count int")
    bench = frame(ITEMS, "item_id int, text string")
    clean = [k for k, t in enumerate(DOCS) if not brute_hits(t, ITEMS)[1]]
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == clean
    cut = {r["doc_id"]: r["text"] for r in dc.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[1] == "pre  post" and cut[8] == "" and cut[12] == "x " * 30_000 + " y" * 30_000
    assert all(cut[k] == DOCS[k] for k in clean)
    with pytest.raises(ValueError):
        dc.decontaminate(docs, bench, remove="words")


def test_empty_tables(spark, frame):
    docs, bench = frame([(1, LONG)], "doc_id int, text string"), frame(ITEMS, "item_id int, text string")
    assert dc.contamination(docs.limit(0), bench).collect() == []
    assert dc.contamination(docs, bench.limit(0)).first()["n_hit"] == 0
    assert dc.decontaminate(docs, bench.limit(0)).count() == 1


def test_a_long_item_is_cut_without_losing_a_window(spark, frame):
    words = [f"w{k}" for k in range(200)]
    bench = frame([("long", " ".join(words)), ("short", "just a few words")], "item_id string, text string")
    blocks = list(dc._blocks(bench, "item_id", "text", 30, 10))
    assert max(sum(len(dc.words_of(t)) for _, t in b) for b in blocks) <= 30
    windows = {tuple(dc.words_of(t)[k:k + 10]) for b in blocks for i, t in b if i == "long" for k in range(len(dc.words_of(t)) - 9)}
    assert windows == {tuple(w.encode() for w in words[k:k + 10]) for k in range(191)}
    docs = frame([(1, " ".join(["x", *words[15:45], "y"])), (2, " ".join(words[3:12]))], "doc_id int, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in dc.contamination(docs, bench, max_windows=60).collect()}
    assert got == {1: (30, ["long"]), 2: (0, [])}


def test_a_full_block_is_bounded_in_bytes():
    import pickle
    n = decontaminate.MAX_WINDOWS
    windows = decontaminate.WindowSet([("one", " ".join(f"word{k:07d}" for k in range(n)))])
    assert len(windows.by_length[10][1]) == n - 9 and len(pickle.dumps(windows)) < 64 << 20
    docs = [decontaminate.words_of(" ".join(f"word{k:07d}" for k in range(a, a + 12))) for a in (0, 5000, n - 12)]
    assert decontaminate.find(windows, docs) == [([(0, 12)], {"one"})] * 3


def test_many_blocks_scan_the_documents_once(spark, frame):
    items = [(f"i{k}", " ".join(f"w{k}x{j}" for j in range(14))) for k in range(30)] + [("long", " ".join(f"z{j}" for j in range(90)))]
    rows = [(k, f"start {items[k % 31][1]} end", "x") for k in range(62)] + [(99, None, "x")]
    docs, bench = frame(rows, "doc_id bigint, text string, spans string"), frame(items, "item_id string, text string")
    key = lambda df: sorted(map(str, df.collect()))
    one = decontaminate.contamination(docs, bench)
    many = decontaminate.contamination(docs, bench, max_windows=40)
    assert key(many) == key(one) and many.filter("contaminated").count() == 62
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
