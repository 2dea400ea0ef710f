"""Rule ledger against a direct implementation; policies and ablations."""

import re

import pyarrow.parquet as pq
import pytest

from numprof.llm import queries, rules

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_rules(text):
    t = text or ""
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in wins:
        count[w] = count.get(w, 0) + 1
    covered = {j for i, w in enumerate(wins) if count[w] > 1 for j in (i, i + 1, i + 2)}
    m = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    n, caps = len(words), sum("A" <= c <= "Z" for c in t)
    failed = [n < 50, 100 * len(covered) > 50 * n, 10 * m["n_symbols"] > n, m["word_chars"] < 2 * n or m["word_chars"] > 15 * n,
              2 * m["n_dup_lines"] > len(lines), 100 * caps > 40 * m["word_chars"]]
    bits = sum(1 << b for b, f in enumerate(failed) if f)
    return m | {"base_failed": bool(bits & 3), "kept": bits == 0, "fail_bits": bits}


TEXTS = [None, "", " \t\r\n", "one", "a b", "a b c", "a b c a b c", "x x x x x", "w " * 60, "line one\nline one\n\n \nline one\nother",
         "a\x0bb\x0cc\x1cd\xa0e é日本 🙂", "THE CAT " * 40, "a|b <c> ### " * 30, "word%d " * 3, "\n".join(f"line {k % 7} here" for k in range(50)),
         " ".join(f"w{k}" for k in range(30_000)), " ".join(f"w{k % 4000}" for k in range(30_000)), "z" * 400_000]


def test_ledger_matches_brute_force(spark, frame):
    rows = [(k, t, "clash") for k, t in enumerate(TEXTS)] + [(None, "a b c a b c", "clash"), (3, "one", "clash")]
    docs = frame(rows, "doc_id int, text string, n_words string")
    got = rules.apply_policy(rules.rule_ledger(docs)).collect()
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        want = brute_rules(t)
        assert {k: r[k] for k in want} == want and r["doc_id"] == i


def test_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    for r in queries.op4_quality_rules(spark, SF).collect():
        want = brute_rules(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want


def test_filter_keeps_columns_and_agrees_with_the_ledger(spark, frame):
    docs = frame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id int, text string, fail_bits string")
    kept = rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, t in enumerate(TEXTS) if brute_rules(t)["kept"]]
    assert rules.quality_filter(docs.limit(0)).collect() == [] and rules.rule_ledger(docs.limit(0)).collect() == []


def test_policies_and_ablations(spark, frame):
    ledger = rules.rule_ledger(frame(list(enumerate(TEXTS)), "doc_id int, text string"))
    bits = [brute_rules(t)["fail_bits"] for t in TEXTS]
    for policy in rules.POLICIES:
        mask = rules.mask(policy)
        got = {r["rule"]: r for r in rules.ablations(ledger, policy).collect()}
        assert set(got) == set(rules.POLICIES[policy])
        for rule, r in got.items():
            bit = 1 << rules.RULES[rule]
            assert (r["failing"], r["only_this"], r["kept_without"]) == (
                sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits), sum(b & mask & ~bit == 0 for b in bits))
    assert [r["kept"] for r in rules.apply_policy(ledger, "base").orderBy("doc_id").collect()] == [b & 3 == 0 for b in bits]


def test_stored_ledger_serves_policies_and_ablations(spark, frame):
    docs = frame([(k, t, "x") for k, t in enumerate(TEXTS)] + [(None, "one", "x"), (3, "one", "x")], "doc_id int, text string, policy string")
    stored = rules.stored_ledger(docs)
    assert "parquet" in stored.inputFiles()[0] and sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, rules.rule_ledger(docs).collect()), key=str)
    report = rules.ablation_report(stored)
    assert "split(" not in report._jdf.queryExecution().executedPlan().toString()
    got = {(r["policy"], r["rule"]): tuple(r)[2:] for r in report.collect()}
    assert got == {(p, r["rule"]): tuple(r)[1:] for p in rules.POLICIES for r in rules.ablations(stored, p).collect()}
    assert rules.ablation_report(rules.stored_ledger(docs.limit(0))).collect() == []


def test_plan_is_native_and_keeps_its_projections(spark, frame):
    plan = rules.rule_ledger(frame(list(enumerate(TEXTS[:4])), "doc_id int, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    # The word array is a column of its own: its split is in the plan once.
    assert plan.count("split(") == 2


@pytest.mark.parametrize("policy", ["base", "v1", "v2"])
def test_clean_documents_are_kept(spark, policy):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    out = rules.apply_policy(rules.rule_ledger(queries.table(spark, "/root/testdata/sf0.01", "documents")), policy).collect()
    clean = [r for r in out if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) == len(clean)
