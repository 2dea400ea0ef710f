"""The Merkle manifest against a tree built in memory, level by level."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from numprof.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, pos int, node string, leaf string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, text=0):
    values = (r[0], r[3], r[2], r[4], r[1] if text == 0 else text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(hs):
    out = [hs]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, tampered=lambda r: False):
    """Per row: (id, leaf, subroot, root, proof digest, folded root, verified), in any order."""
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources]) if sources else None
    out = []
    for n, s in enumerate(sources):
        for p, (_, _, h, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            folded, sib = leaf_of(r, lower(r[1])) if tampered(r) else h, ""
            for tree, at in ((trees[s], p), (top, n)):
                for level in tree[:-1]:
                    run = level[at // 16 * 16:at // 16 * 16 + 16]
                    left, right = "".join(run[:at % 16]), "".join(run[at % 16 + 1:])
                    sib, folded, at = sib + left + right, digest(left + folded + right), at // 16
            out.append((r[0], h, trees[s][-1][0], top[-1][0], digest(sib), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proven(spark, rows, changed=None):
    m = merkle.manifest(spark.createDataFrame([(*r, 1, "n", "l") for r in rows], SCHEMA), changed=changed)
    out = merkle.proofs(m).select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, out.collect()), key=str)


def docs(n, source):
    return [(i, f"Text {i} é", "en", source, i % 7) for i in range(n)]


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [257, 1, 33], [5] * 18])
def test_tree_shapes(spark, sizes):
    rows = [r for k, n in enumerate(sizes) for r in docs(n, f"s{k}")]
    got = proven(spark, rows)
    assert got == brute(rows) and all(r[-1] for r in got)


def test_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (3, "A", None, None, 1), (3, "A", None, None, 1), (3, "B", "en", None, 1),
            (4, "", "en", "", 0), (5, "x" * 100_000, "en", "ü", 9), (6, None, "en", "z", 9)] + docs(20, None)
    assert proven(spark, rows) == brute(rows)


def test_tampering_is_found(spark):
    rows = docs(40, "a") + [(100 + i, t, "en", "b", 1) for i, t in enumerate(["lower", "UPPER", None, ""])]
    even = F.col("doc_id") % 2 == 0
    got = proven(spark, rows, (even, "text", merkle.ascii_lower(F.col("text"))))
    want = brute(rows, lambda r: r[0] % 2 == 0)
    assert got == want
    # Rows that lower-casing does not change still verify.
    assert {r[0] for r in got if r[-1]} == {i for i in range(1, 40, 2)} | {100, 101, 102, 103}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    m = merkle.manifest(df)
    assert m.root is None and merkle.proofs(m).count() == 0


def test_jump_doubles_the_distance(spark):
    chain = [(f"n{i}", f"n{i + 1}", [(str(i), "")]) for i in range(11)]
    nodes = spark.createDataFrame(chain, "node string, anc string, seg array<struct<l:string,r:string>>")
    got = {r.node: [s.l for s in r.seg] for r in merkle.jump(nodes).collect()}
    assert got == {f"n{i}": [str(k) for k in range(i, 11)] for i in range(11)}


def test_places_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FILE_ROWS", 10)
    rows = docs(300, "a") + docs(30, "b")
    assert proven(spark, rows) == brute(rows)
