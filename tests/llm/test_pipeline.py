"""Every pipeline stage against a brute-force version of its decision."""

import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from numprof.llm import queries, rules, simhash
from test_mixing import brute_mix
from test_decontaminate import brute_hits
from test_rules import brute_rules
from test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, each run on the reread rows of the one before."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"file://{folder}/{k}")
        docs = spark.read.parquet(f"file://{folder}/{k}")
        out.append(docs.toPandas())
    return [pq.read_table(f"{SF}/documents.parquet").to_pandas(), *out]


def test_columns(stages):
    for rows in stages[1:-1]:
        assert list(rows.columns) == list(stages[0].columns)
    assert list(stages[-1].columns) == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_quality_rules(stages):
    want = [r.doc_id for r in stages[0].itertuples() if brute_rules(r.text)["fail_bits"] == 0]
    assert sorted(stages[1]["doc_id"]) == sorted(want) and 0 < len(want) < len(stages[0])


def test_near_duplicates(stages):
    rows = stages[1]
    ids = rows["doc_id"].tolist()
    first = brute_components(ids, [brute_print(t) for t in rows["text"]])
    assert sorted(stages[2]["doc_id"]) == sorted(i for i, f in zip(ids, first) if i == f)


def test_decontamination(stages):
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    items = list(zip(bench["item_id"], bench["text"]))
    want = [r.doc_id for r in stages[2].itertuples() if not brute_hits(r.text, items)[1]]
    assert sorted(stages[3]["doc_id"]) == sorted(want)


def test_mixing(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].itertuples()]
    want = [i for (i, _, _), b in zip(rows, brute_mix(rows)) for _ in range(b["times"])]
    assert sorted(stages[4]["doc_id"]) == sorted(want) and len(want) != len(set(want))


def test_tokens(stages):
    import public_tokenizers
    tok, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in stages[4].sort_values("doc_id").itertuples():
        ids = tok.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages[5].itertuples(index=False))) == want


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas()
    key = ["doc_id", "start"]
    assert got.sort_values(key).reset_index(drop=True).equals(stages[-1].sort_values(key).reset_index(drop=True))


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered(spark):
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert rules.mask("v2") == 63 and simhash.MAX_BITS == 2
