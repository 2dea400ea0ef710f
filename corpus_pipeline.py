"""A training-data pipeline over `documents`: quality rules, near-duplicates,
benchmark decontamination, mixing to source weights, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's rows as Parquet and gives the reread rows to the next.
All stages but the last return the columns of the documents, and pass extra
columns on.  Every stage takes an empty table to an empty one and decides
repeated rows alike (near-duplicates: one of them stays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from numprof.llm import decontaminate, mixing, queries, rules, simhash
from numprof.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy of the rule ledger keeps; those
    with a NULL or empty text go."""
    return rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash group; NULL and
    empty texts are a group, a NULL id stays only in a group without ids."""
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a word window of a benchmark item; NULL and empty
    texts have none and stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target asks for; a NULL
    source is a source of its own, a text without words counts nothing."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32; a
    NULL or empty text has its end id alone, NULL ids come first."""
    return queries.token_digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", source_mix),
    ("token-ID output", token_files),
]

#: Word fingerprints and tokenizer ids have no SQL form; tests/llm compares
#: the stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
