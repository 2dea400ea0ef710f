"""Inputs derived from the given tables for the registered queries.

Every derivation keeps all rows of its source table; which rows become
"bad" input is decided by a data attribute, never by sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprof.functions.fixed import NORMALIZE
from numprof.operators.results import array_results
from numprof.plans.stats_join import scratch_path
from numprof.sinks.results import write_lines

# Fixed values of the derivations (mirrored in the oracle SQL).
BAD_EVENT_TYPE = "error"          # events of this type become unparseable lines
RDD_TIME_DIVISOR = 16             # supplier quantity total // 16 = RDD "time"
RECORD_MULTIPLIER = 7             # supplier quantity total * 7 = record_count
NO_DATA_LABEL = 8                 # embeddings with this label: request without data
BAD_TYPE_LABEL = 9                # ... with this label: unsupported type
NULL_DATA_LABEL = 4               # ... with this label: an explicit null as data
NO_TYPE_LABEL = 6                 # ... with this label: type omitted (default)
BAD_DATA_LABEL = 5                # ... with this label: an array that holds a text
NO_JOB_LABEL = 7                  # ... with this label: job id omitted (default)
BAD_TYPE = "histogram"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from numprof.plans.registry import table
    return table(spark, sf_dir, name)


def events_lines(spark: SparkSession, sf_dir: str) -> str:
    """events.value as text lines, error events as their type text; returns the path."""
    ev = _table(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == BAD_EVENT_TYPE, F.col("event_type")) \
            .otherwise(F.col("value").cast("string"))
    path = scratch_path(spark, "events-lines")
    write_lines(ev.select(line.alias("line")), "line", path)
    return path


def requests_from_embeddings(spark: SparkSession, sf_dir: str, keep_label: bool = False) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    lab = F.col("label")
    return e.select(
        F.when(lab != NO_JOB_LABEL, F.col("vec_id").cast("string")).alias("job_id"),
        F.when(lab == BAD_TYPE_LABEL, F.lit(BAD_TYPE))
         .when(lab != NO_TYPE_LABEL, F.lit(NORMALIZE)).alias("type"),
        F.when(lab != NO_DATA_LABEL, F.col("embedding").cast("array<double>")).alias("data"),
        *["label"] * keep_label)


def requests_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "requests")
    req = requests_from_embeddings(spark, sf_dir, keep_label=True)
    texts = F.concat(F.slice(F.col("data").cast("array<string>"), 1, 1), F.array(F.lit("abc")))
    good = req.filter(~F.col("label").isin(BAD_DATA_LABEL, NULL_DATA_LABEL))
    bad, null = req.filter(F.col("label") == BAD_DATA_LABEL), req.filter(F.col("label") == NULL_DATA_LABEL)
    good.drop("label").write.mode("overwrite").json(path)
    bad.select("job_id", "type", texts.alias("data")).write.mode("append").json(path)
    null.select("job_id", "type", F.lit(None).cast("string").alias("data")).write.mode("append").option("ignoreNullFields", "false").json(path)
    return path


def lineitem_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two result tables from lineitem quantities: the RDD kind per
    supplier and the DataFrame kind per part (ids overlap partially)."""
    li = _table(spark, sf_dir, "lineitem")
    total = F.sum("l_quantity").cast("long")
    rdd = li.groupBy("l_suppkey").agg(
        F.col("l_suppkey").cast("string").alias("job_id"),
        F.expr(f"CAST(sum(l_quantity) AS BIGINT) div {RDD_TIME_DIVISOR}").alias("processing_time_ms"),
        (total * RECORD_MULTIPLIER).alias("record_count")).drop("l_suppkey")
    df = li.groupBy("l_partkey").agg(
        F.col("l_partkey").cast("string").alias("job_id"),
        total.alias("processing_time_ms")).drop("l_partkey")
    return rdd, df


def embeddings_array_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    req = e.select(F.col("vec_id").cast("string").alias("job_id"), F.lit(NORMALIZE).alias("type"),
                   F.col("embedding").cast("array<double>").alias("data"))
    return array_results(req)
