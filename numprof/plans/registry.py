"""Registered queries: a Spark builder and, where SQL can say it, the
equivalent DuckDB SQL over the same parquet tables.

Every builder takes ``(spark, sf_dir)`` and reads whole tables.  Floats are
rounded to 6 places on both sides so that differences in the order of
floating-point addition cannot change a value hash.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprof.functions.columns import round_all
from numprof.functions.fixed import LARGE_RECORDS
from numprof.operators.arrays import array_stats, standardize_arrays, standardize_arrays_long
from numprof.operators.categories import band_stats
from numprof.operators.jobs import (
    analyze_flat, analyze_jobs, chart_series, nested_results, recommendations, results_long, speedup_report,
)
from numprof.operators.matrix import TASK_CELLS, array_rows_to_coo, matmul, matmul_tiled, tasks_for
from numprof.operators.profile import flavour_diff, profile
from numprof.operators.results import job_results, receipts
from numprof.operators.standardize import standardize
from numprof.plans import fixtures as fx
from numprof.plans.jobs import persisted, run_analysis, run_profile_job
from numprof.plans.stats_join import materialize, scratch_path
from numprof.sinks.compaction import compact_results
from numprof.sinks.results import write_results
from numprof.sources.files import (
    read_numeric_csv, read_numeric_text, read_requests, read_results, uniform_draws,
)

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, its file listing and schema resolved once per session
    (as a catalog table would be) rather than on every read."""
    per_session = _TABLES.setdefault(spark, {})
    path = f"{sf_dir}/{name}.parquet"
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


# --- global profiles -------------------------------------------------------

@register("profile_events", """
SELECT count(value) AS record_count, round(avg(value), 6) AS avg_value,
       round(max(value), 6) AS max_value, round(min(value), 6) AS min_value,
       round(stddev_samp(value), 6) AS std_dev
FROM events
""")
def profile_events(spark, d):
    """One-pass profile of events.value (sample deviation)."""
    return round_all(profile(table(spark, d, "events"), "value"))


@register("profile_events_pop", """
SELECT count(value) AS record_count, round(avg(value), 6) AS avg_value,
       round(max(value), 6) AS max_value, round(min(value), 6) AS min_value,
       round(stddev_pop(value), 6) AS std_dev, round(sum(value), 6) AS sum_value,
       round(var_pop(value), 6) AS variance
FROM events
""")
def profile_events_pop(spark, d):
    """Count, sum, mean, extremes, population variance and deviation."""
    return round_all(profile(table(spark, d, "events"), "value", ddof=0, extended=True))


# --- z-score and bands -----------------------------------------------------

_BAND_SQL = "CASE WHEN z > 1.0 THEN 'high' WHEN z < -1.0 THEN 'low' ELSE 'medium' END"


@register("zscore_categories", f"""
WITH s AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events),
z AS (SELECT value, (value - (SELECT mu FROM s)) / nullif((SELECT sd FROM s), 0) AS z FROM events)
SELECT {_BAND_SQL} AS category, count(*) AS count,
       round(avg(z), 6) AS avg_normalized, round(avg(value), 6) AS avg_original
FROM z GROUP BY 1
""")
def zscore_categories(spark, d):
    """Flagship: events.value → profile → z-score → band → per-band stats."""
    return round_all(band_stats(table(spark, d, "events").select("value"), "value"))


@register("zscore_categories_pop", f"""
WITH s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events WHERE value IS NOT NULL),
z AS (SELECT value, (value - (SELECT mu FROM s)) / nullif((SELECT sd FROM s), 0) AS z
      FROM events WHERE value IS NOT NULL)
SELECT CASE WHEN isnan(z) THEN 'medium' ELSE {_BAND_SQL} END AS category,
       count(*) AS count, round(avg(z), 6) AS average
FROM z GROUP BY 1
""")
def zscore_categories_pop(spark, d):
    """Population z-scores, NaN z in medium, band count and mean."""
    rows = table(spark, d, "events").select("value").filter(F.col("value").isNotNull())
    return round_all(band_stats(rows, "value", ddof=0, nan_is_medium=True, shape="rdd"))


@register("zscore_rows", f"""
WITH s AS (SELECT avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM customer),
z AS (SELECT c_custkey, c_acctbal, (c_acctbal - (SELECT mu FROM s)) / nullif((SELECT sd FROM s), 0) AS z
      FROM customer)
SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal, round(z, 6) AS normalized_value,
       {_BAND_SQL} AS category
FROM z
""")
def zscore_rows(spark, d):
    """P3, P5 at row level over customer balances (negative values included)."""
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return round_all(standardize(rows, "c_acctbal"))


# --- per-job forms ---------------------------------------------------------

@register("profile_by_job", """
SELECT event_type, count(value) AS record_count, round(avg(value), 6) AS avg_value,
       round(max(value), 6) AS max_value, round(min(value), 6) AS min_value,
       round(stddev_pop(value), 6) AS std_dev
FROM events GROUP BY event_type
""")
def profile_by_job(spark, d):
    """Population profile per event type, one pass."""
    return round_all(profile(table(spark, d, "events"), "value", ["event_type"], ddof=0))


@register("profile_lineitem_by_flag", """
SELECT l_returnflag, count(l_extendedprice) AS record_count,
       round(avg(l_extendedprice), 6) AS avg_value, round(max(l_extendedprice), 6) AS max_value,
       round(min(l_extendedprice), 6) AS min_value, round(stddev_samp(l_extendedprice), 6) AS std_dev
FROM lineitem GROUP BY l_returnflag
""")
def profile_lineitem_by_flag(spark, d):
    """R1 over lineitem.l_extendedprice per return flag."""
    li = table(spark, d, "lineitem")
    return round_all(profile(li, "l_extendedprice", ["l_returnflag"]))


@register("categories_by_job", f"""
WITH s AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd
           FROM events GROUP BY event_type),
z AS (SELECT e.event_type, e.value, (e.value - s.mu) / nullif(s.sd, 0) AS z
      FROM events e JOIN s ON e.event_type IS NOT DISTINCT FROM s.event_type)
SELECT event_type, {_BAND_SQL} AS category, count(*) AS count,
       round(avg(z), 6) AS avg_normalized, round(avg(value), 6) AS avg_original
FROM z GROUP BY 1, 2
""")
def categories_by_job(spark, d):
    """Per-job z-scores and band statistics (events per event type)."""
    rows = table(spark, d, "events").select("event_type", "value")
    return round_all(band_stats(rows, "value", ["event_type"]))


@register("categories_lineitem_by_flag", f"""
WITH s AS (SELECT l_returnflag, avg(l_extendedprice) AS mu, stddev_samp(l_extendedprice) AS sd
           FROM lineitem GROUP BY l_returnflag),
z AS (SELECT l.l_returnflag, l.l_extendedprice AS value, (l.l_extendedprice - s.mu) / nullif(s.sd, 0) AS z
      FROM lineitem l JOIN s ON l.l_returnflag IS NOT DISTINCT FROM s.l_returnflag)
SELECT l_returnflag, {_BAND_SQL} AS category, count(*) AS count,
       round(avg(z), 6) AS avg_normalized, round(avg(value), 6) AS avg_original
FROM z GROUP BY 1, 2
""")
def categories_lineitem_by_flag(spark, d):
    """R2, R3 over lineitem.l_extendedprice per return flag."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    return round_all(band_stats(rows, "l_extendedprice", ["l_returnflag"]))


@register("flavour_diff", """
SELECT o_orderstatus, count(o_totalprice) AS record_count,
       round(stddev_samp(o_totalprice), 6) AS std_dev_sample,
       round(stddev_pop(o_totalprice), 6) AS std_dev_population,
       round(stddev_samp(o_totalprice) - stddev_pop(o_totalprice), 6) AS std_dev_diff,
       round(var_samp(o_totalprice) / nullif(var_pop(o_totalprice), 0), 6) AS var_ratio
FROM orders GROUP BY o_orderstatus
""")
def flavour_diff_orders(spark, d):
    """Sample and population deviation side by side per order status."""
    return round_all(flavour_diff(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"]))



# --- nested job records (flattened back to rows for comparison) ------------

def _flat_list(rec: DataFrame) -> DataFrame:
    return round_all(rec.select("job_id", "record_count", "avg_value", "max_value", "min_value",
                                "std_dev", "processing_type", F.explode("category_stats").alias("c"))
                     .select("*", "c.*").drop("c"))


def _flat_map(rec: DataFrame) -> DataFrame:
    return round_all(rec.select("job_id", "record_count", "avg_value", "max_value", "min_value",
                                "processing_type", F.explode("category_stats").alias("category", "c"))
                     .select("*", "c.*").drop("c"))


_K1_SQL = f"""
, s AS (SELECT {{key}} AS job_id, count(value) AS record_count, avg(value) AS mu,
                  max(value) AS mx, min(value) AS mn, stddev_samp(value) AS sd
           FROM r GROUP BY 1),
z AS (SELECT s.job_id, r.value, (r.value - s.mu) / nullif(s.sd, 0) AS z
      FROM r JOIN s ON {{key}} IS NOT DISTINCT FROM s.job_id),
c AS (SELECT job_id, {_BAND_SQL} AS category, count(*) AS count, avg(z) AS an, avg(value) AS ao
      FROM z GROUP BY 1, 2)
SELECT s.job_id, s.record_count, round(s.mu, 6) AS avg_value, round(s.mx, 6) AS max_value,
       round(s.mn, 6) AS min_value, round(s.sd, 6) AS std_dev, 'DataFrame' AS processing_type,
       c.category, c.count, round(c.an, 6) AS avg_normalized, round(c.ao, 6) AS avg_original
FROM s JOIN c ON s.job_id IS NOT DISTINCT FROM c.job_id
"""

_K2_SQL = f"""
, s AS (SELECT {{key}} AS job_id, count(value) AS record_count, avg(value) AS mu,
                  max(value) AS mx, min(value) AS mn, stddev_pop(value) AS sd
           FROM r GROUP BY 1),
z AS (SELECT s.job_id, r.value, (r.value - s.mu) / nullif(s.sd, 0) AS z
      FROM r JOIN s ON {{key}} IS NOT DISTINCT FROM s.job_id),
c AS (SELECT job_id, CASE WHEN isnan(z) THEN 'medium' ELSE {_BAND_SQL} END AS category,
             count(*) AS count, avg(z) AS av
      FROM z GROUP BY 1, 2)
SELECT s.job_id, s.record_count, round(s.mu, 6) AS avg_value, round(s.mx, 6) AS max_value,
       round(s.mn, 6) AS min_value, 'RDD' AS processing_type,
       c.category, c.count, round(c.av, 6) AS average
FROM s JOIN c ON s.job_id IS NOT DISTINCT FROM c.job_id
"""

_LINES_SQL = f"SELECT CASE WHEN event_type = '{fx.BAD_EVENT_TYPE}' THEN NULL ELSE value END AS value FROM events"


@register("category_list", "WITH r AS (SELECT event_type, value FROM events) "
          + _K1_SQL.format(key="r.event_type").replace("SELECT r.event_type AS job_id", "SELECT event_type AS job_id"))
def category_list_q(spark, d):
    """A4, K1: DataFrame-kind job records per event type, list exploded back to rows."""
    rows = table(spark, d, "events").select("event_type", "value")
    return _flat_list(job_results(rows, "value", job_col="event_type"))


@register("category_map", "WITH r AS (SELECT event_type, value FROM events WHERE value IS NOT NULL) "
          + _K2_SQL.format(key="r.event_type"))
def category_map_q(spark, d):
    """A4, K2: RDD-kind job records per event type, map exploded back to rows."""
    rows = table(spark, d, "events").select("event_type", "value")
    return _flat_map(job_results(rows, "value", job_col="event_type", kind="rdd"))


@register("csv_scan", f"WITH r AS ({_LINES_SQL}) " + _K1_SQL.format(key="'events'"))
def csv_scan(spark, d):
    """S1 + K1: events lines (error events unparseable) read as CSV, NULL rows kept."""
    rows = read_numeric_csv(spark, fx.events_lines(spark, d))
    return _flat_list(job_results(rows, "value", job_id="events"))


@register("text_scan", f"WITH r AS (SELECT value FROM ({_LINES_SQL}) WHERE value IS NOT NULL) "
          + _K2_SQL.format(key="'events'"))
def text_scan(spark, d):
    """S2, P1, P2 + K2: the same lines read as text, bad lines dropped."""
    rows = read_numeric_text(spark, fx.events_lines(spark, d), on_malformed="drop")
    return _flat_map(job_results(rows, "value", job_id="events", kind="rdd"))


# --- arrays and matrices ---------------------------------------------------

@register("array_requests", f"""
SELECT CASE WHEN label IN ({fx.NO_DATA_LABEL}, {fx.NULL_DATA_LABEL}, {fx.BAD_TYPE_LABEL}, {fx.BAD_DATA_LABEL}) THEN 'error' ELSE 'success' END AS status,
       CASE WHEN label = {fx.NO_JOB_LABEL} THEN 'unknown' ELSE CAST(vec_id AS VARCHAR) END AS job_id,
       CASE WHEN label IN ({fx.NO_DATA_LABEL}, {fx.NULL_DATA_LABEL}, {fx.BAD_TYPE_LABEL}, {fx.BAD_DATA_LABEL}) THEN NULL
            ELSE CAST(len(embedding) AS INTEGER) END AS processed_count,
       CASE WHEN label IN ({fx.NO_DATA_LABEL}, {fx.NULL_DATA_LABEL}, {fx.BAD_TYPE_LABEL}, {fx.BAD_DATA_LABEL}) THEN NULL
            ELSE 'results/engine=gpu_processed/run_id=latest/job=id-'
                 || CASE WHEN label = {fx.NO_JOB_LABEL} THEN 'unknown' ELSE CAST(vec_id AS VARCHAR) END
       END AS storage_path,
       CASE WHEN label = {fx.NO_DATA_LABEL} THEN 'No data provided'
            WHEN label IN ({fx.BAD_DATA_LABEL}, {fx.NULL_DATA_LABEL}) THEN 'Processing failed: data is not an array of numbers'
            WHEN label = {fx.BAD_TYPE_LABEL} THEN 'Processing failed: unsupported type {fx.BAD_TYPE}' END AS error,
       CASE WHEN label = {fx.NO_DATA_LABEL} THEN 400 WHEN label IN ({fx.BAD_TYPE_LABEL}, {fx.BAD_DATA_LABEL}, {fx.NULL_DATA_LABEL}) THEN 500 ELSE 200 END AS http_status
FROM embeddings
""")
def array_requests(spark, d):
    """S3, M5, K4, K5: embeddings as JSON requests (some without data, with null data or data that is no array of numbers, or with a bad type), receipts."""
    return receipts(read_requests(spark, fx.requests_file(spark, d)), "results", per_job_files=True)


@register("array_stats", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, round(list_avg(embedding), 6) AS mean,
       round(list_aggregate(embedding, 'var_pop'), 6) AS variance,
       round(list_aggregate(embedding, 'stddev_pop'), 6) AS std_dev
FROM embeddings
""")
def array_stats_q(spark, d):
    """M1, M4: size, mean, population variance and deviation of every embedding."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return round_all(array_stats(e, "embedding").drop("embedding"))


_ARRAY_Z_SQL = """
WITH e AS (SELECT vec_id, embedding, list_avg(embedding) AS mu,
                  list_aggregate(embedding, 'stddev_pop') AS sd FROM embeddings),
u AS (SELECT vec_id, mu, sd, generate_subscripts(embedding, 1) - 1 AS pos,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM e)
"""


@register("array_standardize", _ARRAY_Z_SQL + """
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round((x - mu) / nullif(sd, 0), 6) AS value FROM u
""")
def array_standardize(spark, d):
    """Every embedding standardised in place, exploded for comparison."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    out = standardize_arrays(e, "embedding", "result")
    return round_all(out.select("vec_id", F.posexplode("result").alias("pos", "value")))


@register("array_standardize_long", _ARRAY_Z_SQL + """
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x, 6) AS value,
       round((x - mu) / nullif(sd, 0), 6) AS normalized_value FROM u
""")
def array_standardize_long(spark, d):
    """M2 long form: elements as rows, per-array statistics joined back."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return round_all(standardize_arrays_long(e, ["vec_id"], "embedding"))


_GRAM_SQL = """
WITH a AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
                  CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT CAST(a1.pos AS BIGINT) AS row_id, CAST(a2.pos AS BIGINT) AS col_id, round(sum(a1.v * a2.v), 6) AS v
FROM a a1 JOIN a a2 ON a1.vec_id = a2.vec_id GROUP BY 1, 2
"""


def _gram_inputs(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return array_rows_to_coo(e, "vec_id", "embedding", transpose=True), array_rows_to_coo(e, "vec_id", "embedding")


@register("matrix_multiply", _GRAM_SQL)
def matrix_multiply(spark, d):
    """M3: Eᵀ·E over the whole embeddings table (inner dimension = vectors),
    dense, by the form that the measured density asks for."""
    a, b = _gram_inputs(spark, d)
    return round_all(matmul(a, b, block=32))


@register("matrix_multiply_sparse", """
WITH m AS (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS DOUBLE)) AS q FROM lineitem GROUP BY 1, 2)
SELECT x.l_partkey AS row_id, y.l_partkey AS col_id, round(sum(x.q * y.q), 6) AS v
FROM m x JOIN m y ON x.l_orderkey = y.l_orderkey GROUP BY 1, 2
""")
def matrix_multiply_sparse(spark, d):
    """M3: parts by parts over the orders that hold both (quantities), sparse,
    by the form that the measured density asks for."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("double").alias("q"))
    # By order and into bounded tasks: few lines share order and part, so a scan task could add up
    # next to none of its rows but would hold them all; counting by order then needs no other shuffle.
    li = (rows.repartition(tasks_for(rows, rows.count(), TASK_CELLS), "l_orderkey")
          .groupBy("l_orderkey", "l_partkey").agg(F.sum("q").alias("v")))
    cells = li.select(F.col("l_orderkey").alias("row_id"), F.col("l_partkey").alias("col_id"), "v")
    return round_all(matmul(cells.select(F.col("col_id").alias("row_id"), F.col("row_id").alias("col_id"), "v"), cells))


@register("matrix_multiply_tiled", _GRAM_SQL)
def matrix_multiply_tiled(spark, d):
    """M3 tiled: the same product in 32 x 32 tiles multiplied with numpy in tasks."""
    a, b = _gram_inputs(spark, d)
    return round_all(matmul_tiled(a, b, block=32))


# --- job-result analytics ----------------------------------------------------

_JOBS_CTE = f"""
WITH r AS (SELECT CAST(l_suppkey AS VARCHAR) AS job_id,
                  CAST(sum(l_quantity) AS BIGINT) // {fx.RDD_TIME_DIVISOR} AS rt,
                  CAST(sum(l_quantity) AS BIGINT) * {fx.RECORD_MULTIPLIER} AS rn
           FROM lineitem GROUP BY l_suppkey),
d AS (SELECT CAST(l_partkey AS VARCHAR) AS job_id, CAST(sum(l_quantity) AS BIGINT) AS dt
      FROM lineitem GROUP BY l_partkey),
g AS (SELECT CAST(vec_id AS VARCHAR) AS job_id, CAST(len(embedding) AS INTEGER) AS gn FROM embeddings),
j AS (SELECT job_id FROM r UNION SELECT job_id FROM d UNION SELECT job_id FROM g),
a AS (SELECT j.job_id, g.gn, g.job_id IS NOT NULL AS has_gpu, r.job_id IS NOT NULL AND d.job_id IS NOT NULL AS ok,
             coalesce(r.rt, 0) AS rt, r.rn, coalesce(d.dt, 0) AS dt
      FROM j LEFT JOIN r ON j.job_id = r.job_id LEFT JOIN d ON j.job_id = d.job_id
             LEFT JOIN g ON j.job_id = g.job_id),
f AS (SELECT job_id,
             CASE WHEN has_gpu THEN 'completed' ELSE 'failed' END AS gpu_status,
             coalesce(gn, 0) AS gpu_processed_count,
             CASE WHEN NOT ok THEN 'Missing results for comparison' END AS error,
             CASE WHEN ok THEN rt END AS rdd_time_ms,
             CASE WHEN ok THEN dt END AS dataframe_time_ms,
             CASE WHEN ok THEN (CASE WHEN dt > 0 THEN round(rt / dt, 2) ELSE 0.0 END) END AS speedup,
             CASE WHEN ok THEN (CASE WHEN dt < rt THEN 'DataFrame' ELSE 'RDD' END) END AS faster_method,
             CASE WHEN ok THEN round(abs(rt - dt) / nullif(greatest(rt, dt), 0) * 100, 1) END
                 AS performance_improvement_pct,
             rn AS rdd_record_count, ok, rt, dt
      FROM a)
"""


def _analysis(spark, d):
    rdd, df = fx.lineitem_results(spark, d)
    gpu = fx.embeddings_array_results(spark, d)
    return analyze_flat(results_long(rdd=rdd, df=df, gpu=gpu))


@register("job_analysis", _JOBS_CTE + """
SELECT job_id, gpu_status, gpu_processed_count, error, rdd_time_ms, dataframe_time_ms, speedup,
       faster_method, performance_improvement_pct, rdd_record_count FROM f
""")
def job_analysis(spark, d):
    """Supplier vs part quantity totals as the two kinds' times, plus array results."""
    return _analysis(spark, d).drop("recommendations", "rdd_time_raw", "dataframe_time_raw")


@register("job_recommendations", _JOBS_CTE + f"""
, s AS (SELECT job_id, ok, rdd_record_count AS rn,
               CASE WHEN dt < rt THEN 'Use DataFrame API for '
                         || CAST(round((rt - dt) / nullif(rt, 0) * 100, 1) AS VARCHAR) || '% better performance'
                    ELSE 'RDD API showed '
                         || CAST(round((dt - rt) / nullif(dt, 0) * 100, 1) AS VARCHAR)
                         || '% better performance for this dataset' END AS sentence
        FROM f)
SELECT job_id, 0 AS position, 'Unable to generate recommendations due to missing results' AS recommendation
FROM s WHERE NOT ok
UNION ALL SELECT job_id, 0, sentence FROM s WHERE ok AND sentence IS NOT NULL
UNION ALL SELECT job_id, CASE WHEN sentence IS NULL THEN 0 ELSE 1 END,
                 'Consider using more partitions for large datasets'
          FROM s WHERE ok AND coalesce(rn, 0) > {LARGE_RECORDS}
UNION ALL SELECT job_id, CASE WHEN sentence IS NULL THEN 1 ELSE 2 END,
                 'Enable adaptive query execution for better resource utilization'
          FROM s WHERE ok AND coalesce(rn, 0) > {LARGE_RECORDS}
""")
def job_recommendations(spark, d):
    """One row per recommendation."""
    return recommendations(_analysis(spark, d))


@register("chart_series", _JOBS_CTE + """
SELECT job_id, substr(job_id, 1, 8) AS job_label, 'time_comparison' AS chart, 1 AS position,
       'RDD' AS label, CAST(rt AS DOUBLE) AS value, rt <= dt AS is_winner, format('{:,}', rt) || 'ms' AS caption
FROM f WHERE ok
UNION ALL
SELECT job_id, substr(job_id, 1, 8), 'time_comparison', 2, 'DataFrame', CAST(dt AS DOUBLE), dt < rt,
       format('{:,}', dt) || 'ms'
FROM f WHERE ok
UNION ALL
SELECT job_id, substr(job_id, 1, 8), 'speedup', 1, 'Baseline', 1.0, false, NULL
FROM f WHERE ok AND speedup > 0
UNION ALL
SELECT job_id, substr(job_id, 1, 8), 'speedup', 2, faster_method, speedup, true, printf('%.2f', speedup) || 'x'
FROM f WHERE ok AND speedup > 0
""")
def chart_series_q(spark, d):
    """Chart series rows."""
    return chart_series(_analysis(spark, d))


@register("speedup_report", _JOBS_CTE + """
, h AS (SELECT job_id, rdd_time_ms, dataframe_time_ms,
               CASE WHEN dt < rt THEN 'DataFrame' ELSE 'RDD' END AS winner,
               CASE WHEN dt < rt THEN 'RDD' ELSE 'DataFrame' END AS loser,
               CASE WHEN dt < rt THEN (rt * 100) // nullif(dt, 0) ELSE (dt * 100) // nullif(rt, 0) END AS q
        FROM f WHERE ok)
SELECT job_id, rdd_time_ms, dataframe_time_ms, winner, q / 100 AS ratio,
       CAST(q // 100 AS VARCHAR) || '.' || lpad(CAST(q % 100 AS VARCHAR), 2, '0') AS ratio_text,
       winner || ' is ' || CAST(q // 100 AS VARCHAR) || '.' || lpad(CAST(q % 100 AS VARCHAR), 2, '0')
              || 'x faster than ' || loser AS message
FROM h
""")
def speedup_report_q(spark, d):
    """Symmetric, truncated speedup with the winner's sentence."""
    return speedup_report(_analysis(spark, d))


def _stored_results(spark, d) -> str:
    """Write the three result kinds below a fresh root; return the root."""
    root = scratch_path(spark, "results")
    rdd, df = fx.lineitem_results(spark, d)
    write_results(rdd, root, "spark_rdd")
    write_results(df, root, "spark_dataframe")
    write_results(fx.embeddings_array_results(spark, d), root, "gpu_processed")
    return root


@register("job_results_nested", _JOBS_CTE + """
SELECT j.job_id, r.rt AS rdd_time_ms, r.rn AS rdd_record_count, d.dt AS dataframe_time_ms,
       g.gn AS gpu_processed_count
FROM j LEFT JOIN r ON j.job_id = r.job_id LEFT JOIN d ON j.job_id = d.job_id LEFT JOIN g ON j.job_id = g.job_id
""")
def job_results_nested(spark, d):
    """J9 + S4: stored results of all three kinds read back and nested per job."""
    n = nested_results(read_results(spark, _stored_results(spark, d)))
    return n.select("job_id",
                    F.col("results.spark_rdd.processing_time_ms").alias("rdd_time_ms"),
                    F.col("results.spark_rdd.record_count").alias("rdd_record_count"),
                    F.col("results.spark_dataframe.processing_time_ms").alias("dataframe_time_ms"),
                    F.col("results.gpu_processed.processed_count").alias("gpu_processed_count"))


_K1_EVENTS_SQL = ("WITH r AS (SELECT event_type, value FROM events) "
                  + _K1_SQL.format(key="r.event_type").replace("SELECT r.event_type AS job_id",
                                                               "SELECT event_type AS job_id"))
_K2_EVENTS_SQL = ("WITH r AS (SELECT event_type, value FROM events WHERE value IS NOT NULL) "
                  + _K2_SQL.format(key="r.event_type"))


@register("result_roundtrip", f"""
SELECT job_id, 'spark_dataframe' AS engine, processing_type, record_count, avg_value, std_dev,
       category, count, avg_normalized AS category_avg, CAST(NULL AS INTEGER) AS result_size
FROM ({_K1_EVENTS_SQL}) k1
UNION ALL
SELECT job_id, 'spark_rdd', processing_type, record_count, avg_value, CAST(NULL AS DOUBLE),
       category, count, average, CAST(NULL AS INTEGER)
FROM ({_K2_EVENTS_SQL}) k2
UNION ALL
SELECT CAST(vec_id AS VARCHAR), 'gpu_processed', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
       CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
       CAST(NULL AS DOUBLE), CAST(len(embedding) AS INTEGER)
FROM embeddings
""")
def result_roundtrip(spark, d):
    """All three result kinds written to one JSON sink root and read back
    with the one results reader (each kind decoded from its raw text)."""
    root = scratch_path(spark, "roundtrip")
    rows = table(spark, d, "events").select("event_type", "value")
    write_results(job_results(rows, "value", job_col="event_type"), root, "spark_dataframe")
    write_results(job_results(rows, "value", job_col="event_type", kind="rdd"), root, "spark_rdd")
    write_results(fx.embeddings_array_results(spark, d), root, "gpu_processed")
    back = read_results(spark, root)
    base = ["job_id", "engine", "processing_type", "record_count", "avg_value", "std_dev"]
    k1 = (back.filter(F.col("engine") == "spark_dataframe")
          .select(*base, F.explode("category_list").alias("c"))
          .select(*base, "c.category", "c.count", F.col("c.avg_normalized").alias("category_avg")))
    k2 = (back.filter(F.col("engine") == "spark_rdd")
          .select(*base, F.explode("category_map").alias("category", "c"))
          .select(*base, "category", "c.count", F.col("c.average").alias("category_avg")))
    k3 = (back.filter(F.col("engine") == "gpu_processed")
          .select(*base, F.lit(None).cast("string").alias("category"), F.lit(None).cast("long").alias("count"),
                  F.lit(None).cast("double").alias("category_avg"), F.size("result").alias("result_size")))
    no_size = F.lit(None).cast("int").alias("result_size")
    return round_all(k1.select("*", no_size).unionByName(k2.select("*", no_size)).unionByName(k3))


_BATCHES_SQL = """
WITH x AS (SELECT CAST(l_suppkey AS VARCHAR) AS job_id, sum(CAST(l_quantity AS BIGINT)) AS q, count(*) AS n FROM lineitem GROUP BY l_suppkey),
e AS (SELECT unnest(['spark_rdd', 'spark_dataframe']) AS engine)
SELECT job_id, engine, CASE WHEN CAST(job_id AS BIGINT) % 5 = 0 THEN q + 1 ELSE q END AS processing_time_ms,
       CASE WHEN CAST(job_id AS BIGINT) % 5 = 0 THEN n * 2 ELSE n END AS record_count, CAST(NULL AS INTEGER) AS result_size
FROM x, e
UNION ALL SELECT CAST(vec_id AS VARCHAR), 'gpu_processed', NULL, NULL, CAST(len(embedding) AS INTEGER) FROM embeddings
"""


@register("results_two_batches", _BATCHES_SQL)
def results_two_batches(spark, d):
    """Two disjoint batches of jobs stored by every engine, the
    first one retried, then some jobs rewritten; nothing else is lost and
    the newest whole record of a job is read."""
    return _sizes(read_results(spark, _two_batches(spark, d)))


@register("results_compacted", _BATCHES_SQL)
def results_compacted(spark, d):
    """The same batches compacted to one run per engine, some jobs
    rewritten with the values they have, and compacted again: the same records, from one run."""
    root = _two_batches(spark, d)
    compact_results(spark, root)
    before = read_results(spark, root)
    for engine in ("spark_rdd", "spark_dataframe"):
        again = before.filter((F.col("engine") == engine) & (F.col("processing_time_ms") % 2 == 0)).select("job_id", "processing_time_ms", "record_count")
        write_results(again, root, engine)
    compact_results(spark, root)
    return _sizes(read_results(spark, root))


def _sizes(records: DataFrame) -> DataFrame:
    return records.select("job_id", "engine", "processing_time_ms", "record_count", F.array_size("result").alias("result_size"))


def _two_batches(spark, d) -> str:
    root = scratch_path(spark, "batches")
    totals = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("processing_time_ms"), F.count(F.lit(1)).alias("record_count"))
    totals = materialize(totals.select("k", F.col("k").cast("string").alias("job_id"), "processing_time_ms", "record_count"))
    arrays = fx.embeddings_array_results(spark, d)
    half = F.pmod(F.xxhash64("job_id"), F.lit(2)) == 0
    for run, part in (("first", half), ("second", ~half), ("first", half)):
        for engine in ("spark_rdd", "spark_dataframe"):
            write_results(totals.filter(part).drop("k"), root, engine, run_id=run)
        write_results(arrays.filter(part), root, "gpu_processed", run_id=run)
    again = totals.filter("k % 5 = 0").select("job_id", (F.col("processing_time_ms") + 1).alias("processing_time_ms"),
                                              (F.col("record_count") * 2).alias("record_count"))
    for engine in ("spark_rdd", "spark_dataframe"):
        write_results(again, root, engine, run_id="third")
    return root


@register("array_nulls", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x < 0 THEN NULL ELSE CAST(x AS DOUBLE) END) AS v FROM embeddings),
m AS (SELECT vec_id, v, list_avg(v) AS mu, list_aggregate(v, 'stddev_pop') AS sd FROM e)
SELECT vec_id, CAST(len(v) AS INTEGER) AS size, round(mu, 6) AS mean, round(sd, 6) AS std_dev,
       CAST(len(list_filter(v, lambda x: x IS NULL)) AS INTEGER) AS null_elements, round(list_max(v) / nullif(sd, 0) - mu / nullif(sd, 0), 6) AS top
FROM m
""")
def array_nulls(spark, d):
    """M1, M2: arrays with NULL elements, which moments skip and standardising keeps."""
    e = table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.when(x >= 0, x.cast("double"))).alias("v"))
    out = standardize_arrays(array_stats(e, "v"), "v", "z")
    return round_all(out.select("vec_id", "size", "mean", "std_dev",
                                F.array_size(F.filter("z", lambda x: x.isNull())).alias("null_elements"), F.array_max("z").alias("top")))


@register("job_analysis_nested", _JOBS_CTE + """
SELECT CAST(c_custkey AS VARCHAR) AS job_id, coalesce(gpu_status, 'failed') AS gpu_status,
       coalesce(gpu_processed_count, 0) AS processed_count,
       CASE WHEN coalesce(ok, false) THEN NULL ELSE 'Missing results for comparison' END AS error, rdd_time_ms, dataframe_time_ms,
       speedup, faster_method, performance_improvement_pct
FROM customer LEFT JOIN f ON f.job_id = CAST(c_custkey AS VARCHAR)
""")
def job_analysis_nested(spark, d):
    """The nested record for a given job list (customer keys), whether or not results exist."""
    rdd, df = fx.lineitem_results(spark, d)
    ids = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("job_id"))
    out = analyze_jobs(results_long(rdd=rdd, df=df, gpu=fx.embeddings_array_results(spark, d)), ids)
    return out.select("job_id", F.col("gpu_processing.status").alias("gpu_status"), "gpu_processing.processed_count", "spark_comparison.*")


@register("csv_scan_cached", ORACLE["csv_scan"])
def csv_scan_cached(spark, d):
    """As csv_scan, with the parsed input cached between its two scans."""
    with persisted(read_numeric_csv(spark, fx.events_lines(spark, d))) as rows:
        return _flat_list(materialize(job_results(rows, "value", job_id="events")))


# --- measured times and drawn values: what is fixed about them ----------------

@register("timed_profile", f"""
SELECT 'events' AS job_id, true AS timed, count(value) AS record_count, round(avg(value), 6) AS avg_value,
       round(stddev_samp(value), 6) AS std_dev FROM ({_LINES_SQL})
""")
def timed_profile(spark, d):
    """Full DataFrame-kind job over the events lines; its run time as "measured"."""
    rec = run_profile_job(spark, fx.events_lines(spark, d), "events", kind="dataframe")
    return round_all(rec.select("job_id", (F.col("processing_time_ms") >= 0).alias("timed"), "record_count", "avg_value", "std_dev"))


@register("timed_comparison", """
SELECT 'events' AS job_id, 'failed' AS gpu_status, 0 AS processed_count, true AS compared, true AS times_measured,
       true AS winner_fits, true AS speedup_fits, count(*) FILTER (event_type <> 'error') > 100000 AS size_advice FROM events
""")
def timed_comparison(spark, d):
    """The original workflow end to end: the same events lines profiled by
    both kinds (CSV reader / text reader), each timed and stored, then the
    stored results analysed (J10 + S1/S2 + K1/K2 + S4 + J1-J6)."""
    lines = fx.events_lines(spark, d)
    root = scratch_path(spark, "timed")
    run_profile_job(spark, lines, "events", kind="dataframe", output_root=root)
    run_profile_job(spark, lines, "events", kind="rdd", output_root=root)
    a = run_analysis(spark, root)
    rdd, df = F.col("spark_comparison.rdd_time_ms"), F.col("spark_comparison.dataframe_time_ms")
    return a.select(
        "job_id", F.col("gpu_processing.status").alias("gpu_status"), "gpu_processing.processed_count",
        F.col("spark_comparison.error").isNull().alias("compared"), ((rdd >= 0) & (df >= 0)).alias("times_measured"),
        (F.col("spark_comparison.faster_method") == F.when(df < rdd, "DataFrame").otherwise("RDD")).alias("winner_fits"),
        (F.col("spark_comparison.speedup") == F.when(df > 0, F.round(rdd / F.nullif(df, F.lit(0)), 2)).otherwise(0.0)).alias("speedup_fits"),
        (F.size(F.filter("recommendations", lambda r: r.startswith("Consider"))) == 1).alias("size_advice"))


@register("uniform_input", """
WITH j AS (SELECT l_suppkey, count(*) AS n, max(l_orderkey) AS seed FROM lineitem GROUP BY l_suppkey),
u AS (SELECT l_suppkey, unnest(range(n)) AS i, seed FROM j),
v AS (SELECT l_suppkey, CAST('0x' || substr(md5(seed || '|' || i), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE * 200 - 100 AS value FROM u)
SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, count(*) AS record_count, round(avg(value), 6) AS avg_value, round(max(value), 6) AS max_value,
       round(min(value), 6) AS min_value, round(stddev_samp(value), 6) AS std_dev FROM v GROUP BY l_suppkey
""")
def uniform_input(spark, d):
    """Per supplier as many uniform values in [-100, 100) as it has
    lineitems, from the seed of its last order, profiled per supplier."""
    jobs = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("bigint").alias("l_suppkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("l_orderkey").alias("seed"))
    return round_all(profile(uniform_draws(jobs, "l_suppkey", "n", "seed"), "value", keys=["l_suppkey"]))


def queries() -> dict[str, Builder]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
