"""Job-result analytics: assemble the three results of each job, compare
run times, recommend, and lay out chart series.

Input is a long results table ``(job_id, engine, processing_time_ms,
record_count, result)`` such as :func:`numprof.sources.read_results`
returns (or :func:`results_long` builds).  The three results of a job are
brought together by one grouped aggregate (a pivot), not by two outer
joins: one shuffle of one row per stored result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprof.functions.fixed import (
    BASELINE, COMPLETED, DATAFRAME, DATAFRAME_ADVICE, DATAFRAME_NAME, FAILED, GPU, LABEL_CHARS,
    LARGE_ADVICE, LARGE_RECORDS, MISSING_ADVICE, MISSING_ERROR, RDD, RDD_ADVICE, RDD_NAME,
    SPEEDUP_CHART, TIME_CHART,
)


def results_long(rdd: DataFrame | None = None, df: DataFrame | None = None,
                 gpu: DataFrame | None = None) -> DataFrame:
    """Stack per-engine result tables into the long results shape."""
    parts = []
    for frame, engine in ((gpu, GPU), (rdd, RDD), (df, DATAFRAME)):
        if frame is None:
            continue
        cols = set(frame.columns)
        parts.append(frame.select(
            F.col("job_id").cast("string").alias("job_id"),
            F.lit(engine).alias("engine"),
            (F.col("processing_time_ms") if "processing_time_ms" in cols else F.lit(None))
            .cast("long").alias("processing_time_ms"),
            (F.col("record_count") if "record_count" in cols else F.lit(None))
            .cast("long").alias("record_count"),
            (F.col("result") if "result" in cols else F.lit(None))
            .cast("array<double>").alias("result")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pick(engine: str, c: Column) -> Column:
    return F.max(F.when(F.col("engine") == F.lit(engine), c))


def _field(results: DataFrame, engine: str, name: str) -> Column:
    """A field of one whole record of the engine: of several copies the
    newest (by ``written_at``, where the results have it) or else the one with
    the longest time.  Every field is taken by that same order, so a record
    is never blended from two copies; the buffers are numbers, so this runs
    as a hash aggregate."""
    order = F.col("written_at") if "written_at" in results.columns else F.col("processing_time_ms")
    return F.max_by(F.col(name), F.when(F.col("engine") == F.lit(engine), F.coalesce(order, F.lit(-1).cast("long"))))


def _count(result: str = "result") -> Column:
    """Length of the array result; 0 for a NULL one, ANSI on or off."""
    return F.coalesce(F.array_size(result), F.lit(0))


def assemble(results: DataFrame, job_ids: DataFrame | None = None) -> DataFrame:
    """One row per job: presence flags, times and counts of each engine.

    With ``job_ids`` (a one-column ``job_id`` table) the jobs are exactly
    those, whether or not any result exists for them.
    """
    g = results.groupBy("job_id").agg(
        _pick(GPU, F.lit(True)).alias("has_gpu"),
        _pick(GPU, _count()).alias("gpu_count"),
        _pick(RDD, F.lit(True)).alias("has_rdd"),
        _field(results, RDD, "processing_time_ms").alias("rdd_time"),
        _field(results, RDD, "record_count").alias("rdd_records"),
        _pick(DATAFRAME, F.lit(True)).alias("has_df"),
        _field(results, DATAFRAME, "processing_time_ms").alias("df_time"),
    )
    if job_ids is not None:
        g = job_ids.select(F.col("job_id").cast("string")).join(g, "job_id", "left")
    return g


def _one_decimal(x: Column) -> Column:
    return F.round(x, 1).cast("string")


def _compare_columns() -> dict[str, Column]:
    missing = F.col("has_rdd").isNull() | F.col("has_df").isNull()
    rdd_t = F.coalesce(F.col("rdd_time"), F.lit(0)).cast("long")
    df_t = F.coalesce(F.col("df_time"), F.lit(0)).cast("long")
    ok = ~missing
    speedup = F.when(df_t > 0, F.round(rdd_t / F.nullif(df_t, F.lit(0)), 2)).otherwise(F.lit(0.0))
    pct = F.round(F.abs(rdd_t - df_t) / F.nullif(F.greatest(rdd_t, df_t), F.lit(0)) * 100, 1)
    df_wins = df_t < rdd_t
    sentence = (F.when(df_wins, F.concat(F.lit(DATAFRAME_ADVICE[0]),
                                         _one_decimal((rdd_t - df_t) / F.nullif(rdd_t, F.lit(0)) * 100),
                                         F.lit(DATAFRAME_ADVICE[1])))
                .otherwise(F.concat(F.lit(RDD_ADVICE[0]),
                                    _one_decimal((df_t - rdd_t) / F.nullif(df_t, F.lit(0)) * 100),
                                    F.lit(RDD_ADVICE[1]))))
    large = F.coalesce(F.col("rdd_records"), F.lit(0)) > F.lit(LARGE_RECORDS)
    advice = F.concat(
        F.filter(F.array(sentence), lambda s: s.isNotNull()),
        F.when(large, F.array(*[F.lit(s) for s in LARGE_ADVICE])).otherwise(F.array().cast("array<string>")))
    return {
        "error": F.when(missing, F.lit(MISSING_ERROR)),
        "rdd_time_ms": F.when(ok, rdd_t),
        "dataframe_time_ms": F.when(ok, df_t),
        "speedup": F.when(ok, speedup),
        "faster_method": F.when(ok, F.when(df_wins, F.lit(DATAFRAME_NAME)).otherwise(F.lit(RDD_NAME))),
        "performance_improvement_pct": F.when(ok, pct),
        "recommendations": F.when(missing, F.array(F.lit(MISSING_ADVICE))).otherwise(advice),
    }


def analyze_flat(results: DataFrame, job_ids: DataFrame | None = None) -> DataFrame:
    """Flat analysis: ``job_id, gpu_status, gpu_processed_count, error,
    rdd_time_ms, dataframe_time_ms, speedup, faster_method,
    performance_improvement_pct, rdd_record_count, rdd_time_raw,
    dataframe_time_raw, recommendations``.

    Times missing inside an existing result count as 0; the raw times keep
    them NULL.  When both times
    are 0 the percentage is NULL and there is no faster-method sentence.
    """
    a = assemble(results, job_ids)
    cmp = _compare_columns()
    return a.select(
        "job_id",
        F.when(F.col("has_gpu"), F.lit(COMPLETED)).otherwise(F.lit(FAILED)).alias("gpu_status"),
        F.coalesce(F.col("gpu_count"), F.lit(0)).alias("gpu_processed_count"),
        *[c.alias(n) for n, c in cmp.items()],
        F.col("rdd_records").alias("rdd_record_count"),
        F.col("rdd_time").alias("rdd_time_raw"),
        F.col("df_time").alias("dataframe_time_raw"),
    )


def analyze_jobs(results: DataFrame, job_ids: DataFrame | None = None) -> DataFrame:
    """Nested analysis record per job: ``job_id``, ``gpu_processing
    {status, processed_count}``, ``spark_comparison {error, rdd_time_ms,
    dataframe_time_ms, speedup, faster_method, performance_improvement_pct}``,
    ``recommendations``."""
    return nest_analysis(analyze_flat(results, job_ids))


def nest_analysis(analysis_flat: DataFrame) -> DataFrame:
    """The nested records of :func:`analyze_jobs` from the flat analysis."""
    return analysis_flat.select(
        "job_id",
        F.struct(F.col("gpu_status").alias("status"),
                 F.col("gpu_processed_count").alias("processed_count")).alias("gpu_processing"),
        F.struct("error", "rdd_time_ms", "dataframe_time_ms", "speedup", "faster_method",
                 "performance_improvement_pct").alias("spark_comparison"),
        "recommendations",
    )


def recommendations(analysis_flat: DataFrame) -> DataFrame:
    """One row per recommendation: ``job_id, position, recommendation``."""
    return analysis_flat.select("job_id", F.posexplode("recommendations").alias("position", "recommendation"))


def chart_series(analysis_flat: DataFrame) -> DataFrame:
    """Chart data as rows: ``job_id, job_label, chart, position, label,
    value, is_winner, caption``.

    ``time_comparison``: the two run times, the faster one (ties: RDD)
    flagged, captioned like ``1,234ms``.  ``speedup``: a baseline of 1 and
    the speedup under the faster method's name, captioned like ``2.50x``;
    drawn only when the speedup is above 0.  Jobs with an error have none.
    """
    ok = F.col("error").isNull()
    rdd_t, df_t = F.col("rdd_time_ms"), F.col("dataframe_time_ms")

    def item(chart, pos, label, value, winner, caption):
        return F.struct(F.lit(chart).alias("chart"), F.lit(pos).alias("position"),
                        label.alias("label"), value.cast("double").alias("value"),
                        winner.alias("is_winner"), caption.alias("caption"))

    times = F.array(
        item(TIME_CHART, 1, F.lit(RDD_NAME), rdd_t, rdd_t <= df_t,
             F.concat(F.format_number(rdd_t, 0), F.lit("ms"))),
        item(TIME_CHART, 2, F.lit(DATAFRAME_NAME), df_t, df_t < rdd_t,
             F.concat(F.format_number(df_t, 0), F.lit("ms"))))
    speed = F.array(
        item(SPEEDUP_CHART, 1, F.lit(BASELINE), F.lit(1.0), F.lit(False), F.lit(None).cast("string")),
        item(SPEEDUP_CHART, 2, F.col("faster_method"), F.col("speedup"), F.lit(True),
             F.concat(F.format_string("%.2f", F.col("speedup")), F.lit("x"))))
    empty = F.array().cast("array<struct<chart:string,position:int,label:string,value:double,"
                           "is_winner:boolean,caption:string>>")
    items = F.concat(F.when(ok, times).otherwise(empty),
                     F.when(ok & (F.col("speedup") > 0), speed).otherwise(empty))
    return (analysis_flat
            .select("job_id", F.substring("job_id", 1, LABEL_CHARS).alias("job_label"),
                    F.explode(items).alias("it"))
            .select("job_id", "job_label", "it.*"))


def speedup_report(analysis_flat: DataFrame) -> DataFrame:
    """Symmetric speedup (slower / faster, truncated to 2 places, exact
    integer arithmetic) for jobs whose two results both hold a time (a NULL
    time skips the job, as a missing result does): ``job_id, rdd_time_ms,
    dataframe_time_ms, winner, ratio, ratio_text, message``.  Ties go to
    RDD; a zero divisor gives NULL ratio and message."""
    rdd_t, df_t = F.col("rdd_time_ms"), F.col("dataframe_time_ms")
    df_wins = df_t < rdd_t
    hundredths = F.when(df_wins, F.expr("(rdd_time_ms * 100) div nullif(dataframe_time_ms, 0)")) \
                  .otherwise(F.expr("(dataframe_time_ms * 100) div nullif(rdd_time_ms, 0)"))
    text = F.concat((hundredths / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((hundredths % 100).cast("string"), 2, "0"))
    winner = F.when(df_wins, F.lit(DATAFRAME_NAME)).otherwise(F.lit(RDD_NAME))
    loser = F.when(df_wins, F.lit(RDD_NAME)).otherwise(F.lit(DATAFRAME_NAME))
    return (analysis_flat
            .filter(F.col("rdd_time_raw").isNotNull() & F.col("dataframe_time_raw").isNotNull())
            .select("job_id", "rdd_time_ms", "dataframe_time_ms",
                    winner.alias("winner"),
                    (hundredths / 100).alias("ratio"),
                    text.alias("ratio_text"),
                    F.concat(winner, F.lit(" is "), text, F.lit("x faster than "), loser).alias("message")))


def nested_results(results: DataFrame) -> DataFrame:
    """Per job ``{job_id, results: {spark_rdd, spark_dataframe, gpu_processed}}``
    with each engine's summary fields (NULL when that result is absent)."""
    numbers = ("processing_time_ms", "record_count", "avg_value", "max_value", "min_value", "std_dev")

    # One pass of number buffers; the constant name of the kind joins the
    # records afterwards.
    fields = [_field(results, e, n).alias(f"{e}_{n}") for e in (RDD, DATAFRAME) for n in numbers]
    g = results.groupBy("job_id").agg(
        _pick(RDD, F.lit(True)).alias("has_rdd"), _pick(DATAFRAME, F.lit(True)).alias("has_df"),
        _pick(GPU, _count()).alias("gpu_count"), *fields)

    def record(present: str, engine: str, name: str) -> Column:
        own = [F.col(f"{engine}_{n}").alias(n) for n in numbers]
        return F.when(F.col(present), F.struct(*own, F.lit(name).alias("processing_type"))).alias(engine)

    g = g.select("job_id", record("has_rdd", RDD, RDD_NAME), record("has_df", DATAFRAME, DATAFRAME_NAME),
                 F.when(F.col("gpu_count").isNotNull(), F.struct(F.col("gpu_count").alias("processed_count"))).alias(GPU))
    return g.select("job_id", F.struct(RDD, DATAFRAME, GPU).alias("results"))
