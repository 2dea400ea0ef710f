"""Array-valued rows: per-array moments and element-wise standardisation.

Each array is one row, so the work is a per-row projection with no shuffle.
The mean and deviation of an array are computed once per row and bound as
lambda variables (:func:`~numprof.functions.columns.let`); referring to a
precomputed column from inside ``transform`` instead would let the
optimiser inline the whole aggregate into the per-element lambda (O(n²)).
Arrays too long for one row are handled by the long form, which explodes
elements into rows and joins back per-array statistics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprof.functions.columns import col_of, let, safe_div
from numprof.functions.fixed import (
    ERROR, NO_DATA_ERROR, NORMALIZE, SUCCESS, UNKNOWN_JOB, UNSUPPORTED_TYPE_ERROR, UNUSABLE_DATA_ERROR,
)
from numprof.operators.profile import profile
from numprof.plans.stats_join import attach_by_keys, materialize



def with_moments(arr: str | Column,
                 fn: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """Evaluate ``fn(values, mean, variance, std_dev)`` once per array, where
    ``values`` is the array as doubles (population flavour).  NULL elements
    are skipped, in the divisor too, as the long form skips them.  Arrays
    that are NULL or without values give NULL moments.

    The double array and each moment are bound with :func:`let`, so the
    per-element lambdas read lambda variables instead of recasting elements
    or recomputing the mean or the deviation for every element.
    """
    def body(values: Column) -> Column:
        def moments(known: Column) -> Column:
            n = F.nullif(F.array_size(known), F.lit(0)).cast("double")
            return let(
                F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x) / n,
                lambda mean: let(
                    F.aggregate(known, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n,
                    lambda var: let(F.sqrt(var), lambda sd: fn(values, mean, var, sd))))

        return let(F.array_compact(values), moments)

    return let(col_of(arr).cast("array<double>"), body)


def array_stats(df: DataFrame, arr: str = "data") -> DataFrame:
    """Add ``size``, ``mean``, ``variance`` (population) and ``std_dev``."""
    moments = with_moments(arr, lambda _, m, v, s: F.struct(m.alias("mean"), v.alias("variance"),
                                                             s.alias("std_dev")))
    return (df.withColumn("__m", moments)
              .select("*", F.array_size(arr).alias("size"), "__m.mean", "__m.variance", "__m.std_dev")
              .drop("__m"))


def standardized_array(arr: str | Column) -> Column:
    """``(x - mean) / std`` per element, order kept; NULL elements when std is 0."""
    return with_moments(arr, lambda values, m, v, s: F.transform(
        values, lambda x: safe_div(x - m, s)))


def standardize_arrays(df: DataFrame, arr: str = "data", out: str = "result") -> DataFrame:
    """Batch form: one standardised array per input row."""
    return df.withColumn(out, standardized_array(arr))


def standardize_arrays_long(df: DataFrame, ids, arr: str = "data") -> DataFrame:
    """Long form for very long arrays: ``(ids, pos, value, normalized_value)``.

    Elements are exploded into rows, per-array statistics come from one
    grouped aggregate (partial aggregation, so a huge array is spread over
    all tasks) and are attached back with a size-checked broadcast join.
    """
    ids = list(ids)
    long = df.select(*ids, F.posexplode(arr).alias("pos", "value")) \
             .withColumn("value", F.col("value").cast("double"))
    stats = materialize(profile(long, "value", ids, ddof=0))
    s = stats.select(*ids, F.col("avg_value").alias("__mu"), F.col("std_dev").alias("__sd"))
    return (attach_by_keys(long, s, ids)
            .withColumn("normalized_value", safe_div(F.col("value") - F.col("__mu"), F.col("__sd")))
            .drop("__mu", "__sd"))


def process_requests(requests: DataFrame, out: str = "result") -> DataFrame:
    """Dispatch array requests on ``type`` (default ``normalize``).

    Input columns ``job_id``, ``type``, ``data`` and, optionally, ``unusable``
    (data that was there but is not an array of numbers).  Adds ``result``
    (the processed array or NULL), ``status`` (``success`` / ``error``),
    ``error`` and ``http_status`` (200, 400 for a request without data, 500
    for unusable data or an unsupported type).  ``job_id`` defaults to
    ``unknown``.
    """
    typ = F.coalesce(F.col("type"), F.lit(NORMALIZE))
    unusable = F.col("unusable") if "unusable" in requests.columns else F.lit(False)
    missing = F.col("data").isNull()
    supported = typ == F.lit(NORMALIZE)
    return (requests
            .withColumn("job_id", F.coalesce(F.col("job_id"), F.lit(UNKNOWN_JOB)))
            .withColumn("type", typ)
            .withColumn(out, F.when(~missing & supported, standardized_array("data")))
            .withColumn("status", F.when(missing | ~supported, F.lit(ERROR)).otherwise(F.lit(SUCCESS)))
            .withColumn("error", F.when(unusable, F.lit(UNUSABLE_DATA_ERROR))
                        .when(missing, F.lit(NO_DATA_ERROR))
                        .when(~supported, F.concat(F.lit(UNSUPPORTED_TYPE_ERROR), typ)))
            .withColumn("http_status", F.when(unusable, F.lit(500)).when(missing, F.lit(400)).when(~supported, F.lit(500))
                        .otherwise(F.lit(200))))
