"""Profiles: count, mean, extremes and deviation, globally or per key.

One ``groupBy(keys).agg`` computes everything in a single pass with a
partial (map-side) aggregate, so a hot key costs one partial row per input
partition rather than a skewed task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check_ddof(ddof: int) -> None:
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 (population) or 1 (sample)")


def profile(df: DataFrame, value: str = "value", keys=(), ddof: int = 1,
            extended: bool = False) -> DataFrame:
    """One row per key (one row in total without keys, even for empty input).

    Columns: ``record_count`` (non-null values), ``avg_value``, ``max_value``,
    ``min_value``, ``std_dev`` (sample when ``ddof=1``, population when 0).
    ``extended`` adds ``sum_value`` and ``variance`` of the same flavour.
    """
    _check_ddof(ddof)
    v = F.col(value)
    aggs = [
        F.count(v).alias("record_count"),
        F.avg(v).alias("avg_value"),
        F.max(v).alias("max_value"),
        F.min(v).alias("min_value"),
    ]
    if not extended:
        std = F.stddev_samp(v) if ddof == 1 else F.stddev_pop(v)
        return df.groupBy(*keys).agg(*aggs, std.alias("std_dev"))
    # One moment buffer serves both: Spark's deviation is exactly the square
    # root of its variance, so deriving it keeps the result bit for bit.
    var = F.var_samp(v) if ddof == 1 else F.var_pop(v)
    out = df.groupBy(*keys).agg(*aggs, var.alias("variance"), F.sum(v).alias("sum_value"))
    return out.select(*keys, "record_count", "avg_value", "max_value", "min_value",
                      F.sqrt("variance").alias("std_dev"), "sum_value", "variance")


def flavour_diff(df: DataFrame, value: str = "value", keys=()) -> DataFrame:
    """Sample and population deviation side by side, in one pass.

    ``var_ratio`` is var_samp / var_pop = n / (n - 1); NULL where undefined.
    """
    v = F.col(value)
    # Two moment buffers instead of four: each deviation is the square root
    # of its variance, exactly as Spark computes it.
    out = df.groupBy(*keys).agg(
        F.count(v).alias("record_count"),
        F.var_samp(v).alias("_vs"),
        F.var_pop(v).alias("_vp"),
    )
    return (out
            .withColumn("std_dev_sample", F.sqrt("_vs"))
            .withColumn("std_dev_population", F.sqrt("_vp"))
            .withColumn("std_dev_diff", F.col("std_dev_sample") - F.col("std_dev_population"))
            .withColumn("var_ratio", F.col("_vs") / F.nullif(F.col("_vp"), F.lit(0.0)))
            .drop("_vs", "_vp"))
