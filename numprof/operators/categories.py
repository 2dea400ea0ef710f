"""Per-band statistics, long form and the two nested shapes of a job result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprof.functions.columns import band_code, band_label


def category_stats(std: DataFrame, keys=(), value: str = "value",
                   shape: str = "dataframe") -> DataFrame:
    """Group standardised rows by keys and category.

    ``shape="dataframe"``: ``count`` (all rows, NULL values included),
    ``avg_normalized``, ``avg_original``.  ``shape="rdd"``: ``count`` and
    ``average`` (mean of the normalised values).
    """
    keys = list(keys)
    if shape == "dataframe":
        aggs = [F.count(F.lit(1)).alias("count"),
                F.avg("normalized_value").alias("avg_normalized"),
                F.avg(value).alias("avg_original")]
    elif shape == "rdd":
        aggs = [F.count(F.lit(1)).alias("count"),
                F.avg("normalized_value").alias("average")]
    else:
        raise ValueError(f"unknown shape {shape!r}")
    return std.groupBy(*keys, "category").agg(*aggs)


def band_stats(df: DataFrame, value: str = "value", keys=(), ddof: int = 1,
               nan_is_medium: bool = False, shape: str = "dataframe", low: float = -1.0,
               high: float = 1.0, **standardize_options) -> DataFrame:
    """Standardise and summarise the bands in one plan (same rows as
    ``category_stats(standardize(...))``).

    The rows are grouped by a small integer band code rather than the label
    text, and the label is attached to the (at most three per key) result
    rows; the per-row label is never built.  Other keyword options go to
    :func:`~numprof.operators.standardize.standardize`.
    """
    from numprof.operators.standardize import standardize

    keys = list(keys)
    std = standardize(df, value, keys, ddof, nan_is_medium=nan_is_medium, low=low, high=high,
                      **standardize_options)
    std = std.withColumn("__band", band_code("normalized_value", low, high, nan_is_medium))
    by_code = category_stats(std.drop("category").withColumnRenamed("__band", "category"),
                             keys, value, shape)
    return by_code.withColumn("category", band_label("category"))


def category_list(long: DataFrame, keys=()) -> DataFrame:
    """Fold long-form rows (dataframe shape) into ``category_stats``:
    an array of structs sorted by category.  At most three entries per key."""
    entry = F.struct("category", "count", "avg_normalized", "avg_original")
    return long.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("category_stats"))


def category_map(long: DataFrame, keys=()) -> DataFrame:
    """Fold long-form rows (rdd shape) into ``category_stats``:
    a map category -> struct(count, average)."""
    entry = F.struct(F.col("category"), F.struct("count", "average"))
    return long.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("category_stats"))
