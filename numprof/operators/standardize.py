"""Standardise values (z-score) against their own key's statistics and band them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprof.functions.columns import band, zscore
from numprof.operators.profile import profile
from numprof.plans.stats_join import attach_by_keys, materialize


def standardize(df: DataFrame, value: str = "value", keys=(), ddof: int = 1,
                nan_is_medium: bool = False, stats: DataFrame | None = None,
                low: float = -1.0, high: float = 1.0, checkpoint: bool | None = None,
                stats_size=None, broadcast: str = "auto") -> DataFrame:
    """Add ``normalized_value`` = (x - mean) / sd and ``category``.

    Statistics are those of ``profile(df, value, keys, ddof)`` unless a
    ``stats`` table (with ``avg_value`` and ``std_dev`` per key) is given.
    The input is scanned twice in total, the minimum for a z-score.  Global
    statistics are one row and enter the row scan as a scalar subquery, so
    the rows are neither joined nor shuffled.  Per-key statistics are
    materialised by default (``checkpoint``) so their size can be measured
    before they are broadcast (else a shuffled hash join).  ``stats_size``
    is the :func:`~numprof.plans.stats_join.measure` result of a given
    ``stats`` table, if known.  ``broadcast`` (``auto``, ``always``,
    ``never``) is passed to :func:`attach_by_keys`; with ``always`` or
    ``never`` nothing is measured and, by default, nothing is materialised,
    so the whole plan stays lazy.
    """
    keys = list(keys)
    if stats is None:
        stats = profile(df, value, keys, ddof)
        if checkpoint if checkpoint is not None else (bool(keys) and broadcast == "auto"):
            stats = materialize(stats)
    s = stats.select(*keys, F.col("avg_value").alias("__mu"), F.col("std_dev").alias("__sd"))
    joined = attach_by_keys(df, s, keys, stats_size=stats_size, broadcast=broadcast)
    return (joined
            .withColumn("normalized_value", zscore(value, "__mu", "__sd"))
            .withColumn("category", band("normalized_value", low, high, nan_is_medium))
            .drop("__mu", "__sd"))
