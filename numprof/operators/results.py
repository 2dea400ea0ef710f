"""Job-result records: the DataFrame kind (category list), the RDD kind
(category map), the array kind, and request receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprof.functions.fixed import DATAFRAME_NAME, GPU, RDD_NAME, SUCCESS, UNKNOWN_JOB
from numprof.operators.arrays import process_requests
from numprof.operators.categories import band_stats, category_list, category_map
from numprof.operators.profile import profile
from numprof.plans.stats_join import attach_by_keys, materialize, measure, with_scalar_row
from numprof.sinks.results import job_path


def _job_id(job_col: str | None, job_id: str | None) -> Column:
    if job_col is not None:
        return F.col(job_col).cast("string")
    return F.lit(job_id if job_id is not None else UNKNOWN_JOB)


def job_results(df: DataFrame, value: str = "value", job_col: str | None = None,
                job_id: str | None = None, kind: str = "dataframe",
                processing_time_ms: int | None = None, broadcast: str = "auto") -> DataFrame:
    """One result record per job.

    ``kind="dataframe"``: sample deviation, NULL rows kept and counted in the
    bands, ``category_stats`` a sorted list of structs.  ``kind="rdd"``:
    population deviation, NULL rows dropped, NaN z in the medium band,
    ``category_stats`` a map; ``std_dev`` is NULL (not part of that kind).
    Jobs are the values of ``job_col`` (NULL is a job of its own) or, without
    it, the whole input is the single job ``job_id``.  Statistics are
    materialised once and reused for the z-scores and the record;
    ``broadcast`` is as in :func:`numprof.plans.stats_join.attach_by_keys`.
    """
    keys = [job_col] if job_col else []
    if kind == "rdd":
        ddof, nan_medium, shape = 0, True, "rdd"
    elif kind == "dataframe":
        ddof, nan_medium, shape = 1, False, "dataframe"
    else:
        raise ValueError("kind must be 'dataframe' or 'rdd'")
    # Aggregates skip NULL values, so a job of NULLs alone has its record too.
    stats = materialize(profile(df, value, keys, ddof))
    if kind == "rdd":
        df = df.filter(F.col(value).isNotNull())
    stats_size = measure(stats, keys) if keys and broadcast == "auto" else None
    long = band_stats(df, value, keys, ddof, nan_is_medium=nan_medium, shape=shape, stats=stats,
                      stats_size=stats_size, broadcast=broadcast)
    nested = category_list(long, keys) if shape == "dataframe" else category_map(long, keys)
    if keys:
        # ``stats`` is materialised, so it is the side whose size is checked.
        rec = attach_by_keys(nested, stats, keys, stats_size=stats_size, broadcast=broadcast)
        if kind == "rdd":
            none = F.lit(None).cast(nested.schema["category_stats"].dataType)
            rec = rec.unionByName(stats.filter("record_count = 0").withColumn("category_stats", none))
    else:
        rec = with_scalar_row(stats, nested)
    empty = (F.array() if shape == "dataframe" else F.create_map()).cast(
        nested.schema["category_stats"].dataType)
    return rec.select(
        _job_id(job_col, job_id).alias("job_id"),
        F.lit(processing_time_ms).cast("long").alias("processing_time_ms"),
        F.col("record_count"), F.col("avg_value"), F.col("max_value"), F.col("min_value"),
        (F.col("std_dev") if shape == "dataframe" else F.lit(None).cast("double")).alias("std_dev"),
        F.lit(DATAFRAME_NAME if shape == "dataframe" else RDD_NAME).alias("processing_type"),
        F.coalesce(F.col("category_stats"), empty).alias("category_stats"),
    )


def array_results(requests: DataFrame) -> DataFrame:
    """Array-kind records ``(job_id, result)`` of the successful requests."""
    done = process_requests(requests)
    return done.filter(F.col("status") == SUCCESS).select("job_id", "result")


def receipts(requests: DataFrame, storage_root: str, per_job_files: bool = False, run_id: str = "latest") -> DataFrame:
    """One receipt per request: status, job_id, processed_count,
    storage_path (success) or error and http_status (failure).

    ``storage_path`` is the folder that holds the job's array result under
    the sink layout of run ``run_id``.  The count is the length of the data:
    standardising keeps it, so no array arithmetic is done for a receipt."""
    done = process_requests(requests)
    ok = F.col("status") == SUCCESS
    path = job_path(storage_root, GPU, run_id, F.col("job_id") if per_job_files else None)
    return done.select(
        "status", "job_id",
        F.when(ok, F.array_size("data")).alias("processed_count"),
        F.when(ok, path).alias("storage_path"),
        "error", "http_status")
