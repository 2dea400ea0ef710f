"""Profile numeric files as they arrive.

Each new file is one job whose id is its path below the input folder, with
extension.  Every micro-batch runs the batch operator (:func:`job_results`)
over the batch's files and writes the records as the run ``epoch-<number>``,
so a micro-batch replayed after a failure rewrites its own run instead of
duplicating it (the streaming checkpoint records which files were done).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from numprof.functions.columns import parse_double
from numprof.operators.results import job_results
from numprof.sinks.results import write_results
from numprof.sources.files import VALUE_SCHEMA


def job_id_from_path(path: Column, input_dir: str) -> Column:
    """Decoded path of a file below ``input_dir`` (its base name if the input
    folder is not part of it), with extension, so distinct files are distinct jobs."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", input_dir).rstrip("/") + "/"
    below = F.when(F.instr(plain, folder) > 0, F.substring_index(plain, folder, -1))
    return F.coalesce(below, F.regexp_extract(plain, r"([^/]+)$", 1))


def _stream(spark: SparkSession, input_dir: str, kind: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    if kind == "dataframe":
        rows = (reader.schema(VALUE_SCHEMA).option("header", "false")
                .option("mode", "PERMISSIVE").csv(input_dir))
    elif kind == "rdd":
        lines = reader.text(input_dir)
        rows = lines.select(parse_double("value", strict=True).alias("value"))
    else:
        raise ValueError("kind must be 'dataframe' or 'rdd'")
    return rows.withColumn("job_id", job_id_from_path(F.col("_metadata.file_path"), input_dir))


def profile_files_stream(spark: SparkSession, input_dir: str, output_root: str,
                         checkpoint_location: str, kind: str = "dataframe",
                         available_now: bool = False,
                         processing_time: str | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a streaming query that profiles every file arriving in
    ``input_dir`` and writes one result record per file below
    ``output_root`` (engine ``spark_dataframe`` or ``spark_rdd``).

    ``available_now=True`` processes what is there and stops.
    ``max_files_per_trigger`` bounds each micro-batch, so a backlog of
    files is worked off in batches of bounded size.  A restart with the same
    ``checkpoint_location`` goes on where the last run ended.
    """
    engine = "spark_dataframe" if kind == "dataframe" else "spark_rdd"
    # Runs of another checkpoint have other names: epochs start anew there.
    name = hashlib.md5(checkpoint_location.encode()).hexdigest()[:8]

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        rec = job_results(batch, "value", job_col="job_id", kind=kind)
        write_results(rec, output_root, engine, per_job_files=True, run_id=f"epoch-{name}-{epoch_id:010d}")

    writer = _stream(spark, input_dir, kind, max_files_per_trigger).writeStream.foreachBatch(run_batch) \
        .option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
