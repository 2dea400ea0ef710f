"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from numprof.plans.stats_join import scratch_path

#: Runs of anything but ASCII white space: the words of most operators.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and
    read it back: cuts the lineage, survives the loss of executors, and gives
    the planner a known size (so only small tables are broadcast)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder."""
    return scratch_path(spark, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def training_row(id_col: str, modulus: int, held_out: int) -> Column:
    """Whether crc32 of the id as text, modulo ``modulus``, differs from
    ``held_out``; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus != held_out, F.lit(False))


def one_label(labels: DataFrame) -> DataFrame:
    """(l, y) with one row per ``l``: the label 0 or 1 of most of its rows, 1 in a tie."""
    return labels.groupBy("l").agg((F.avg("y") >= 0.5).cast("double").alias("y"))


def bounded(rows: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` of the rows, drawn by a hash of them, if there are more."""
    n = rows.count()
    return rows if n <= wanted else rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 30)) < int(wanted / n * (1 << 30)))


def basename(path: str) -> str:
    return os.path.basename(path.rstrip("/"))


def released(step: Callable) -> Callable:
    """A mapInArrow step that gives its freed memory back to the machine when
    its task ends.  Spark keeps Python workers for later tasks; what Arrow's
    pool and the C library hold back would count against the next stage."""

    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not every C library has it
                pass

    return run
