"""Attach statistics back onto the rows they were computed from.

One-row (global) statistics enter the row scan as a single scalar subquery:
no join, no shuffle.  Per-key statistics are materialised in the cluster's
shared checkpoint folder (cutting lineage), measured in one cheap job, and
broadcast only when the measured size fits the broadcast threshold;
otherwise they meet the rows in a shuffled hash join built on the
statistics side, where adaptive execution splits hot keys.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session (the SparkContext's folder, else
    ``spark.checkpoint.dir``).  Only when neither is set and the master is
    local (tests) is a private folder created; on a cluster an unset folder
    is an error, since a machine-local folder would not survive the loss of
    an executor.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="numprof-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "numprof", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Eagerly compute ``df`` into the shared checkpoint folder (cuts lineage)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_threshold(spark: SparkSession) -> int:
    """Broadcast limit in bytes for a size measured at run time (0 when
    disabled): ``spark.sql.adaptive.autoBroadcastJoinThreshold`` when set,
    else ``spark.sql.autoBroadcastJoinThreshold``."""
    raw = (spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
           or spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    factor = 1
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            factor, raw = units[suffix], raw[: -len(suffix)]
            break
    return max(int(float(raw)) * factor, 0)


# Bytes of fixed-width values in Spark's row format.
_FIXED_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4,
                "long": 8, "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


class StatsSize(NamedTuple):
    """What :func:`measure` finds out about a statistics table."""
    bytes: int
    null_key_rows: int


def measure(df: DataFrame, keys=()) -> StatsSize:
    """Size of ``df`` as a broadcast relation and its number of rows with a
    NULL in any of ``keys``, in one cheap job (run it on a materialised
    table).  See :func:`table_size` for the size rule."""
    keys = list(keys)
    null_rows = (F.sum(F.when(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]), 1)
                       .otherwise(0)) if keys else F.lit(0))
    size, row = _size_and(df, [null_rows.alias("nulls")])
    return StatsSize(size, int(row["nulls"] or 0))


def table_size(df: DataFrame) -> int:
    """Size of ``df`` as rows in a broadcast relation, measured in one pass.

    Per row: a 16-byte header and an 8-byte slot per field, plus the actual
    byte length of every variable-width value (strings and binaries by
    ``octet_length``, nested values by the length of their JSON text).
    Run it on a materialised table: it is one cheap job over it.
    """
    return _size_and(df, [])[0]


def _size_and(df: DataFrame, extra: list):
    fixed = 16
    var = []
    for f in df.schema.fields:
        name = f.dataType.typeName()
        fixed += 8
        if name in ("string", "binary"):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif name in ("array", "map", "struct"):
            var.append(F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)))
        elif name not in _FIXED_BYTES:
            var.append(F.lit(16))
    total_var = F.sum(reduce(lambda a, b: a + b, var)) if var else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), total_var.alias("v"), *extra).collect()[0]
    return int(row["n"]) * fixed + int(row["v"] or 0), row


def with_scalar_row(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table (a global aggregate) to every row.

    The table becomes a single scalar subquery returning a struct; Spark
    runs it once and reuses it for every field, so this is neither a join
    nor a shuffle of ``rows``.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("__row")).scalar()
    return rows.withColumns({c: packed.getField(c) for c in one_row.columns})


def attach_by_keys(rows: DataFrame, stats: DataFrame, keys: tuple[str, ...] | list[str],
                   how: str = "left", stats_size: StatsSize | None = None,
                   broadcast: str = "auto") -> DataFrame:
    """Join per-key ``stats`` onto ``rows`` (key columns compared null-safe).

    With no keys, ``stats`` must hold exactly one row (a global aggregate);
    its columns become one scalar subquery, computed once and read by every
    task, so the rows are neither joined nor shuffled.  With keys, ``stats``
    is broadcast only when its measured size (:func:`measure`, or
    ``stats_size`` from a caller that measured it already) is within the
    broadcast threshold.  When the measurement finds no NULL key, a broadcast
    join compares the keys with plain equality, which is exactly equivalent
    then and lets Spark use its fast single-key hash maps (about 5x faster on
    a long key than the null-safe form).  Otherwise it is
    a shuffled hash join that builds on the statistics side: each task hashes
    its slice of the statistics and streams its rows through unsorted, and
    AQE splits a hot key's partition.  That join is always null-safe: its
    shuffle is on wrapped keys, so an aggregate by the same keys above it
    brings its own exchange of partial rows and does not tie AQE to the
    join's partitioning (with plain keys AQE would refuse the split, since
    it would add an exchange).  The hint also keeps the planner from
    broadcasting on a static estimate.  ``stats`` should be materialised
    (see :func:`materialize`) so that measuring it is cheap.

    ``broadcast="always"`` broadcasts without measuring (the caller knows
    the statistics are small); ``"never"`` takes the shuffled path without
    measuring, so nothing runs eagerly.
    """
    keys = list(keys)
    if not keys:
        return with_scalar_row(rows, stats)
    renamed = stats.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
                           *[c for c in stats.columns if c not in keys])
    null_safe = True
    if broadcast == "auto":
        if stats_size is None:
            stats_size = measure(stats, keys)
        threshold = broadcast_threshold(rows.sparkSession)
        small = 0 < threshold and stats_size.bytes <= threshold
        null_safe = not small or stats_size.null_key_rows > 0
    elif broadcast in ("always", "never"):
        small = broadcast == "always"
    else:
        raise ValueError("broadcast must be 'auto', 'always' or 'never'")
    right = F.broadcast(renamed) if small else renamed.hint("shuffle_hash")
    if null_safe:
        parts = [rows[k].eqNullSafe(right[f"__key{i}"]) for i, k in enumerate(keys)]
    else:
        parts = [rows[k] == right[f"__key{i}"] for i, k in enumerate(keys)]
    cond = reduce(lambda a, b: a & b, parts)
    joined = rows.join(right, cond, how)
    return joined.drop(*[f"__key{i}" for i in range(len(keys))])
