"""Session builder for tests, tools and the benchmark (library code never
creates a session)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("numprof")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("NUMPROF_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, checkpoint_dir: str, split_bytes: int = 1 << 30,
                 shuffle_target_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Scan splits of ``split_bytes`` (100 TB: about 100k map tasks) and a few
    shuffle partitions per core: nearly every exchange of this library moves
    partial aggregates, and map tasks x partitions is the number of shuffle
    blocks, which must stay in the hundreds of millions.  A join that
    shuffles all rows gets its own count: pass :func:`row_partitions` to
    ``repartition`` on that input.  ``checkpoint_dir`` is a folder that the
    driver and all executors share; checkpoints no longer needed are
    cleaned.  Statistics are broadcast only on sizes measured at run time.
    """
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(max(3 * total_cores, 1)),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.checkpoint.dir": checkpoint_dir,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def row_partitions(bytes_moved: int, total_cores: int, target_bytes: int = 1 << 30) -> int:
    """Partitions for one shuffle that moves ``bytes_moved`` of whole rows."""
    return max(3 * total_cores, -(-bytes_moved // target_bytes))
