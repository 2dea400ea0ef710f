"""File sources.  All readers use explicit schemas (no inference pass over
the data, and job ids such as ``001`` stay strings)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprof.functions.columns import parse_double
from numprof.sinks.runs import live_runs, run_path

VALUE_SCHEMA = T.StructType([T.StructField("value", T.DoubleType(), True)])

REQUEST_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("data", T.StringType(), True),
])

# One schema for the three result kinds.  ``category_stats`` is a list in
# one kind and a map in another, so it is read as its raw JSON text and
# decoded per engine; ``engine`` is the partition column of the sink.
RESULT_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), True),
    T.StructField("processing_time_ms", T.LongType(), True),
    T.StructField("record_count", T.LongType(), True),
    T.StructField("avg_value", T.DoubleType(), True),
    T.StructField("max_value", T.DoubleType(), True),
    T.StructField("min_value", T.DoubleType(), True),
    T.StructField("std_dev", T.DoubleType(), True),
    T.StructField("processing_type", T.StringType(), True),
    T.StructField("category_stats", T.StringType(), True),
    T.StructField("result", T.ArrayType(T.DoubleType()), True),
    T.StructField("written_at", T.LongType(), True),
    T.StructField("engine", T.StringType(), True),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("job", T.StringType(), True),
])

CATEGORY_LIST_TYPE = T.ArrayType(T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("avg_normalized", T.DoubleType()),
    T.StructField("avg_original", T.DoubleType()),
]))
CATEGORY_MAP_TYPE = T.MapType(T.StringType(), T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("average", T.DoubleType()),
]))


def read_numeric_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless one-column CSV as ``value DOUBLE``.

    PERMISSIVE parsing: an unparseable field gives a NULL row (kept), blank
    lines are skipped, extra fields are ignored and quotes are removed.
    """
    return (spark.read.schema(VALUE_SCHEMA)
            .option("header", "false").option("mode", "PERMISSIVE")
            .csv(path))


def read_numeric_text(spark: SparkSession, path: str, on_malformed: str = "drop") -> DataFrame:
    """Text lines holding one number each, as ``value DOUBLE``.

    ``on_malformed="drop"``: lines that do not parse are dropped and the
    special values follow Java spelling (``Infinity``, ``NaN`` only).
    ``on_malformed="null"``: such lines stay as NULL rows.
    """
    lines = spark.read.text(path)
    if on_malformed == "drop":
        return (lines.select(parse_double("value", strict=True).alias("value"))
                .filter(F.col("value").isNotNull()))
    if on_malformed == "null":
        return lines.select(parse_double("value").alias("value"))
    raise ValueError("on_malformed must be 'drop' or 'null'")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Array requests (JSON lines ``{job_id, type, data}``, or lists of such
    records) as ``job_id, type, data, unusable``.

    ``data`` is parsed once from its raw text.  A request without the key
    ``data`` has NULL data; one whose data is there but no array of numbers
    (nulls within it are allowed) has NULL data and ``unusable`` true, and so
    has an explicit ``"data": null``: presence is the key's, not the value's.
    """
    lines = spark.read.text(path).filter(F.trim(F.translate("value", "\t\r", "  ")) != "")
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    records = lines.select(F.explode_outer(listed).alias("line"))
    raw = records.select(F.from_json("line", REQUEST_SCHEMA).alias("r"), F.json_object_keys("line").alias("keys"))
    raw = raw.select("r.*", F.coalesce(F.array_contains("keys", "data"), F.lit(False)).alias("present"))
    # Every element as text: a nested or quoted value shows its first character.
    parts = F.from_json("data", "array<string>")
    usable = F.coalesce(F.col("data").startswith("[") & F.forall(parts, lambda x: x.isNull() | x.rlike(r"^-?([0-9]|Inf|NaN)")), F.lit(False))
    data = F.from_json("data", "array<double>")
    return raw.select("job_id", "type", F.when(usable, data).alias("data"),
                      (F.col("present") & ~(usable & data.isNotNull())).alias("unusable"))


def stored_records(spark: SparkSession, root: str, runs: list[tuple[str, str, int]]) -> DataFrame:
    """The raw records of the given (engine, run id, rows), from their folders alone."""
    paths = [run_path(root, engine, run) for engine, run, n in runs if n]
    if not paths:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).option("basePath", root).json(paths)


def newest_records(df: DataFrame) -> DataFrame:
    """Of several copies of a job's record the newest whole one.

    The row number is limited before the shuffle too, so copies of a hot job
    do not travel.
    """
    newest = Window.partitionBy("job_id", "engine").orderBy(F.desc("written_at"), F.desc("run_id"))
    return df.withColumn("__copy", F.row_number().over(newest)).filter("__copy = 1").drop("__copy")


def read_results(spark: SparkSession, root: str, engines=None, missing_ok: bool = False) -> DataFrame:
    """All stored job results below ``root`` (written by
    :func:`numprof.sinks.write_results`), one row per job and engine: of
    several stored copies the newest whole record.  A root that does not
    exist raises, or with ``missing_ok`` reads as no results.

    Adds ``category_list`` (DataFrame kind) and ``category_map`` (RDD kind)
    decoded from the raw ``category_stats`` text.  ``engines`` restricts the
    read to their folders.  Only folders of live runs are listed and opened
    (see :mod:`numprof.sinks.runs`); a root without a commit log, written by
    other means, is read whole.
    """
    runs = live_runs(spark, root, engines)
    if runs is not None:
        df = stored_records(spark, root, runs)
    else:
        try:
            df = spark.read.schema(RESULT_SCHEMA).json(root)
        except AnalysisException as exc:
            if not missing_ok or exc.getCondition() != "PATH_NOT_FOUND":
                raise
            # Nothing stored yet: every result is absent, as for a missing file.
            df = spark.createDataFrame([], RESULT_SCHEMA)
        if engines:
            df = df.filter(F.col("engine").isin(list(engines)))
    df = newest_records(df).drop("run_id", "job")
    as_list = F.col("category_stats").startswith("[")
    return (df
            .withColumn("category_list", F.when(as_list, F.from_json("category_stats", CATEGORY_LIST_TYPE)))
            .withColumn("category_map", F.when(~as_list, F.from_json("category_stats", CATEGORY_MAP_TYPE))))


def uniform_values(rows: DataFrame, low: float = -100.0, high: float = 100.0,
                   seed: int = 42) -> DataFrame:
    """One uniform draw in [low, high) per row of ``rows`` (``value``).

    Seeded, so a recomputed partition gives the same values.
    """
    return rows.select((F.rand(seed) * (high - low) + low).alias("value"))


#: Draws that one row of the spreading step stands for.
DRAW_BLOCK = 1 << 12


def uniform_draws(jobs: DataFrame, job_col: str, count_col: str, seed_col: str, low: float = -100.0, high: float = 100.0) -> DataFrame:
    """``job_col, draw, value``: for every row of ``jobs`` as many uniform
    draws in [low, high) as it asks for, from a seed of its own.

    Draw i of a seed is the same in every run and on every engine: 52 bits of
    md5(seed, i).  A job's draws are dealt out in blocks, so one that asks for
    most of them fills all tasks; a NULL or non-positive count draws nothing,
    a NULL seed counts as the text ``NULL``.
    """
    seed = F.coalesce(F.col(seed_col).cast("string"), F.lit("NULL"))
    n = F.col(count_col).cast("bigint")
    last = F.floor((n - 1) / F.lit(DRAW_BLOCK)).cast("bigint")
    blocks = jobs.filter(n > 0).select(F.col(job_col), seed.alias("__seed"), n.alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("__block"))
    start = F.col("__block") * DRAW_BLOCK
    end = F.least(start + DRAW_BLOCK, F.col("__n")) - 1
    # A fixed number of tasks: by the size of its few rows, AQE would make one.
    tasks = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = blocks.repartition(tasks, job_col, "__block").select(F.col(job_col), "__seed", F.explode(F.sequence(start, end)).alias("draw"))
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", "__seed", F.col("draw").cast("string"))), 1, 13), 16, 10).cast("bigint")
    return draws.select(F.col(job_col), "draw", (bits / float(1 << 52) * (high - low) + low).alias("value"))
