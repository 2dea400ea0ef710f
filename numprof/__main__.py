"""Command line: ``spark-submit numprof/__main__.py <command> ...`` or
``python -m numprof <command> ...``.  On a cluster, ship the package with
``--py-files`` (a zip of ``numprof/``) as usual.

Commands::

    profile   <input> <output_root> <job_id> [--kind dataframe|rdd] [--cache]
    arrays    <requests.json> <output_root> [--engine-layout]
    analyze   <results_root> <output_path> [--job-ids <file>] [--charts <path>]

``profile`` reads headerless CSV (``dataframe``) or text lines (``rdd``),
writes the job record below ``output_root`` and prints it.  ``arrays``
standardises every request's array, writes the array results below
``output_root`` and the receipts next to it (``<output_root>_receipts``).
Both write one folder per job, the layout of the original jobs; keep one
layout per results root (``--engine-layout`` writes per engine only, for
large batches).  ``analyze`` writes one analysis record per stored job as
JSON lines to ``output_path`` and, with ``--charts``, the chart series.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):
    # Run as a script (spark-submit numprof/__main__.py): make the package importable.
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="numprof", description="Numeric profiling jobs on Spark.")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("profile", help="profile one numeric input as one job")
    p.add_argument("input", help="headerless CSV (dataframe kind) or text lines (rdd kind)")
    p.add_argument("output_root", help="results root (shared storage)")
    p.add_argument("job_id", help="job id, kept as text (001 stays 001)")
    p.add_argument("--kind", choices=["dataframe", "rdd"], default="dataframe",
                   help="dataframe: sample deviation, bad fields as NULL rows; "
                        "rdd: population deviation, bad lines dropped")
    p.add_argument("--cache", action="store_true", help="cache the parsed input for the two passes")
    a = sub.add_parser("arrays", help="standardise the array of every request")
    a.add_argument("requests", help="JSON lines {job_id, type, data}")
    a.add_argument("output_root", help="results root; receipts go to <output_root>_receipts")
    a.add_argument("--engine-layout", action="store_true",
                   help="write per engine only (large batches) instead of one folder per job")
    z = sub.add_parser("analyze", help="compare the stored results of every job")
    z.add_argument("results_root", help="results root written by profile and arrays")
    z.add_argument("output_path", help="where the analysis records go (JSON lines)")
    z.add_argument("--job-ids", help="text file with one job id per line (default: every stored job)")
    z.add_argument("--charts", help="also write the chart series (time comparison, speedup) here")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"numprof {args.command}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()
    return 0


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    from numprof.plans.jobs import run_analysis, run_array_job, run_profile_job

    if args.command == "profile":
        rec = run_profile_job(spark, args.input, args.job_id, kind=args.kind,
                              output_root=args.output_root, cache_input=args.cache)
        for line in rec.toJSON().collect():   # the one record of this job
            print(line)
    elif args.command == "arrays":
        out = run_array_job(spark, args.requests, args.output_root, not args.engine_layout)
        out.write.mode("overwrite").json(args.output_root.rstrip("/") + "_receipts")
    else:
        from numprof.operators.jobs import analyze_flat, chart_series, nest_analysis
        from numprof.plans.stats_join import materialize
        from numprof.sources.files import read_results

        ids = spark.read.text(args.job_ids).withColumnRenamed("value", "job_id") if args.job_ids else None
        # The stored results are read and analysed once for both outputs.
        flat = materialize(analyze_flat(read_results(spark, args.results_root), ids))
        nest_analysis(flat).write.mode("overwrite").json(args.output_path)
        if getattr(args, "charts", None):
            chart_series(flat).write.mode("overwrite").json(args.charts)


if __name__ == "__main__":
    sys.exit(main())
