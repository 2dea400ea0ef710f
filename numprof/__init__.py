"""numprof: numeric profiling on Spark DataFrames.

Every public function takes and returns a ``DataFrame`` and is lazy unless
its docstring says otherwise.  All work is expressed with Spark built-ins
(the dense tiled matrix product multiplies tiles with numpy inside tasks);
statistics never travel through the driver.
"""

from numprof.operators.arrays import (
    array_stats, process_requests, standardize_arrays, standardize_arrays_long,
)
from numprof.operators.categories import band_stats, category_list, category_map, category_stats
from numprof.operators.jobs import (
    analyze_flat, analyze_jobs, chart_series, nested_results, recommendations, results_long,
    speedup_report,
)
from numprof.operators.matrix import array_rows_to_coo, matmul, matmul_coo, matmul_tiled
from numprof.operators.profile import flavour_diff, profile
from numprof.operators.results import array_results, job_results, receipts
from numprof.operators.standardize import standardize
from numprof.sinks.compaction import compact_results, vacuum_results
from numprof.sinks.results import write_results
from numprof.sources.files import (
    read_numeric_csv, read_numeric_text, read_requests, read_results, uniform_draws,
    uniform_values,
)

__version__ = "0.1.0"

__all__ = [
    "analyze_flat", "analyze_jobs", "array_results", "band_stats", "array_rows_to_coo", "array_stats",
    "category_list", "category_map", "category_stats", "chart_series", "compact_results", "flavour_diff",
    "job_results", "matmul", "matmul_coo", "matmul_tiled", "nested_results", "process_requests", "profile",
    "read_numeric_csv", "read_numeric_text", "read_requests", "read_results", "receipts",
    "recommendations", "results_long", "speedup_report", "standardize", "standardize_arrays",
    "standardize_arrays_long", "uniform_draws", "uniform_values", "vacuum_results", "write_results",
]
