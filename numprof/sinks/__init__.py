"""Writers for job results."""

from numprof.sinks.results import ENGINES, write_results, write_lines
from numprof.sinks.runs import live_runs

__all__ = ["ENGINES", "live_runs", "write_results", "write_lines"]
