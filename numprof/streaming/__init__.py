"""Structured Streaming entry points for the same profiling operators.

Nothing here adds an operator: files that land in a folder are profiled as
jobs (one job per file, as the batch jobs do per input), micro-batch by
micro-batch.
"""

from numprof.streaming.files import profile_files_stream, job_id_from_path

__all__ = ["profile_files_stream", "job_id_from_path"]
