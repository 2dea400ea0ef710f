"""Readers: numeric CSV and text, array requests, stored job results, uniform input."""

from numprof.sources.files import (
    read_numeric_csv, read_numeric_text, read_requests, read_results, uniform_draws, uniform_values,
    REQUEST_SCHEMA, RESULT_SCHEMA,
)

__all__ = ["read_numeric_csv", "read_numeric_text", "read_requests", "read_results",
           "uniform_draws", "uniform_values", "REQUEST_SCHEMA", "RESULT_SCHEMA"]
