"""Column expressions shared by the operators (all JVM-side built-ins)."""

from numprof.functions.columns import (
    HIGH, LOW, MEDIUM, band, band_code, band_label, parse_double, safe_div, zscore,
)

__all__ = ["HIGH", "LOW", "MEDIUM", "band", "band_code", "band_label", "parse_double", "safe_div",
           "zscore"]
