"""Scalar column expressions.

Everything here builds a ``Column`` from Spark built-ins so that it stays
inside whole-stage codegen.  Division always goes through ``nullif(d, 0)``:
Spark 4 runs with ANSI mode on, where ``x / 0`` raises instead of giving
NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from numprof.functions.fixed import DEFAULT_HIGH_EDGE, DEFAULT_LOW_EDGE, HIGH, LOW, MEDIUM

# Java's Double.parseDouble accepts only these exact spellings of the
# special values; try_cast also takes other cases and "inf".  Surrounding
# characters up to U+0020 are what Java's String.trim removes.
_SPECIAL_ANY_CASE = r"(?i)^[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*$"
_SPECIAL_JAVA = r"^[\x00-\x20]*[+-]?(Infinity|NaN)[\x00-\x20]*$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` evaluated once per row.

    Inside higher-order-function lambdas every column expression is
    re-evaluated for each element; passing a value through a one-element
    array turns it into a lambda variable, computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return num / F.nullif(den, F.lit(0))


def parse_double(text: str | Column, strict: bool = False) -> Column:
    """Parse a text value to DOUBLE; unparseable text gives NULL.

    ``try_cast`` trims surrounding blanks itself.  With ``strict=True`` the
    special spellings follow Java's ``parseDouble``: ``Infinity`` and ``NaN``
    (optionally signed) are accepted, other spellings such as ``inf`` or
    ``nan`` are rejected.
    """
    t = col_of(text)
    parsed = t.try_cast("double")
    if not strict:
        return parsed
    # Only a NaN or infinite result can come from a special spelling, so the
    # spelling is checked for those rows alone (1e400 is infinite and stays).
    special = F.isnan(parsed) | (F.abs(parsed) == F.lit(float("inf")))
    rejected = t.rlike(_SPECIAL_ANY_CASE) & ~t.rlike(_SPECIAL_JAVA)
    return F.when(special & rejected, F.lit(None).cast("double")).otherwise(parsed)


def zscore(value: str | Column, mean: str | Column, sd: str | Column) -> Column:
    """(x - mean) / sd; NULL when sd is 0 or NULL."""
    return safe_div(col_of(value) - col_of(mean), col_of(sd))


def band_code(z: str | Column, low: float = DEFAULT_LOW_EDGE, high: float = DEFAULT_HIGH_EDGE,
              nan_is_medium: bool = False) -> Column:
    """Three-band code: 2 when ``z > high``, 0 when ``z < low``, else 1.

    Both comparisons are strict, so the edges themselves are 1 (medium), and
    a NULL z is 1.  Spark orders NaN above every number, so a NaN z is 2
    unless ``nan_is_medium`` (Java comparison semantics) is set.
    """
    zc = col_of(z)
    code = F.when(zc > F.lit(high), F.lit(2)).when(zc < F.lit(low), F.lit(0)).otherwise(F.lit(1))
    if nan_is_medium:
        code = F.when(F.isnan(zc), F.lit(1)).otherwise(code)
    return code


def band_label(code: str | Column) -> Column:
    """The label of a :func:`band_code`: low, medium or high."""
    c = col_of(code)
    return F.when(c == 2, F.lit(HIGH)).when(c == 0, F.lit(LOW)).otherwise(F.lit(MEDIUM))


def band(z: str | Column, low: float = DEFAULT_LOW_EDGE, high: float = DEFAULT_HIGH_EDGE,
         nan_is_medium: bool = False) -> Column:
    """Three-band label of a z-score (see :func:`band_code` for the rule)."""
    return band_label(band_code(z, low, high, nan_is_medium))


def round_all(df, digits: int = 6):
    """Round every DOUBLE/FLOAT column (top level) to ``digits`` places."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
