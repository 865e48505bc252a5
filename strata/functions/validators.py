"""Validators as native column expressions (no Python workers).

The patterns reproduce the reference's Python semantics exactly on the JVM:
Python's ``$`` allows one trailing newline (Java's ``$`` also allows ``\\r\\n``,
``\\r`` and U+2028), Python's ``\\d`` is Unicode (Java's is ASCII) and
``str.strip()`` removes more than Spark's ``trim``.  The same strings run
unchanged in RE2 (DuckDB), which the oracles use.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Patterns and separator set that must give the reference's results.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
PHONE_DE_PATTERN = r"^(\+49|0)[1-9]\p{Nd}{8,14}\n?\z"
BLANK_PATTERN = r"^[\s\x0b\x1c-\x1f\x85\p{Z}]*\z"
PHONE_SEPARATORS = " -()"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_email(col: str | Column) -> Column:
    """null / "" -> false; the pattern is applied to the untrimmed value."""
    return F.coalesce(_c(col).rlike(EMAIL_PATTERN), F.lit(False))


def strip_phone(col: str | Column) -> Column:
    """Remove blanks, dashes and parentheses (a single ``translate``)."""
    return F.translate(_c(col), PHONE_SEPARATORS, "")


def is_phone_de(col: str | Column) -> Column:
    """Optional German number: null / "" -> true, else separators removed and matched."""
    c = _c(col)
    return F.coalesce(F.when(c != "", strip_phone(c).rlike(PHONE_DE_PATTERN)), F.lit(True))


def is_not_blank(col: str | Column) -> Column:
    """null or only whitespace (Python ``str.strip`` whitespace) -> false."""
    return F.coalesce(~_c(col).cast("string").rlike(BLANK_PATTERN), F.lit(False))


def is_in(col: str | Column, allowed: list, required: bool = False) -> Column:
    """Enum check on the string form, case-sensitive; null passes unless required."""
    return F.coalesce(_c(col).cast("string").isin([str(v) for v in allowed]), F.lit(not required))


def is_before(start: str | Column, end: str | Column) -> Column:
    """Strict ``start < end``; either side null -> false."""
    return F.coalesce(_c(start) < _c(end), F.lit(False))


def in_range(col: str | Column, lo: float | None = None, hi: float | None = None,
             required: bool = False) -> Column:
    """Inclusive range with open ends; null passes unless required."""
    c = _c(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return F.coalesce(cond, F.lit(not required))


def matches(col: str | Column, pattern: str, required: bool = False) -> Column:
    """User regex rule.  Required: null / "" fail.  Optional: null / "" pass."""
    c = _c(col).cast("string")
    if required:
        return F.coalesce(c.rlike(pattern), F.lit(False))
    return F.coalesce(F.when(c != "", c.rlike(pattern)), F.lit(True))


def register_sql(spark: SparkSession) -> list[str]:
    """Make the three validators callable from SQL as SQL functions (JVM only)."""
    def lit(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    defs = {
        "validate_email": f"coalesce(v RLIKE {lit(EMAIL_PATTERN)}, false)",
        "validate_phone_de": (f"coalesce(v IS NULL OR v = '' OR translate(v, {lit(PHONE_SEPARATORS)}, '') "
                              f"RLIKE {lit(PHONE_DE_PATTERN)}, false)"),
        "validate_not_null": f"v IS NOT NULL AND NOT coalesce(v RLIKE {lit(BLANK_PATTERN)}, false)",
    }
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS BOOLEAN RETURN {body}")
    return list(defs)
