"""Cleaning operations, folded into one expression per column.

``apply_ops`` builds a single ``select`` however many fields and operations a
rule lists (chained ``withColumn`` calls grow the plan per call).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.validators import strip_phone

DEFAULT_FILL = "UNKNOWN"


def _phone_normalize(c: Column) -> Column:
    """``0170 123 456`` -> ``+49170123456``: separators removed, leading 0 -> +49."""
    return F.regexp_replace(strip_phone(c), r"^0", "+49")


OPS = {
    "trim": F.trim,
    "lowercase": F.lower,
    "uppercase": F.upper,
    "remove_whitespace": lambda c: F.regexp_replace(c, r"\s+", ""),
    "normalize_phone": _phone_normalize,
    "fill_unknown": lambda c: F.coalesce(c, F.lit(DEFAULT_FILL)),
}


def op_expr(col: str | Column, operations: list[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    for op in operations:
        if op not in OPS:
            raise ValueError(f"unknown cleaning operation {op!r}; known: {sorted(OPS)}")
        c = OPS[op](c)
    return c


def apply_ops(df: DataFrame, transformations: list[dict]) -> DataFrame:
    """``transformations`` = [{"field": f, "operations": [...]}, ...], applied in order.

    Several entries for one field compose in list order."""
    per_field: dict[str, list[str]] = {}
    for t in transformations or []:
        per_field.setdefault(t["field"], []).extend(t.get("operations") or [])
    missing = [f for f in per_field if f not in df.columns]
    if missing:
        raise ValueError(f"transformations name missing columns: {missing}")
    return df.select(*[op_expr(c, per_field[c]).alias(c) if c in per_field else F.col(c)
                       for c in df.columns])


def fill_default(df: DataFrame, fields: list[str], value: str = DEFAULT_FILL) -> DataFrame:
    return df.na.fill(value, subset=fields)
