"""Repair of quarantined records of any table in one pass.

``raw_record`` is read as a VARIANT object, so no schema is needed for a table: fields that a fix or a rule names are
taken out by name, all others pass through as they are, null ones too.  Which fixes and rules hold for a row follows
from its ``source_table``; all tables share one scan.

Defined cases: rows that are not ``new``, of a table without a repair, or whose record is null, no JSON or no object
stay as they are.  A fix changes text values only; a missing field is null to the rules and is not
added.  Numbers keep their value, not their spelling (1.50 becomes 1.5).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rules import VALID_COL, compile_rules, evaluate

ROW, FIXED = "__row", "__fixed"


@dataclass
class TableRepair:
    """``fixes``: field -> [(pattern, replacement)]; ``validations``: the rules a repaired record must pass; ``types``:
    fields that the rules do not compare as text."""
    validations: list[dict]
    fixes: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)


def _fixed_value(source: Column, name: Column, value: Column, repairs: dict[str, TableRepair]) -> Column:
    out = None
    for table, r in repairs.items():
        for fld, steps in r.fixes.items():
            text = reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), steps, value.cast("string")).cast("variant")
            hit = (source == table) & (name == fld) & (F.schema_of_variant(value) == "STRING")
            out = F.when(hit, text) if out is None else out.when(hit, text)
    return value if out is None else out.otherwise(value)


def repair_all(q: DataFrame, repairs: dict[str, TableRepair], run_ts, resolved_by: str = "repair") -> DataFrame:
    """Every quarantine row with ``repaired_record`` (JSON) where the fixed record passes its table's rules; these
    rows become ``fixed`` with ``resolved_by`` and ``resolved_at``."""
    source = F.col(f"{ROW}.source_table")
    open_row = (F.col("status") == "new") & F.col("source_table").isin(*repairs)
    rows = q.select(F.struct(*q.columns).alias(ROW),
                    F.when(open_row, F.try_parse_json("raw_record").try_cast("map<string,variant>")).alias(FIXED))
    rows = rows.withColumn(FIXED, F.transform_values(FIXED, lambda k, v: _fixed_value(source, k, v, repairs)))
    passed: list[str] = []
    for table, r in repairs.items():
        rules = compile_rules(r.validations)
        named = sorted({x.field for x in rules if x.field} | set(r.types))
        values = [F.when(source == table, F.try_variant_get(F.element_at(FIXED, F.lit(f)), "$", r.types.get(f, "string"))).alias(f)
                  for f in named]
        verdict = f"__passed{len(passed)}"
        rows = evaluate(rows.select(ROW, FIXED, *passed, *values), rules).select(
            ROW, FIXED, *passed, ((source == table) & F.col(VALID_COL)).alias(verdict))
        passed.append(verdict)
    good = F.col(FIXED).isNotNull() & reduce(lambda a, b: a | b, [F.col(c) for c in passed], F.lit(False))
    ts = F.lit(run_ts).cast("timestamp")
    changed = {"status": F.lit("fixed"), "resolved_by": F.lit(resolved_by), "resolved_at": ts}
    return rows.select(
        *[F.when(good, changed[c]).otherwise(F.col(f"{ROW}.{c}")).alias(c) if c in changed else F.col(f"{ROW}.{c}").alias(c)
          for c in q.columns],
        F.when(good, F.to_json(F.to_variant_object(FIXED))).alias("repaired_record"))


def records(repaired: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """The repaired records of one table as typed columns, to be merged into silver by key
    (``quarantine.merge_repaired``)."""
    v = (repaired.filter((F.col("source_table") == table) & F.col("repaired_record").isNotNull())
         .select(F.parse_json("repaired_record").alias("v")))
    return v.select(*[F.try_variant_get("v", f"$['{c}']", t).alias(c) for c, t in columns.items()])
