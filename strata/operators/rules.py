"""Declarative data-quality rules compiled to column expressions.

A rule is a dict as found in the ``validations`` array of a ``dq_check``
config.  ``evaluate`` adds one boolean flag per rule and the row verdict in a
single ``select``; every flag is non-null by construction, so the valid and
the invalid half of ``split`` always add up to the input.

Rule types: ``regex``, ``not_null``, ``enum``, ``range``, ``custom`` (a
trusted SQL boolean expression), plus ``email`` and ``phone_de`` for the two
built-in validators.  Actions: ``quarantine`` (default), ``reject`` (dropped
and counted) and ``flag`` (kept, listed in ``_dq_flags``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import validators as V
from strata.operators import whitelist as W

VALID_COL = "_is_valid"
REJECT_COL = "_is_rejected"
FLAGS_COL = "_dq_flags"
SCORE_COL = "_dq_score"
FAILED_COL = "_dq_failed"


@dataclass
class Rule:
    type: str
    field: str | None = None
    name: str = ""
    key: str = ""
    message: str | None = None
    action: str = "quarantine"
    severity: str = "error"
    required: bool = False
    pattern: str | None = None
    allowed: list = dc_field(default_factory=list)
    expression: str | None = None
    lo: float | None = None
    hi: float | None = None

    @property
    def flag(self) -> str:
        return f"_{self.key}_valid"

    def expr(self) -> Column:
        t, f = self.type, self.field
        if t == "email":
            return V.is_email(f)
        if t == "phone_de":
            return V.is_phone_de(f)
        if t == "not_null":
            return V.is_not_blank(f)
        if t == "regex":
            return V.matches(f, self.pattern, self.required)
        if t == "enum":
            return V.is_in(f, self.allowed, self.required)
        if t == "range":
            return V.in_range(f, self.lo, self.hi, self.required)
        if t == "custom":
            return F.coalesce(F.expr(self.expression), F.lit(False))
        raise ValueError(f"unknown rule type {t!r}")


def compile_rules(validations: list[dict] | dict) -> list[Rule]:
    """Turn rule dicts into ``Rule`` objects; accepts the older spellings
    (a single flat ``validation`` dict, enum key ``values``)."""
    if isinstance(validations, dict):
        validations = [validations]
    out: list[Rule] = []
    seen: set[str] = set()
    for i, v in enumerate(validations):
        t = v.get("type")
        fld = v.get("field")
        if t != "custom" and not fld:
            raise ValueError(f"rule {i} of type {t!r} needs a field")
        if t == "custom" and not v.get("expression"):
            raise ValueError(f"custom rule {i} needs an expression")
        name = v.get("name") or (f"{fld}_null" if t == "not_null" else f"{fld or 'rule' + str(i)}_invalid")
        key = re.sub(r"[^0-9A-Za-z_]", "_", v.get("key") or fld or name)
        if key in seen:
            key = f"{key}_{i}"
        seen.add(key)
        severity = v.get("severity") or "error"
        action = v.get("error_action") or ("flag" if severity in ("warning", "info") else "quarantine")
        out.append(Rule(
            type=t, field=fld, name=name, key=key, message=v.get("error_message"),
            action=action, severity=severity, required=bool(v.get("required") or False),
            pattern=v.get("pattern"), allowed=list(v.get("allowed_values") or v.get("values") or []),
            expression=v.get("expression"), lo=v.get("min"), hi=v.get("max"),
        ))
    return out


def check_schema(df: DataFrame, rules: list[Rule], extra_required: list[str] = ()) -> list[str]:
    """Columns the rules (and the caller) need but ``df`` lacks.  Schema only,
    no data is read."""
    need = [r.field for r in rules if r.field] + list(extra_required)
    have = set(df.columns)
    return sorted({c for c in need if c not in have})


# --------------------------------------------------------------------------- evaluate

def evaluate(df: DataFrame, rules: list[Rule], whitelist: DataFrame | None = None,
             table: str | None = None, as_of=None, with_score: bool = False,
             with_failed: bool = False) -> DataFrame:
    """Add ``_<key>_valid`` per rule, ``_is_valid``, ``_is_rejected``, ``_dq_flags``.

    ``_is_valid`` is the AND of the quarantine/reject rules; ``flag`` rules
    never make a row invalid.  With a whitelist, an active, unexpired entry
    for (table, field, rule type) that matches the whole value turns a failure into
    a pass (see ``operators.whitelist``).
    """
    if not rules:
        raise ValueError("no rules")
    missing = check_schema(df, rules)
    if missing:
        raise ValueError(f"rules reference missing columns: {missing}")
    base, marks = df, {}
    if whitelist is not None:
        if table is None or as_of is None:
            raise ValueError("whitelist needs table and as_of")
        base, marks = W.mark(df, rules, whitelist, table, as_of)

    flag_exprs = []
    for r in rules:
        e = r.expr()
        if r.key in marks:
            e = e | F.col(marks[r.key])
        flag_exprs.append(e.alias(r.flag))
    out = base.select("*", *flag_exprs)
    out = out.drop(*set(marks.values()))

    hard = [r for r in rules if r.action in ("quarantine", "reject")]
    reject = [r for r in rules if r.action == "reject"]
    soft = [r for r in rules if r.action == "flag"]
    valid = F.lit(True)
    for r in hard:
        valid = valid & F.col(r.flag)
    rejected = F.lit(False)
    for r in reject:
        rejected = rejected | ~F.col(r.flag)
    extra = [valid.alias(VALID_COL), rejected.alias(REJECT_COL),
             F.filter(F.array(*[F.when(~F.col(r.flag), F.lit(r.name)) for r in soft] or [F.lit(None).cast("string")]),
                      lambda x: x.isNotNull()).alias(FLAGS_COL)]
    if with_score:
        passed = sum((F.col(r.flag).cast("int") for r in rules), F.lit(0))
        extra.append((F.lit(100.0) * passed / F.lit(len(rules))).alias(SCORE_COL))
    if with_failed:
        extra.append(failed_names(rules).alias(FAILED_COL))
    return out.select("*", *extra)


def failed_names(rules: list[Rule]) -> Column:
    """Array of the failed rule names, in rule order."""
    return F.filter(F.array(*[F.when(~F.col(r.flag), F.lit(r.name)) for r in rules]),
                    lambda x: x.isNotNull())


def split(evaluated: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, quarantine, rejected) halves of an evaluated frame."""
    valid = evaluated.filter(F.col(VALID_COL))
    bad = evaluated.filter(~F.col(VALID_COL))
    return valid, bad.filter(~F.col(REJECT_COL)), bad.filter(F.col(REJECT_COL))


def helper_columns(rules: list[Rule]) -> list[str]:
    return [r.flag for r in rules] + [VALID_COL, REJECT_COL, FLAGS_COL, SCORE_COL, FAILED_COL]


def strip_helpers(df: DataFrame, rules: list[Rule], keep_flags: bool = False) -> DataFrame:
    drop = [c for c in helper_columns(rules) if c in df.columns and not (keep_flags and c == FLAGS_COL)]
    return df.drop(*drop)


def breakdown(evaluated: DataFrame, rules: list[Rule]) -> DataFrame:
    """Count per combination of rule outcomes, most frequent first."""
    return (evaluated.groupBy(*[F.col(r.flag).alias(f"{r.key}_ok") for r in rules])
            .agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.desc("row_count")))


def failure_counts(evaluated: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: how many rows fail it (one pass, one aggregate)."""
    agg = evaluated.agg(*[F.count_if(~F.col(r.flag)).alias(r.key) for r in rules],
                        F.count(F.lit(1)).alias("_n"))
    stack = ", ".join(f"'{r.name}', '{r.key}', `{r.key}`" for r in rules)
    return agg.selectExpr(f"stack({len(rules)}, {stack}) AS (rule_name, rule_key, failed)", "_n AS total")


def rules_from_table(dq_rules: DataFrame, table: str) -> list[Rule]:
    """Rules held as rows of ``dq_rules`` (active rows of one table).

    ``rule_definition`` is the JSON of the rule's own parameters; field, type,
    name, severity and action come from the row's columns.  A config table is
    small and curated, so it is read to the driver after a size check.
    """
    import json
    rows = (dq_rules.filter((F.col("table_name") == table) & F.coalesce(F.col("active"), F.lit(True)))
            .orderBy("rule_id"))
    got = rows.limit(10001).collect()
    if len(got) > 10000:
        raise ValueError("more than 10000 active rules for one table")
    vals = []
    for r in got:
        d = json.loads(r.rule_definition or "{}")
        d.setdefault("field", r.field_name)
        d["type"] = r.rule_type
        d.setdefault("name", r.rule_name)
        d.setdefault("severity", r.severity)
        d.setdefault("error_action", r.error_action)
        vals.append(d)
    return compile_rules(vals)


def override(rules: list[Rule], others: list[Rule]) -> list[Rule]:
    """``rules`` with those of ``others`` in place of the same name, and the rest of ``others`` after them; keys stay unique."""
    by_name = {r.name: r for r in others}
    out = [by_name.pop(r.name, r) for r in rules]
    out += [r for r in others if r.name in by_name]
    seen: set[str] = set()
    for i, r in enumerate(out):
        if r.key in seen:
            out[i] = replace(r, key=f"{r.key}_{i}")
        seen.add(out[i].key)
    return out


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The compiled rule list as a small DataFrame (for reports)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("rule_name", "rule_key", "field", "type", "action", "severity", "message")])
    return spark.createDataFrame([(r.name, r.key, r.field, r.type, r.action, r.severity, r.message)
                                  for r in rules], schema)
