"""Quarantine: failed rows as reviewable records, reports, repair and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import dedup
from strata.operators.rules import Rule, compile_rules, evaluate
from strata.sources.schemas import QUARANTINE_RECORDS, conform


def error_type(rules: list[Rule]) -> Column:
    """Code of the first failed rule, in rule order."""
    e = None
    for r in rules:
        e = F.when(~F.col(r.flag), F.lit(r.name)) if e is None else e.when(~F.col(r.flag), F.lit(r.name))
    return e.otherwise(F.lit("unknown"))


def error_field(rules: list[Rule]) -> Column:
    e = None
    for r in rules:
        val = F.lit(r.field) if r.field else F.lit(None).cast("string")
        e = F.when(~F.col(r.flag), val) if e is None else e.when(~F.col(r.flag), val)
    return e.otherwise(F.lit("multiple"))


def error_message(rules: list[Rule]) -> Column:
    """All failure messages joined with ``; `` in rule order."""
    return F.concat_ws("; ", *[F.when(~F.col(r.flag), F.lit(r.message or r.name)) for r in rules])


def build(invalid: DataFrame, rules: list[Rule], source_table: str, run_id: str, run_ts,
          record_columns: list[str] | None = None, with_id: bool = True, keep_nulls: bool = False) -> DataFrame:
    """Quarantine rows in the ``quarantine_records`` layout.

    ``raw_record`` is the JSON of ``record_columns`` (all non-helper columns by
    default); null fields are left out unless ``keep_nulls``.  ``created_at`` is the run's
    timestamp, passed in, so every record of a run carries the same instant.
    The id is an md5 of run, table, record and the row's number among equal
    records: unique within a run, and the same however the rows are partitioned.
    """
    helpers = {r.flag for r in rules} | {"_is_valid", "_is_rejected", "_dq_flags", "_dq_score", "_dq_failed"}
    cols = record_columns or [c for c in invalid.columns if c not in helpers]
    raw = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": str(not keep_nulls).lower()})
    out = invalid.select(
        F.lit(source_table).alias("source_table"),
        F.lit(run_id).alias("pipeline_run_id"),
        error_type(rules).alias("error_type"),
        error_message(rules).alias("error_message"),
        error_field(rules).alias("error_field"),
        raw.alias("raw_record"),
        F.lit("new").alias("status"),
        F.lit(None).cast("string").alias("resolution_notes"),
        F.lit(None).cast("string").alias("resolved_by"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(run_ts).cast("timestamp").alias("created_at"),
    )
    if not with_id:
        return out
    # equal records are counted first and unfolded in two steps: no task holds all copies of one record
    step = 4096
    counted = out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("_n"))
    unfolded = (counted.withColumn("_hi", F.explode(F.expr(f"sequence(0L, (_n - 1) div {step})")))
                .withColumn("_lo", F.explode(F.expr(f"sequence(0L, least({step - 1}L, _n - 1 - _hi * {step}))"))))
    out = unfolded.withColumn("quarantine_id", F.md5(F.concat_ws(
        "|", F.col("pipeline_run_id"), F.col("source_table"), F.col("raw_record"),
        (F.col("_hi") * step + F.col("_lo") + 1).cast("string")))).drop("_n", "_hi", "_lo")
    return conform(out, QUARANTINE_RECORDS)


# --------------------------------------------------------------------------- reports

def by_type(q: DataFrame) -> DataFrame:
    return q.groupBy("error_type").agg(F.count(F.lit(1)).alias("error_count")).orderBy(F.desc("error_count"))


def by_message(q: DataFrame) -> DataFrame:
    return (q.groupBy("source_table", "error_type", "error_message")
            .agg(F.count(F.lit(1)).alias("occurrences")).orderBy(F.desc("occurrences")))


def trend(q: DataFrame, today, days: int = 7) -> DataFrame:
    """Errors per day and type over the last ``days`` days up to ``today``."""
    d = F.to_date("created_at")
    start = F.date_sub(F.lit(today).cast("date"), days)
    cond = d >= start
    if "run_date" in q.columns:  # per-run folders: skip older days entirely
        cond = cond & (F.col("run_date") >= F.date_sub(start, 1))
    return (q.filter(cond).groupBy(d.alias("error_date"), "error_type")
            .agg(F.count(F.lit(1)).alias("error_count")))


def select_errors(q: DataFrame, error_type: str | None = None, since=None, status: str | None = None) -> DataFrame:
    cond = F.lit(True)
    if error_type:
        cond = cond & (F.col("error_type") == error_type)
    if since is not None:
        cond = cond & (F.col("created_at") >= F.lit(since).cast("timestamp"))
    if status:
        cond = cond & (F.col("status") == status)
    return q.filter(cond)


def retry_eligibility(q: DataFrame, policy: DataFrame) -> DataFrame:
    """Join a per-error-type retry policy (error_type, retryable, max_retries).

    The policy is a config table; Spark/AQE choose broadcast when it is small."""
    return (q.join(policy, "error_type", "left")
            .withColumn("retryable", F.coalesce(F.col("retryable"), F.lit(False))))


# --------------------------------------------------------------------------- repair / review

def extract(q: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of ``raw_record`` as typed columns (``from_json``)."""
    return q.select("*", F.from_json("raw_record", schema).alias("_r")).select(
        *q.columns, *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])


def repair(q: DataFrame, schema: T.StructType, fixes: dict[str, list[tuple[str, str]]],
           validations: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Re-process quarantined rows: pull the fields out of the JSON, apply
    regex fixes (field -> [(pattern, replacement)]), validate again.

    Returns (repaired rows in the record schema, the quarantine rows with
    status ``fixed`` for the repaired ones).  Survivors must be merged into
    silver by key, not appended, or silver gets duplicates.
    """
    rules = compile_rules(validations)
    rec = extract(q.filter(F.col("status") == "new"), schema)
    fixed = rec.select(*q.columns, *[
        _apply_fixes(F.col(f.name), fixes.get(f.name, [])).alias(f.name) for f in schema.fields])
    ev = evaluate(fixed, rules)
    good = ev.filter(F.col("_is_valid"))
    repaired = good.select(*[f.name for f in schema.fields])
    ids = good.select("quarantine_id").withColumn("_fixed", F.lit(True))
    updated = (q.join(ids, "quarantine_id", "left")
               .withColumn("status", F.when(F.col("_fixed"), F.lit("fixed")).otherwise(F.col("status")))
               .drop("_fixed"))
    return repaired, updated


def _apply_fixes(c: Column, fixes: list[tuple[str, str]]) -> Column:
    for pat, rep in fixes:
        c = F.regexp_replace(c, pat, rep)
    return c


def resolve(q: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply review decisions (quarantine_id, status, resolution_notes,
    resolved_by, resolved_at); unmentioned records stay as they are."""
    d = decisions.select("quarantine_id", *[F.col(c).alias(f"_d_{c}") for c in
                                            ("status", "resolution_notes", "resolved_by", "resolved_at")])
    j = q.join(d, "quarantine_id", "left")
    return j.select(*[F.coalesce(F.col(f"_d_{c}"), F.col(c)).alias(c)
                      if c in ("status", "resolution_notes", "resolved_by", "resolved_at") else F.col(c)
                      for c in q.columns])


def merge_repaired(silver: DataFrame, repaired: DataFrame, keys: list[str], order_by: str,
                   tie_breakers: list[str] | None = None) -> DataFrame:
    """Silver with the repaired rows merged in by key: per key the newest row
    wins (a repaired row older than the silver row does not replace it), so
    silver never holds a key twice.  Columns a repaired record lacks are null."""
    both = silver.unionByName(repaired.select(*[c for c in repaired.columns if c in silver.columns]),
                              allowMissingColumns=True)
    return dedup.keep_one(both, keys, order_by, "desc", tie_breakers)
