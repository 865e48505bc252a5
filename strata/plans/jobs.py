"""Jobs: bronze -> silver (rules, quarantine, clean, dedup), silver -> gold
(type-2 merge, checks), simple copies and aggregates, and the config-driven
run that orders them by dependency.

``dq_frames`` builds the bronze -> silver DataFrames only; the ``run_*``
functions write, count through ``Observation``s on the writes (no extra
scans), and publish through a pointer (a new version of silver tables; the
run's rows of a dimension) so a retried or interrupted run never leaves a
half-written table behind.
"""

from __future__ import annotations

import traceback
from types import SimpleNamespace
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import apply_ops
from strata.operators import dedup, quarantine, rules as R, scd2
from strata.operators.gold import aggregate_rule
from strata.plans import monitor
from strata.sources import io
from strata.sources.config import ConfigEntry, execution_order, load_config


@dataclass
class Run:
    """One run: id, timestamp (one literal for every derived frame), env."""
    run_id: str
    run_ts: datetime
    environment: str = "dev"
    settings: dict = field(default_factory=dict)

    @classmethod
    def start(cls, environment: str = "dev", now: datetime | None = None) -> "Run":
        now = now or datetime.now(timezone.utc).replace(tzinfo=None).replace(microsecond=0)
        return cls(now.strftime("%Y%m%d_%H%M%S"), now, environment, load_config(environment))


def _feature(run: Run, name: str) -> bool:
    """Feature flag of the run's environment (on when not configured)."""
    return bool(run.settings.get("features", {}).get(name, True))


@dataclass
class DqFrames:
    evaluated: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    rejected: DataFrame
    rules: list


def dq_frames(bronze: DataFrame, rule: dict, source_table: str, run: Run, whitelist: DataFrame | None = None,
              silver_columns: list[str] | None = None, record_columns: list[str] | None = None,
              tie_breakers: list[str] | None = None, observation: Observation | None = None,
              with_score: bool = False, dq_rules: DataFrame | None = None) -> DqFrames:
    """Validate -> split -> clean -> dedup, in that order: a newest row that
    fails goes to quarantine and an older valid row survives in silver.

    ``dq_rules`` (rows of that service table) adds the table's active rules; one
    named like a rule of the config takes its place.

    With ``observation``, the quarantine plan counts rows read / failed /
    rejected on its way (before its filter), so writing the quarantine also
    yields the input statistics: no separate counting pass."""
    rules = R.compile_rules(rule.get("validations") or rule.get("validation") or [])
    if dq_rules is not None:
        rules = R.override(rules, R.rules_from_table(dq_rules, source_table))
    ev = R.evaluate(bronze, rules, whitelist=whitelist, table=source_table,
                    as_of=run.run_ts if whitelist is not None else None, with_score=with_score)
    valid, _, rejected = R.split(ev)
    stats = [F.count(F.lit(1)).alias("read"), F.count_if(~F.col(R.VALID_COL)).alias("failed"),
             F.count_if(F.col(R.REJECT_COL)).alias("rejected")]
    if with_score:
        stats.append(F.avg(R.SCORE_COL).alias("score"))
    ev_q = ev if observation is None else ev.observe(observation, *stats)
    bad = R.split(ev_q)[1]
    clean = apply_ops(R.strip_helpers(valid, rules, keep_flags=any(r.action == "flag" for r in rules)),
                      rule.get("transformations") or [])
    dd = rule.get("deduplication") or {}
    if dd.get("enabled"):
        clean = dedup.keep_one(clean, dd["key_fields"], dd["order_by"], dd.get("order", "desc"),
                               tie_breakers if tie_breakers is not None else dd.get("tie_breakers"))
    if silver_columns:
        clean = clean.select(*silver_columns)
    silver = clean.select("*", F.lit(run.run_id).alias("_silver_loaded_at"),
                          F.lit(run.run_ts).cast("timestamp").alias("_silver_timestamp"))
    q = quarantine.build(bad, rules, source_table, run.run_id, run.run_ts, record_columns)
    return DqFrames(ev, silver, q, rejected, rules)


def run_dq(spark: SparkSession, bronze: DataFrame, rule: dict, source_table: str, target: str,
           quarantine_table: str | None, metrics_table: str | None, run: Run, dq_score: str = "rate",
           **kw) -> dict:
    """Bronze -> silver with writes: two scans of bronze, no cache.

    The quarantine write (or, with quarantine off, a ``noop`` write of the
    same plan) observes rows read / failed / rejected; the silver write
    observes rows written.  Retried tasks do not double-count: observed
    metrics come from the successful task attempts only.

    ``dq_score``: ``rate`` (metrics' dq_score_avg = 1 - error rate) or
    ``rules`` (mean share of passed rules per row, from the same observation)."""
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    kw["with_score"] = dq_score == "rules"
    obs_in = Observation("dq_in")
    f = dq_frames(bronze, rule, source_table, run, observation=obs_in, **kw)
    warnings, observed = [], False
    if quarantine_table and _feature(run, "quarantine"):
        try:  # a failed quarantine write warns and does not stop the run
            io.append(f.quarantine, quarantine_table, part=f"{run.run_id}__{source_table}", run_date=run.run_ts)
            observed = True
        except Exception as ex:  # noqa: BLE001
            warnings.append(f"quarantine write failed: {ex}")
    if not observed:  # quarantine off or failed: count through the same plan, nothing written
        obs_in = Observation("dq_in_count")
        f = dq_frames(bronze, rule, source_table, run, observation=obs_in, **kw)
        f.quarantine.write.format("noop").mode("overwrite").save()
    stats = obs_in.get
    obs_out = Observation("dq_out")
    io.publish(spark, f.silver.observe(obs_out, F.count(F.lit(1)).alias("written")), target, run.run_id,
               cluster_by=rule.get("cluster_by"))
    written = obs_out.get["written"]
    end = datetime.now(timezone.utc).replace(tzinfo=None)
    out = {"records_read": stats["read"], "records_failed": stats["failed"], "records_rejected": stats["rejected"],
           "records_written": written, "duplicates_removed": stats["read"] - stats["failed"] - written,
           "warnings": warnings}
    score = stats["score"] / 100.0 if kw["with_score"] and stats["score"] is not None else None
    if score is not None:
        out["dq_score_avg"] = score
    if metrics_table and _feature(run, "metrics"):
        done = monitor.StageResult("bronze_to_silver", (source_table, target), (start, end),
                                   {"read": out["records_read"], "written": written, "failed": out["records_failed"]}, score=score)
        io.append(monitor.stage_metrics(spark, run.run_id, [done]), metrics_table, part=f"{run.run_id}__bronze_to_silver__{source_table}",
                  run_date=start)  # the day that the reports filter
    return out


def run_scd2(spark: SparkSession, silver: DataFrame, rule: dict, source_table: str, target: str,
             metrics_table: str | None, run: Run, quarantine_table: str | None = None) -> dict:
    """Silver -> gold.  Rows without a business key go to quarantine as
    ``key_null`` (before anything is published; a failed write fails the run,
    as they would be nowhere else) and count as failed.  Reads only the current rows, writes only this run's
    rows (current rows it leaves + rows it closes), checks them, then
    publishes.  Duplicate business keys in the snapshot fail the run."""
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    spec = scd2.ScdSpec.from_rule(rule)
    keyed = silver.filter(F.col(spec.business_key).isNotNull())
    if scd2.duplicate_keys(keyed, spec).limit(1).count():
        raise ValueError(f"{source_table}: duplicate business keys; deduplicate first")
    if quarantine_table and _feature(run, "quarantine"):
        no_key = R.Rule("not_null", spec.business_key, "key_null", "key_null", "business key is null")
        io.append(quarantine.build(scd2.null_keys(silver, spec).withColumn(no_key.flag, F.lit(False)), [no_key], source_table,
                                   run.run_id, run.run_ts), quarantine_table, part=f"{run.run_id}__scd2__{source_table}",
                  run_date=run.run_ts)
    meta = io.dimension_meta(spark, target)
    if meta is None:
        rows, max_sk = scd2.initial_load(silver, spec, run.run_ts), 0
    else:
        cur = io.read_dimension_current(spark, target, spec.is_current)
        max_sk = meta["max_sk"]
        rows = scd2.next_rows(cur, silver, spec, run.run_ts, max_sk, on_missing=rule.get("on_missing", "keep"))
    path = io.write_dimension_run(spark, rows.select(*spec.columns), target, run.run_id, spec.is_current)
    written = io.read_dimension_run(spark, path, spec.is_current)
    bad = scd2.run_checks(written, spec, run.run_ts).filter(F.col("violations") > 0).collect()
    if bad:
        raise ValueError(f"{target}: checks failed {[(r.check, r.violations) for r in bad]}")
    # counts from what the run wrote (no second join): closed now = updated keys,
    # new versions - updated = inserted keys (with on_missing="close", closed keys that
    # got no new version are deletions, counted apart)
    ts = F.lit(run.run_ts).cast("timestamp")
    closed = ~F.col(spec.is_current) & (F.col(spec.valid_to) == ts)
    opened = F.col(spec.is_current) & (F.col(spec.valid_from) == ts)
    if rule.get("on_missing", "keep") == "close":  # tell deletions from updates per key
        keys = written.groupBy(spec.business_key).agg(F.max(closed.cast("int")).alias("c"),
                                                      F.max(opened.cast("int")).alias("o"))
        st = keys.agg(F.count_if((F.col("c") == 1) & (F.col("o") == 1)).alias("updated"),
                      F.count_if((F.col("c") == 0) & (F.col("o") == 1)).alias("inserted"),
                      F.count_if((F.col("c") == 1) & (F.col("o") == 0)).alias("deleted")).first()
    else:  # every closed row has a new version: one global count
        g = written.agg(F.count_if(opened).alias("o"), F.count_if(closed).alias("c")).first()
        st = SimpleNamespace(updated=g.c, inserted=g.o - g.c, deleted=0)
    mx = written.agg(F.max(spec.surrogate_key)).first()[0]
    io.publish_dimension_run(spark, target, run.run_id, max(max_sk, mx or 0), spec.is_current)
    read, no_keys = silver.agg(F.count(F.lit(1)), F.count_if(F.col(spec.business_key).isNull())).first()
    c = {"scd_inserts": st.inserted, "scd_updates": st.updated}
    c["scd_no_changes"] = read - no_keys - c["scd_inserts"] - c["scd_updates"]
    end = datetime.now(timezone.utc).replace(tzinfo=None)
    if metrics_table and _feature(run, "metrics"):
        done = monitor.StageResult("silver_to_gold", (source_table, target), (start, end),
                                   {"read": read, "written": c["scd_inserts"] + c["scd_updates"], "failed": no_keys},
                                   {k: c[f"scd_{k}"] for k in ("inserts", "updates", "no_changes")})
        io.append(monitor.stage_metrics(spark, run.run_id, [done]), metrics_table, part=f"{run.run_id}__silver_to_gold__{source_table}", run_date=start)
    return dict(c, records_read=read, records_failed=no_keys, scd_deleted=st.deleted)


def run_config(spark: SparkSession, configs: list[ConfigEntry], resolve_source, resolve_target,
               run: Run, quarantine_table: str | None = None, metrics_table: str | None = None,
               history_table: str | None = None, lineage_table: str | None = None,
               pipeline_name: str = "medallion", run_type: str = "manual", whitelist: DataFrame | None = None,
               dq_rules: DataFrame | None = None) -> list[dict]:
    """Run active configs in dependency order; a failure skips its dependents.

    ``resolve_source(name) -> DataFrame`` and ``resolve_target(name) -> str``
    bind the config's logical table names to data and locations.  One
    ``pipeline_run_history`` row describes the whole run and, when the
    environment's lineage flag is on, one ``table_lineage`` row each config.
    ``whitelist`` and ``dq_rules`` (the service tables) hold for every ``dq_check``; their
    ``table_name`` is the config's source table, with or without its namespace.
    """
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    results = _run_configs(spark, configs, resolve_source, resolve_target, run, quarantine_table, metrics_table,
                           whitelist, dq_rules)
    ended = datetime.now(timezone.utc).replace(tzinfo=None)
    ok = [r for r in results if r["status"] == "succeeded"]
    bad = [r for r in results if r["status"] == "failed"]
    if history_table:
        io.append(monitor.run_row(
            spark, run.run_id, pipeline_name, "failed" if bad else "succeeded", started, ended,
            processed=sum(r.get("records_read", 0) or 0 for r in ok),
            failed=sum(r.get("records_failed", 0) or 0 for r in ok), tables=len(ok), run_type=run_type,
            error_message="; ".join(f"{r['config_id']}: {r['error']}" for r in bad) or None,
            error_stack_trace="\n".join(r["trace"] for r in bad) or None, environment=run.environment), history_table,
            part=run.run_id, run_date=started)
    if lineage_table and _feature(run, "lineage"):
        by_id = {e.config_id: e for e in configs}
        for r in ok:
            e = by_id[r["config_id"]]
            io.append(monitor.lineage_row(spark, e.source_table, e.target_table, e.rule_type, run.run_id,
                                          r.get("records_written", r.get("records_read")), ended), lineage_table,
                      part=f"{run.run_id}__{e.config_id}", run_date=run.run_ts)
    return results


def _for_table(rows: DataFrame | None, source_table: str) -> DataFrame | None:
    """The service-table rows of a source table, under the name that the config uses."""
    if rows is None:
        return None
    names = {source_table, source_table.split(".")[-1]}
    return rows.where(F.col("table_name").isin(*names)).withColumn("table_name", F.lit(source_table))


def _run_configs(spark, configs, resolve_source, resolve_target, run, quarantine_table, metrics_table,
                 whitelist=None, dq_rules=None):
    results, failed = [], set()
    for e in execution_order(configs):
        if any(d in failed for d in e.depends_on):
            failed.add(e.config_id)
            results.append({"config_id": e.config_id, "status": "skipped"})
            continue
        if e.rule_type == "scd2" and not _feature(run, "scd2"):
            results.append({"config_id": e.config_id, "status": "skipped"})
            continue
        try:
            src = resolve_source(e.source_table)
            tgt = resolve_target(e.target_table)
            if e.rule_type == "dq_check":
                out = run_dq(spark, src, e.rule, e.source_table, tgt, quarantine_table, metrics_table, run,
                             whitelist=_for_table(whitelist, e.source_table), dq_rules=_for_table(dq_rules, e.source_table))
            elif e.rule_type == "scd2":
                out = run_scd2(spark, src, e.rule, e.source_table, tgt, metrics_table, run, quarantine_table)
            elif e.rule_type == "simple_copy":
                df = src.select(*e.rule["columns"])
                if e.rule.get("write_mode", "overwrite") == "append":
                    io.append(df, tgt, part=f"{run.run_id}__{e.config_id}", run_date=run.run_ts)  # a retry replaces its rows
                else:
                    io.publish(spark, df, tgt, run.run_id, cluster_by=e.rule.get("cluster_by"))
                out = {}
            elif e.rule_type == "aggregate":
                io.publish(spark, aggregate_rule(src, e.rule), tgt, run.run_id)
                out = {}
            else:
                raise ValueError(f"unknown rule_type {e.rule_type}")
            results.append(dict(out, config_id=e.config_id, status="succeeded"))
        except Exception as ex:  # the run goes on; dependents are skipped
            failed.add(e.config_id)
            results.append({"config_id": e.config_id, "status": "failed", "error": str(ex),
                            "trace": traceback.format_exc()})
    return results


def run_retention(spark: SparkSession, tables: dict[str, str], run: Run) -> dict[str, int]:
    """Purge the appended service tables (name -> path) by the environment's retention days; returns rows kept."""
    rules = {"quarantine_records": ("created_at", "quarantine_retention_days"),
             "pipeline_metrics": ("created_at", "metrics_retention_days"),
             "pipeline_run_history": ("start_time", "metrics_retention_days")}
    return {name: io.purge(spark, path, rules[name][0], run.run_ts, run.settings[rules[name][1]])
            for name, path in tables.items() if name in rules}
