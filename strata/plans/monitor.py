"""Monitoring: metric / run / lineage rows, the dashboard views, health alerts.

Views take ``today`` as a parameter (the reference's ``CURRENT_DATE()``), so a
report is reproducible and testable; pass ``F.current_date()`` for live use.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.schemas import PIPELINE_METRICS, PIPELINE_RUN_HISTORY, TABLE_LINEAGE, conform

# Fixed value: the stage order of the funnel report.
STAGE_ORDER = {"bronze_to_silver": 1, "silver_to_gold": 2}
LONG_RUN_SEC = 7200
SPIKE_FACTOR = 3.0


def _id(*parts) -> str:
    return hashlib.md5("|".join("" if p is None else str(p) for p in parts).encode()).hexdigest()


@dataclass
class StageResult:
    """What one stage of a run did: where from and to, when, its row counts (``read``, ``written``, ``failed``) and, for a
    history, its version counts (``inserts``, ``updates``, ``no_changes``)."""
    stage: str
    flow: tuple[str, str]
    span: tuple[datetime, datetime]
    rows: dict[str, int]
    versions: dict[str, int] = field(default_factory=dict)
    score: float | None = None
    pipeline: str | None = None


def stage_metrics(spark: SparkSession, run_id: str, results: list[StageResult]) -> DataFrame:
    """The ``pipeline_metrics`` rows of a run's stages.  Ids follow from run, stage and flow, so a retry gives the
    same; without rows read the error rate is 0; the score is 1 less the error rate where a stage measured none."""
    made = [(r.stage, *r.flow, r.pipeline or f"{r.stage}_{r.flow[0]}", *r.span, *[r.rows.get(k, 0) for k in ("read", "written", "failed")],
             *[r.versions.get(k) for k in ("inserts", "updates", "no_changes")], r.score) for r in results]
    facts = spark.createDataFrame(made, "stage string, source_table string, target_table string, pipeline_name string, start_time timestamp, "
                                        "end_time timestamp, records_read long, records_written long, records_failed long, scd_inserts long, "
                                        "scd_updates long, scd_no_changes long, score double")
    seconds = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 1e6
    rate = F.coalesce(F.try_divide(F.col("records_failed").cast("double"), F.col("records_read").cast("double")), F.lit(0.0))
    out = (facts.withColumn("run_id", F.lit(run_id)).withColumn("metric_id", F.md5(F.concat_ws("|", "run_id", "stage", "source_table", "target_table")))
           .withColumn("duration_sec", seconds).withColumn("error_rate", rate)
           .withColumn("dq_score_avg", F.coalesce("score", F.lit(1.0) - F.col("error_rate"))).withColumn("created_at", F.col("end_time")))
    return spark.createDataFrame(conform(out, PIPELINE_METRICS).collect(), PIPELINE_METRICS)  # a row a stage; required columns checked


def run_row(spark: SparkSession, run_id: str, pipeline_name: str, run_status: str, start_time: datetime,
            end_time: datetime | None, processed: int = 0, failed: int = 0, tables: int = 0,
            run_type: str = "manual", error_message: str | None = None, error_stack_trace: str | None = None,
            triggered_by: str | None = None, environment: str | None = None,
            workspace: str | None = None) -> DataFrame:
    row = (run_id, pipeline_name, run_status, run_type, start_time, end_time,
           (end_time - start_time).total_seconds() if end_time else None, processed, failed, tables,
           error_message, error_stack_trace, triggered_by, environment, workspace, end_time or start_time)
    return spark.createDataFrame([row], PIPELINE_RUN_HISTORY)


def lineage_row(spark: SparkSession, source_table: str, target_table: str, transformation_type: str,
                run_id: str, records: int, at: datetime) -> DataFrame:
    row = (_id(run_id, source_table, target_table), source_table, target_table, transformation_type,
           run_id, records, at)
    return spark.createDataFrame([row], TABLE_LINEAGE)


def summary(metrics: DataFrame) -> DataFrame:
    """Run summary numbers as a DataFrame (rate guarded against zero reads)."""
    return metrics.select(
        "run_id", "pipeline_name", "records_read", "records_written", "records_failed", "duration_sec",
        F.when(F.col("records_read") > 0, F.col("records_failed") / F.col("records_read"))
        .otherwise(F.lit(0.0)).alias("error_rate"),
        F.when(F.col("duration_sec") > 0, F.col("records_read") / F.col("duration_sec")).alias("records_per_sec"))


def _days_back(today, days: int) -> Column:
    return F.date_sub(F.lit(today).cast("date") if not isinstance(today, Column) else today, days)


def _since(df: DataFrame, ts_col: str, today, days: int) -> DataFrame:
    """Rows of the last ``days`` days.  Tables written per run carry a
    ``run_date`` partition column; a filter on it (one day of slack for runs
    crossing midnight) lets Spark skip older folders entirely."""
    start = _days_back(today, days)
    cond = F.col(ts_col) >= start.cast("timestamp")
    if "run_date" in df.columns:
        cond = cond & (F.col("run_date") >= F.date_sub(start, 1))
    return df.filter(cond)


# --------------------------------------------------------------------------- views

def metrics_recent(m: DataFrame, today, days: int = 7) -> DataFrame:
    d = F.to_date("start_time")
    return (_since(m, "start_time", today, days)
            .groupBy(d.alias("run_date"), "stage", "source_table")
            .agg(F.sum("records_read").alias("total_records_read"),
                 F.sum("records_written").alias("total_records_written"),
                 F.sum("records_failed").alias("total_records_failed"),
                 F.avg("error_rate").alias("avg_error_rate"),
                 F.avg("duration_sec").alias("avg_duration_sec"),
                 F.count(F.lit(1)).alias("run_count")))


def quarantine_summary(q: DataFrame, today, days: int = 30) -> DataFrame:
    return (_since(q, "created_at", today, days)
            .groupBy("source_table", "error_type", "status")
            .agg(F.count(F.lit(1)).alias("error_count"),
                 F.min("created_at").alias("first_occurrence"),
                 F.max("created_at").alias("last_occurrence")))


def success_rate(runs: DataFrame, today, days: int = 30) -> DataFrame:
    ok = F.count_if(F.col("run_status") == "succeeded")
    return (_since(runs, "start_time", today, days)
            .groupBy("pipeline_name", F.to_date("start_time").alias("run_date"))
            .agg(F.count(F.lit(1)).alias("total_runs"), ok.alias("successful_runs"),
                 F.count_if(F.col("run_status") == "failed").alias("failed_runs"))
            .withColumn("success_rate_pct",
                        F.round(F.col("successful_runs") * 100.0 / F.col("total_runs"), 2).cast("double")))


def funnel(m: DataFrame, today) -> DataFrame:
    order = F.coalesce(*[F.when(F.col("stage") == s, F.lit(i)) for s, i in STAGE_ORDER.items()])
    return (m.filter(F.to_date("start_time") == F.lit(today).cast("date"))
            .groupBy("source_table", "stage")
            .agg(F.sum("records_read").alias("input_records"),
                 F.sum("records_written").alias("output_records"),
                 F.sum("records_failed").alias("failed_records"),
                 F.round(F.avg("error_rate") * 100, 2).alias("error_rate_pct"))
            .withColumn("stage_order", order))


def top_errors(q: DataFrame, today, days: int = 7, n: int = 10) -> DataFrame:
    """The n most frequent new error types (a top-n report)."""
    return (_since(q, "created_at", today, days).filter(F.col("status") == "new")
            .groupBy("source_table", "error_type")
            .agg(F.count(F.lit(1)).alias("error_count"), F.max("created_at").alias("last_seen"))
            .orderBy(F.desc("error_count"), "source_table", "error_type").limit(n))


def scd_activity(m: DataFrame, today, days: int = 30) -> DataFrame:
    return (_since(m, "start_time", today, days).filter(F.col("stage") == "silver_to_gold")
            .groupBy(F.to_date("start_time").alias("activity_date"), "source_table")
            .agg(F.sum("scd_inserts").alias("new_records"), F.sum("scd_updates").alias("changed_records"),
                 F.sum("scd_no_changes").alias("unchanged_records"),
                 F.sum(F.col("scd_inserts") + F.col("scd_updates")).alias("total_changes")))


def stage_durations(m: DataFrame) -> DataFrame:
    """Average duration per table, one column per stage (bottleneck table)."""
    return m.groupBy("source_table").pivot("stage", list(STAGE_ORDER)).agg(F.avg("duration_sec"))


def error_report(m: DataFrame, today) -> DataFrame:
    """Runs since the start of ``today`` per date, stage and table (the
    cross-stage report; sort by ``avg_error_rate`` desc when displaying)."""
    return (m.filter(F.col("start_time") >= F.lit(today).cast("date").cast("timestamp"))
            .groupBy(F.to_date("start_time").alias("run_date"), "stage", "source_table")
            .agg(F.sum("records_read").alias("total_records"), F.sum("records_failed").alias("total_errors"),
                 F.avg("error_rate").alias("avg_error_rate"), F.avg("duration_sec").alias("avg_duration")))


def stage_averages(m: DataFrame, today, days: int = 7) -> DataFrame:
    """Per stage and table over the last ``days`` days."""
    return (_since(m, "start_time", today, days)
            .groupBy("stage", "source_table")
            .agg(F.avg("error_rate").alias("avg_error_rate"), F.avg("duration_sec").alias("avg_duration"),
                 F.sum("records_written").alias("total_records")))


def new_errors(q: DataFrame) -> DataFrame:
    """Open quarantine records per table and type (the quarantine dashboard)."""
    return (q.filter(F.col("status") == "new").groupBy("source_table", "error_type")
            .agg(F.count(F.lit(1)).alias("error_count"), F.max("created_at").alias("last_occurrence")))


def error_rate_pct(m: DataFrame) -> DataFrame:
    return m.groupBy("source_table").agg((F.avg("error_rate") * 100).alias("avg_error_rate_pct"))


def table_overview(m: DataFrame, today, days: int = 7) -> DataFrame:
    """Per day, table and stage: rows in / out / failed, rounded mean duration."""
    return (_since(m, "start_time", today, days)
            .groupBy(F.to_date("start_time").alias("run_date"), F.col("source_table").alias("table_name"), "stage")
            .agg(F.sum("records_read").alias("total_in"), F.sum("records_written").alias("total_out"),
                 F.sum("records_failed").alias("total_failed"),
                 F.round(F.avg("duration_sec"), 2).alias("avg_duration_sec")))


# --------------------------------------------------------------------------- health

def health(m: DataFrame, runs: DataFrame | None, q: DataFrame | None, error_threshold: float,
           today, long_run_sec: int = LONG_RUN_SEC, spike_factor: float = SPIKE_FACTOR) -> DataFrame:
    """Alert rows (alert_type, subject, alert_date, value, threshold).

    - high_error_rate: a metric row over the environment's threshold
    - long_run: a metric row over ``long_run_sec``
    - run_failed: a failed run
    - quarantine_spike: a day's quarantine count per table above
      ``spike_factor`` x the average of the 7 days before it
    Only rows of ``today`` are reported.
    """
    day = F.lit(today).cast("date")
    m_today = m.filter(F.to_date("start_time") == day)
    parts = [
        m_today.filter(F.col("error_rate") > error_threshold).select(
            F.lit("high_error_rate").alias("alert_type"), F.col("source_table").alias("subject"),
            F.to_date("start_time").alias("alert_date"), F.col("error_rate").alias("value"),
            F.lit(float(error_threshold)).alias("threshold"), F.col("run_id")),
        m_today.filter(F.col("duration_sec") > long_run_sec).select(
            F.lit("long_run").alias("alert_type"), F.col("source_table").alias("subject"),
            F.to_date("start_time").alias("alert_date"), F.col("duration_sec").alias("value"),
            F.lit(float(long_run_sec)).alias("threshold"), F.col("run_id")),
    ]
    if runs is not None:
        parts.append(runs.filter((F.to_date("start_time") == day) & (F.col("run_status") == "failed")).select(
            F.lit("run_failed").alias("alert_type"), F.col("pipeline_name").alias("subject"),
            F.to_date("start_time").alias("alert_date"), F.lit(1.0).alias("value"),
            F.lit(0.0).alias("threshold"), F.col("run_id")))
    if q is not None:
        # eight days of rows are read, however long the history is
        week = _since(q, "created_at", today, 7).filter(F.to_date("created_at") <= day)
        daily = week.groupBy("source_table", F.to_date("created_at").alias("d")).agg(F.count(F.lit(1)).alias("n"))
        spikes = daily.groupBy("source_table").agg(F.max(F.when(F.col("d") == day, F.col("n"))).alias("n"),
                                                   F.avg(F.when(F.col("d") < day, F.col("n"))).alias("avg7"))
        parts.append(spikes.filter(F.col("n") > spike_factor * F.col("avg7")).withColumn("d", day)
                     .select(F.lit("quarantine_spike").alias("alert_type"), F.col("source_table").alias("subject"),
                             F.col("d").alias("alert_date"), F.col("n").cast("double").alias("value"),
                             (F.col("avg7") * spike_factor).alias("threshold"),
                             F.lit(None).cast("string").alias("run_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def config_report(cfg: DataFrame) -> DataFrame:
    return (cfg.groupBy("target_layer", "rule_type")
            .agg(F.count(F.lit(1)).alias("config_count"),
                 F.count_if(F.coalesce(F.col("active"), F.lit(False))).alias("active_count")))


def volume(dim: DataFrame, is_current: str = "is_current") -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(is_current)).alias("current_rows"))


def purge(df: DataFrame, ts_col: str, now, days: int) -> DataFrame:
    """Rows young enough to keep under a retention of ``days`` days."""
    return df.filter(F.col(ts_col) >= (F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))))


def to_metrics(df: DataFrame) -> DataFrame:
    return conform(df, PIPELINE_METRICS)
