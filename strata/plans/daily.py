"""The daily run end to end: the six seeded configurations (contact,
account, course: bronze -> silver -> gold) in dependency order, with
quarantine, metrics, run history and lineage written to one root folder,
then the monitoring views and health alerts over what the run wrote.

Bronze tables are bound to the inputs derived from the test tables; a
deployment binds its own through ``resolve_source``.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import jobs, monitor
from strata.sources import config as C
from strata.sources import derived as D
from strata.sources import io


def bronze_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"bronze.contact": D.bronze_contact(spark, sf_dir),
            "bronze.account": D.bronze_account(spark, sf_dir),
            "bronze.hs_course": D.bronze_course(spark, sf_dir)}


def run_daily(spark: SparkSession, sources: dict[str, DataFrame], root: str, run: jobs.Run,
              configs: list[C.ConfigEntry] | None = None) -> dict:
    """Run every active config once; returns per-config results, the health
    alerts and the row counts of the written tables."""
    root = root.rstrip("/")
    svc = {n: f"{root}/monitoring/{n}" for n in ("quarantine_records", "pipeline_metrics",
                                                  "pipeline_run_history", "table_lineage")}
    entries = configs or C.read_configs(C.seed_frame(spark, run.run_ts))

    def resolve_target(name: str) -> str:
        return f"{root}/{name.replace('.', '/')}"

    def resolve_source(name: str) -> DataFrame:
        if name in sources:
            return sources[name]
        return io.read_current(spark, resolve_target(name))

    results = jobs.run_config(spark, entries, resolve_source, resolve_target, run, svc["quarantine_records"],
                              svc["pipeline_metrics"], svc["pipeline_run_history"], svc["table_lineage"],
                              pipeline_name="medallion_daily", run_type="scheduled")
    metrics = spark.read.parquet(svc["pipeline_metrics"])
    runs = spark.read.parquet(svc["pipeline_run_history"])
    quarantine = spark.read.parquet(svc["quarantine_records"]) if io.path_exists(spark, svc["quarantine_records"]) \
        else None
    # the day this run's metrics were written (their times are wall-clock)
    today = metrics.filter(F.col("run_id") == run.run_id).agg(F.max(F.to_date("start_time"))).first()[0]
    alerts = monitor.health(metrics, runs, quarantine, run.settings.get("error_threshold", 0.10), today).collect()
    return {"results": results, "alerts": [a.asDict() for a in alerts]}
