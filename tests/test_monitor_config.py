import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import monitor
from strata.sources import config as C
from strata.sources.schemas import PIPELINE_METRICS, QUARANTINE_RECORDS, conform, missing_required

NOW = dt.datetime(2024, 1, 30, 3, 0, 0)


def test_metrics_row_with_null_scd_fields(spark):
    # the reference's metric row never landed: all-null columns cannot be inferred
    m = monitor.stage_metrics(spark, "r1", [monitor.StageResult(
        "bronze_to_silver", ("contact", "silver.contact"), (NOW - dt.timedelta(seconds=5), NOW), {"read": 10, "written": 8, "failed": 2})])
    r = m.first()
    assert m.schema == PIPELINE_METRICS
    assert (r.error_rate, r.dq_score_avg, r.duration_sec, r.scd_inserts) == (0.2, 0.8, 5.0, None)
    assert r.pipeline_name == "bronze_to_silver_contact"
    z = monitor.stage_metrics(spark, "r2", [monitor.StageResult("bronze_to_silver", ("c", "t"), (NOW, NOW), {})]).first()
    assert z.error_rate == 0.0


def _metrics(spark):
    rows = []
    for i, (stage, table, rate, dur, day) in enumerate([
            ("bronze_to_silver", "contact", 0.2, 100.0, 30), ("silver_to_gold", "contact", 0.0, 8000.0, 30),
            ("bronze_to_silver", "account", 0.01, 50.0, 29), ("bronze_to_silver", "contact", 0.05, 60.0, 10)]):
        t = dt.datetime(2024, 1, day, 2, 0, 0)
        versions = {"inserts": 3, "updates": 2, "no_changes": 95} if stage == "silver_to_gold" else {}
        rows.append(monitor.stage_metrics(spark, f"r{i}", [monitor.StageResult(
            stage, (table, "x"), (t, t + dt.timedelta(seconds=dur)), {"read": 100, "written": 90, "failed": int(rate * 100)}, versions,
            pipeline=f"p_{table}")]))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def test_views(spark):
    m = _metrics(spark)
    rec = monitor.metrics_recent(m, "2024-01-30").collect()
    assert sorted((r.run_date.day, r.source_table, r.stage) for r in rec) == \
        [(29, "account", "bronze_to_silver"), (30, "contact", "bronze_to_silver"), (30, "contact", "silver_to_gold")]
    f = {(r.source_table, r.stage): r.stage_order for r in monitor.funnel(m, "2024-01-30").collect()}
    assert f == {("contact", "bronze_to_silver"): 1, ("contact", "silver_to_gold"): 2}
    act = monitor.scd_activity(m, "2024-01-30").first()
    assert (act.new_records, act.changed_records, act.total_changes) == (3, 2, 5)
    piv = {r.source_table: r for r in monitor.stage_durations(m).collect()}
    assert piv["contact"].silver_to_gold == 8000.0


def test_health_alerts(spark):
    m = _metrics(spark)
    runs = monitor.run_row(spark, "r9", "p", "failed", NOW, NOW, error_message="boom")
    q = spark.createDataFrame(
        [(f"q{i}", "contact", "run", "email_invalid", None, None, "{}", "new", None, None, None,
          dt.datetime(2024, 1, d, 1)) for i, d in enumerate([22, 23, 24, 25, 26, 27, 28] + [30] * 10)],
        QUARANTINE_RECORDS)
    a = monitor.health(m, runs, q, 0.10, "2024-01-30")
    kinds = sorted((r.alert_type, r.subject) for r in a.collect())
    assert kinds == [("high_error_rate", "contact"), ("long_run", "contact"), ("quarantine_spike", "contact"),
                     ("run_failed", "p")]
    qs = monitor.quarantine_summary(q, "2024-01-30").first()
    assert qs.error_count == 17
    assert monitor.top_errors(q, "2024-01-30").first().error_count == 16  # 7 days: from the 23rd


def test_success_rate_and_purge(spark):
    runs = monitor.run_row(spark, "a", "p", "succeeded", NOW, NOW).unionByName(
        monitor.run_row(spark, "b", "p", "failed", NOW, NOW)).unionByName(
        monitor.run_row(spark, "c", "p", "succeeded", NOW, NOW))
    r = monitor.success_rate(runs, "2024-01-30").first()
    assert (r.total_runs, r.successful_runs, r.failed_runs, r.success_rate_pct) == (3, 2, 1, 66.67)
    old = monitor.run_row(spark, "o", "p", "succeeded", NOW - dt.timedelta(days=100), NOW)
    kept = monitor.purge(runs.unionByName(old), "start_time", NOW, 90)
    assert kept.count() == 3


def test_conform_and_required(spark):
    df = spark.createDataFrame([("r", 5)], "run_id string, records_read int")
    c = conform(df, PIPELINE_METRICS)
    assert c.columns == [f.name for f in PIPELINE_METRICS.fields]
    assert dict(c.dtypes)["records_read"] == "bigint"
    assert "metric_id" in missing_required(df, PIPELINE_METRICS)


def test_load_config_fallback():
    assert C.load_config("prod")["error_threshold"] == 0.02
    assert C.load_config("nope")["bronze"] == "hs_bronze_dev"


def _entry(cid, deps=(), active=True, prio=10):
    return C.ConfigEntry(cid, "s", "t", "silver", "dq_check", {}, prio, active, list(deps))


def test_execution_order():
    es = [_entry("b", ["a"], prio=1), _entry("a", prio=20), _entry("c"), _entry("d", ["c"]), _entry("e", active=False),
          _entry("f", ["e"])]
    order = [e.config_id for e in C.execution_order(es)]
    assert order == ["c", "a", "b", "d"]  # depth first, then priority; f skipped with its inactive parent
    with pytest.raises(ValueError):
        C.execution_order([_entry("x", ["y"]), _entry("y", ["x"])])
    with pytest.raises(ValueError):
        C.execution_order([_entry("x", ["missing"])])


def test_seed_configs_and_idempotent_seeding(spark):
    cfg = C.seed_frame(spark, NOW)
    assert cfg.count() == 6
    again = C.new_configs(cfg, C.seed_frame(spark, NOW))
    assert again.count() == 0
    parsed = C.parse_rules(cfg).filter(F.col("rule_type") == "scd2").select("config_id", "rule_scd2.business_key")
    assert sorted(r.business_key for r in parsed.collect()) == ["accountid", "contactid"]
    entries = C.read_configs(cfg)
    order = [e.config_id for e in C.execution_order(entries)]
    assert order.index("contact_bronze_silver_dq") < order.index("contact_silver_gold_scd2")
    rep = {(r.target_layer, r.rule_type): r.config_count for r in monitor.config_report(cfg).collect()}
    assert rep == {("gold", "scd2"): 2, ("gold", "simple_copy"): 1, ("silver", "dq_check"): 3}


def test_session_settings(spark):
    s = C.session_settings("prod")
    assert s["spark.sql.shuffle.partitions"] == "400"
    big = C.session_settings("prod", input_bytes=100 * 2 ** 40)  # 100 TB
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (256 * 2 ** 20))
    from strata.sources import io
    assert io.input_bytes(spark, ["/root/testdata/sf0.001/orders.parquet"]) > 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        C.apply_session_settings(spark, "dev")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_table_name():
    env = C.load_config("test")
    assert C.table_name(env["silver"], "contact") == "hs_silver_test.contact"
