"""End-to-end jobs with writes: bronze -> silver -> gold, publish, rerun, config run."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import quarantine as Q
from strata.plans import jobs
from strata.sources import config as C
from strata.sources import derived as D
from strata.sources import io


def _rule():
    r = dict(C.seed_rule("contact_bronze_silver_dq"))
    r["validations"] = C.CONTACT_RULES
    r["deduplication"] = dict(r["deduplication"], tie_breakers=["versionnumber"])
    return r


def test_io_publish_and_service_tables(spark, tmpdir_path):
    made = io.create_service_tables(spark, tmpdir_path)
    assert len(made) == 7 and io.create_service_tables(spark, tmpdir_path) == []
    t = os.path.join(tmpdir_path, "tbl")
    assert io.read_current(spark, t) is None
    io.publish(spark, spark.range(3), t, "v1")
    io.publish(spark, spark.range(5), t, "v2")
    assert io.current_version(spark, t) == "v2" and io.read_current(spark, t).count() == 5
    assert spark.read.parquet(io.version_path(t, "v1")).count() == 3  # the old version is intact


def test_run_dq_and_scd2(spark, tmpdir_path):
    run = jobs.Run("20240101_020000", dt.datetime(2024, 1, 1, 2))
    bronze = D.bronze_contact(spark, SF_SMALL)
    silver_t, gold_t = os.path.join(tmpdir_path, "silver_contact"), os.path.join(tmpdir_path, "dim_contact")
    q_t, m_t = os.path.join(tmpdir_path, "quarantine_records"), os.path.join(tmpdir_path, "pipeline_metrics")
    out = jobs.run_dq(spark, bronze, _rule(), "contact", silver_t, q_t, m_t, run,
                      silver_columns=C.CONTACT_SILVER_COLUMNS + ["versionnumber"],
                      record_columns=C.CONTACT_RECORD_COLUMNS)
    n = bronze.count()
    silver = io.read_current(spark, silver_t)
    assert out["records_read"] == n
    assert out["records_written"] == silver.count() == silver.select("contactid").distinct().count()
    assert spark.read.parquet(q_t).count() == out["records_failed"]
    assert out["duplicates_removed"] == n - out["records_failed"] - out["records_written"]
    m = spark.read.parquet(m_t).first()
    assert m.records_read == n and m.stage == "bronze_to_silver"

    scd = C.seed_rule("contact_silver_gold_scd2")
    r1 = jobs.run_scd2(spark, silver, scd, "contact", gold_t, m_t, run)
    dim1 = io.read_dimension(spark, gold_t)
    meta1 = io.dimension_meta(spark, gold_t)
    assert r1["scd_inserts"] == dim1.count() == silver.count() == meta1["max_sk"]
    # second run: change some e-mails
    changed = silver.withColumn("emailaddress1", F.when(F.col("contactid").cast("int") % 5 == 0,
                                                        F.concat(F.lit("n"), F.col("emailaddress1")))
                                .otherwise(F.col("emailaddress1")))
    run2 = jobs.Run("20240102_020000", dt.datetime(2024, 1, 2, 2))
    r2 = jobs.run_scd2(spark, changed, scd, "contact", gold_t, m_t, run2)
    dim2 = io.read_dimension(spark, gold_t)
    n5 = changed.filter(F.col("contactid").cast("int") % 5 == 0).count()
    assert r2["scd_updates"] == n5 and r2["scd_inserts"] == 0
    assert dim2.count() == dim1.count() + n5 and dim2.filter("is_current").count() == dim1.count()
    assert dim2.select("contact_sk").distinct().count() == dim2.count()
    from strata.operators import scd2 as S
    assert all(r.violations == 0 for r in S.check_counts(dim2, S.ScdSpec.from_rule(scd)).collect())
    # run 2 wrote only current rows and the rows it closed, not the history
    assert spark.read.parquet(os.path.join(gold_t, "run=" + run2.run_id)).count() == dim1.count() + n5
    # a published run is never rewritten; a crashed (unpublished) one is retried in place
    n_dim2 = dim2.count()
    run2b = jobs.Run("20240102_020000", dt.datetime(2024, 1, 2, 2))
    with pytest.raises(ValueError):
        jobs.run_scd2(spark, changed, scd, "contact", gold_t, m_t, run2b)
    io._write_text(spark, os.path.join(gold_t, "_CURRENT"), json.dumps(meta1))  # publish of run 2 "lost"
    assert io.read_dimension(spark, gold_t).count() == dim1.count()  # the crashed run's rows are invisible
    jobs.run_scd2(spark, changed, scd, "contact", gold_t, m_t, run2b)
    assert io.read_dimension(spark, gold_t).count() == n_dim2
    # quarantine review / repair on what was written
    q = spark.read.parquet(q_t)
    dec = q.limit(2).select("quarantine_id", F.lit("ignored").alias("status"), F.lit("ok").alias("resolution_notes"),
                            F.lit("me").alias("resolved_by"), F.lit(None).cast("timestamp").alias("resolved_at"))
    res = Q.resolve(q, dec)
    assert res.filter("status = 'ignored'").count() == 2 and res.count() == q.count()


def test_run_config_dependency_skip(spark, tmpdir_path):
    run = jobs.Run("20240101_020000", dt.datetime(2024, 1, 1, 2))
    cfg = C.read_configs(C.seed_frame(spark, run.run_ts))
    sources = {"bronze.hs_course": D.bronze_course(spark, SF_SMALL),
               "bronze.account": D.bronze_account(spark, SF_SMALL).drop("modifiedon")}  # dedup fails

    def resolve_source(name):
        if name in sources:
            return sources[name]
        if name.startswith("silver."):
            return io.read_current(spark, os.path.join(tmpdir_path, name))
        raise KeyError(name)

    res = jobs.run_config(spark, [e for e in cfg if not e.config_id.startswith("contact")], resolve_source,
                          lambda n: os.path.join(tmpdir_path, n), run,
                          os.path.join(tmpdir_path, "quarantine_records"), os.path.join(tmpdir_path, "pipeline_metrics"))
    st = {r["config_id"]: r["status"] for r in res}
    assert st["hs_course_bronze_silver_dq"] == "succeeded" and st["hs_course_silver_gold_fact"] == "succeeded"
    assert st["account_bronze_silver_dq"] == "failed" and st["account_silver_gold_scd2"] == "skipped"
    fact = io.read_current(spark, os.path.join(tmpdir_path, "gold.fact_course"))
    assert fact.columns == C.seed_rule("hs_course_silver_gold_fact")["columns"]


def test_run_dq_without_quarantine_counts_the_same(spark, tmpdir_path):
    run = jobs.Run("r_noq", dt.datetime(2024, 1, 1, 2))
    bronze = D.bronze_contact(spark, SF_SMALL)
    out = jobs.run_dq(spark, bronze, _rule(), "contact", os.path.join(tmpdir_path, "s"), None, None, run)
    assert out["records_read"] == bronze.count() and out["records_failed"] > 0
    assert not os.path.exists(os.path.join(tmpdir_path, "quarantine_records"))


def test_diff_with_duplicate_keys(spark):
    from strata.operators import compare
    a = spark.createDataFrame([("k", 1), ("k", 2), ("x", 1), ("y", 5)], "id string, v int")
    b = spark.createDataFrame([("k", 2), ("k", 1), ("x", 2), ("z", 1)], "id string, v int")
    got = {r.id: r.side for r in compare.diff(a, b, ["id"]).collect()}
    assert got == {"x": "changed", "y": "only_in_a", "z": "only_in_b"}  # k: same multiset of rows
    c = spark.createDataFrame([("k", 1), ("k", 1)], "id string, v int")
    assert {r.id: r.side for r in compare.diff(a.filter("id = 'k'"), c, ["id"]).collect()} == {"k": "changed"}


def test_rerun_of_a_job_does_not_duplicate_service_rows(spark, tmpdir_path):
    run = jobs.Run("r_twice", dt.datetime(2024, 1, 1, 2))
    bronze = D.bronze_contact(spark, SF_SMALL)
    q_t, m_t = os.path.join(tmpdir_path, "quarantine_records"), os.path.join(tmpdir_path, "pipeline_metrics")
    out = None
    for attempt in range(2):  # the first attempt "crashed" before publishing
        out = jobs.run_dq(spark, bronze, _rule(), "contact", os.path.join(tmpdir_path, f"s{attempt}"), q_t, m_t, run)
    assert spark.read.parquet(q_t).count() == out["records_failed"]
    assert spark.read.parquet(m_t).count() == 1


def test_inventory_purge_typed_frame_lineage(spark, tmpdir_path):
    from strata.plans import monitor
    from strata.sources.schemas import PIPELINE_RUN_HISTORY, TABLE_LINEAGE
    root = tmpdir_path
    io.publish(spark, spark.range(3), os.path.join(root, "dim"), "v1")
    now = dt.datetime(2024, 3, 1)
    rows = [monitor.run_row(spark, f"r{i}", "p", "succeeded", now - dt.timedelta(days=d), now)
            for i, d in enumerate([1, 10, 200])]
    hist = rows[0].unionByName(rows[1]).unionByName(rows[2])
    io.append(hist, os.path.join(root, "pipeline_run_history"))
    inv = {r.table_name: (r.kind, r.current_version) for r in io.inventory(spark, root).collect()}
    assert inv == {"dim": ("versioned", "v1"), "pipeline_run_history": ("appended", None)}
    kept = io.purge(spark, os.path.join(root, "pipeline_run_history"), "start_time", now, 90, "p1")
    assert kept == 2 and spark.read.parquet(os.path.join(root, "pipeline_run_history")).count() == 2
    tf = io.typed_frame(spark, PIPELINE_RUN_HISTORY, [])
    assert tf.schema == PIPELINE_RUN_HISTORY and tf.count() == 0
    assert io.preview(spark.range(10), n=3).count() == 3
    # lineage rows from a config run with the flag on (test environment)
    run = jobs.Run("r_lin", dt.datetime(2024, 1, 1, 2), "test", C.load_config("test"))
    cfg = [e for e in C.read_configs(C.seed_frame(spark, run.run_ts)) if e.config_id.startswith("hs_course")]
    src = {"bronze.hs_course": D.bronze_course(spark, SF_SMALL)}
    res = jobs.run_config(spark, cfg, lambda n: src[n] if n in src else io.read_current(spark, os.path.join(root, n)),
                          lambda n: os.path.join(root, n), run, history_table=os.path.join(root, "history2"),
                          lineage_table=os.path.join(root, "table_lineage"))
    assert all(r["status"] == "succeeded" for r in res)
    lin = spark.read.parquet(os.path.join(root, "table_lineage"))
    assert sorted(r.target_table for r in lin.collect()) == ["gold.fact_course", "silver.hs_course"]
    assert [f.name for f in lin.schema.fields][:len(TABLE_LINEAGE.fields)] == [f.name for f in TABLE_LINEAGE.fields]
    h = spark.read.parquet(os.path.join(root, "history2")).first()
    assert h.run_status == "succeeded" and h.tables_processed == 2


def test_daily_run_end_to_end(spark, tmpdir_path):
    from strata.plans import daily
    run = jobs.Run.start("test", dt.datetime(2024, 1, 30, 2))
    out = daily.run_daily(spark, daily.bronze_sources(spark, SF_SMALL), tmpdir_path, run)
    st = {r["config_id"]: r["status"] for r in out["results"]}
    assert set(st.values()) == {"succeeded"} and len(st) == 6, out["results"]
    assert io.read_dimension(spark, os.path.join(tmpdir_path, "gold", "dim_contact_scd")).count() > 0
    assert io.read_dimension(spark, os.path.join(tmpdir_path, "gold", "dim_account_scd")).count() > 0
    assert io.read_current(spark, os.path.join(tmpdir_path, "gold", "fact_course")).count() > 0
    kinds = {a["alert_type"] for a in out["alerts"]}
    assert "high_error_rate" in kinds  # the planted faults exceed the test threshold of 5 %


def test_reports_prune_run_date_partitions(spark, tmpdir_path):
    from strata.plans import monitor
    q_t = os.path.join(tmpdir_path, "quarantine_records")
    for day in (1, 20, 30):
        run = jobs.Run(f"r{day}", dt.datetime(2024, 1, day, 2))
        f = jobs.dq_frames(D.bronze_contact(spark, SF_SMALL), _rule(), "contact", run)
        io.append(f.quarantine, q_t, part=run.run_id, run_date=run.run_ts)
    q = spark.read.parquet(q_t)
    view = monitor.quarantine_summary(q, "2024-01-30", 7)
    view.write.format("noop").mode("overwrite").save()
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
    assert {r.first_occurrence.day for r in view.collect()} == {30}


def test_run_config_aggregate_rule(spark, tmpdir_path):
    run = jobs.Run("r_agg", dt.datetime(2024, 1, 1, 2))
    rule = {"group_by": ["hs_coursestatus"],
            "measures": [{"name": "courses", "fn": "count"},
                         {"name": "participants", "fn": "sum", "expr": "hs_currentparticipants"},
                         {"name": "long_courses", "fn": "count", "where": "hs_enddate > hs_startdate"}]}
    entry = C.ConfigEntry("course_agg", "bronze.hs_course", "gold.agg_course", "gold", "aggregate", rule, 30)
    src = D.bronze_course(spark, SF_SMALL)
    res = jobs.run_config(spark, [entry], lambda n: src, lambda n: os.path.join(tmpdir_path, n), run)
    assert res[0]["status"] == "succeeded"
    out = {r.hs_coursestatus: r for r in io.read_current(spark, os.path.join(tmpdir_path, "gold.agg_course")).collect()}
    assert sum(r.courses for r in out.values()) == src.count()
    assert sum(r.participants for r in out.values()) == src.agg(F.sum("hs_currentparticipants")).first()[0]


def test_catalog_tables(spark):
    from strata.plans import monitor
    spark.sql("CREATE DATABASE IF NOT EXISTS hs_monitoring_test")
    name = "hs_monitoring_test.pipeline_metrics"
    assert not io.table_exists(spark, name)
    now = dt.datetime(2024, 1, 1)
    m = monitor.stage_metrics(spark, "r1", [monitor.StageResult("bronze_to_silver", ("contact", "silver.contact"), (now, now),
                                                                   {"read": 10, "written": 9, "failed": 1})])
    io.save_table(spark, m, name)
    # an int where the table holds a long, columns in another order: conformed before the append
    extra = m.select(F.col("records_read").cast("int").alias("records_read"), *[c for c in m.columns
                                                                                if c != "records_read"])
    io.save_table(spark, extra, name)
    assert io.table_exists(spark, name) and io.read_table(spark, name).count() == 2
    inv = {r.table_name: r for r in io.catalog_inventory(spark, "hs_monitoring_test").collect()}
    assert "hs_monitoring_test.pipeline_metrics" in inv and "records_read" in inv[name].columns


def test_run_dq_rule_score(spark, tmpdir_path):
    run = jobs.Run("r_score", dt.datetime(2024, 1, 1, 2))
    bronze = D.bronze_contact(spark, SF_SMALL)
    m_t = os.path.join(tmpdir_path, "pipeline_metrics")
    out = jobs.run_dq(spark, bronze, _rule(), "contact", os.path.join(tmpdir_path, "s"), None, m_t, run,
                      dq_score="rules")
    from strata.operators import rules as R
    ev = R.evaluate(bronze, R.compile_rules(_rule()["validations"]), with_score=True)
    exp = ev.agg(F.avg("_dq_score")).first()[0] / 100
    assert abs(out["dq_score_avg"] - exp) < 1e-12
    assert abs(spark.read.parquet(m_t).first().dq_score_avg - exp) < 1e-12


def test_vacuum_versions_and_dimension_runs(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "silver_x")
    for v in ("r1", "r2", "r3", "r4"):
        io.publish(spark, spark.range(3), t, v)
    assert io.vacuum(spark, t, keep=2) == ["v=r1", "v=r2"]
    assert io.read_current(spark, t).count() == 3
    # dimension: old current copies go, closed history stays
    scd = C.seed_rule("contact_silver_gold_scd2")
    silver = jobs.dq_frames(D.bronze_contact(spark, SF_SMALL), _rule(), "contact", jobs.Run("a", dt.datetime(2024, 1, 1)),
                            silver_columns=C.CONTACT_SILVER_COLUMNS).silver
    g = os.path.join(tmpdir_path, "dim")
    jobs.run_scd2(spark, silver, scd, "contact", g, None, jobs.Run("20240101_000000", dt.datetime(2024, 1, 1)))
    changed = silver.withColumn("surname", F.upper("surname"))
    jobs.run_scd2(spark, changed, scd, "contact", g, None, jobs.Run("20240102_000000", dt.datetime(2024, 1, 2)))
    before = io.read_dimension(spark, g).count()
    assert io.vacuum(spark, g) == ["run=20240101_000000/is_current=true"]
    assert io.read_dimension(spark, g).count() == before


def test_run_scd2_close_missing_keys(spark, tmpdir_path):
    scd = dict(C.seed_rule("contact_silver_gold_scd2"), on_missing="close")
    silver = jobs.dq_frames(D.bronze_contact(spark, SF_SMALL), _rule(), "contact", jobs.Run("a", dt.datetime(2024, 1, 1)),
                            silver_columns=C.CONTACT_SILVER_COLUMNS).silver
    g = os.path.join(tmpdir_path, "dim")
    jobs.run_scd2(spark, silver, scd, "contact", g, None, jobs.Run("20240101_000000", dt.datetime(2024, 1, 1)))
    fewer = silver.filter(F.col("contactid").cast("int") % 4 != 0)  # keys deleted at the source
    out = jobs.run_scd2(spark, fewer, scd, "contact", g, None, jobs.Run("20240102_000000", dt.datetime(2024, 1, 2)))
    gone = silver.count() - fewer.count()
    assert out["scd_deleted"] == gone and out["scd_updates"] == 0 and out["scd_inserts"] == 0
    assert io.read_dimension(spark, g).filter("is_current").count() == fewer.count()


def test_run_scd2_quarantines_null_keys(spark, tmpdir_path):
    """A third of the snapshot has no business key: these rows are in quarantine and no part of the counts."""
    scd = C.seed_rule("contact_silver_gold_scd2")
    silver = jobs.dq_frames(D.bronze_contact(spark, SF_SMALL), _rule(), "contact", jobs.Run("a", dt.datetime(2024, 1, 1)),
                            silver_columns=C.CONTACT_SILVER_COLUMNS).silver
    holes = silver.withColumn("contactid", F.when(F.col("contactid").cast("int") % 3 != 0, F.col("contactid")))
    n, lost = holes.count(), holes.filter("contactid IS NULL").count()
    assert lost > 1
    g, q_t, m_t = (os.path.join(tmpdir_path, x) for x in ("dim", "quarantine_records", "pipeline_metrics"))
    for day in (1, 2):
        run = jobs.Run(f"2024010{day}_000000", dt.datetime(2024, 1, day))
        out = jobs.run_scd2(spark, holes, scd, "contact", g, m_t, run, q_t)
        assert out["records_read"] == n and out["records_failed"] == lost
        assert out["scd_inserts"] + out["scd_no_changes"] == n - lost == io.read_dimension(spark, g).filter("is_current").count()
        q = spark.read.parquet(q_t).filter(F.col("pipeline_run_id") == run.run_id)
        assert {(r.error_type, r.error_field, r["count"]) for r in q.groupBy("error_type", "error_field").count().collect()} == {
            ("key_null", "contactid", lost)}
