"""Plan assertions over every registered query: no Python evaluation in the
plan, no window or aggregate funnelled through a single partition, and
column-pruned scans."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# top-k reports legitimately gather k rows per partition into one (TakeOrderedAndProject)
TOP_K = {"top_errors", "scd2_latest", "scd2_latest_closed"}


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")  # whole read schemas
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.CORE_QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan
    if name not in TOP_K:
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only a global aggregate may gather, and only its partial results (one row per task)
                child = lines[i + 1]
                assert "Aggregate(keys=[]" in child and "partial_" in child, f"one-partition step: {child}"
    # every parquet scan reads a pruned schema, never a star over wide tables
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert schema.count(":") <= 14


def test_scan_pruning_and_pushdown(spark):
    df = E.queries()["dq_customer_rules"](spark, SF_SMALL)
    plan = _plan(df)
    assert "c_nationkey" not in plan.split("ReadSchema")[1].split("\n")[0]
    o = E.queries()["funnel"](spark, SF_SMALL)
    assert "PushedFilters" in _plan(o)


def test_distinct_counts_duplicate_no_rows(spark):
    assert "Expand" not in _plan(E.queries()["supplier_activity"](spark, SF_SMALL))


def test_spike_alert_reads_eight_days_and_equals_the_long_way(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    from strata.plans import monitor
    day = dt.date(2024, 1, 30)
    made = [(t, day - dt.timedelta(days=d), n) for t, counts in {"a": [9, 1, 2, 0, 3], "b": [3, 1, 1, 1], "c": [5], "d": [0, 4], "e": [7] + [0] * 8 + [1]}.items()
            for d, n in enumerate(counts)] + [("a", day + dt.timedelta(days=1), 50), ("a", day - dt.timedelta(days=8), 500)]
    q = spark.createDataFrame([(t, dt.datetime.combine(d, dt.time(5)), d) for t, d, n in made for _ in range(n)],
                              "source_table string, created_at timestamp, run_date date")
    m = spark.createDataFrame([], "start_time timestamp, error_rate double, duration_sec double, source_table string, run_id string")
    alerts = monitor.health(m, None, q, 0.1, day)
    assert [(r.subject, r.value, r.threshold) for r in alerts.collect()] == [("a", 9.0, 6.0)]  # days without rows are no days
    stored = monitor.health(m, None, q.where(F.col("run_date").isNotNull()), 0.1, day)
    assert "Window" not in _plan(stored)


def test_activity_gets_more_tasks_for_more_links(spark, monkeypatch):
    """A task's rows stay bounded: beyond the session's partitions the shuffle by event grows with the links' size, with the same counts."""
    from strata.operators import gold
    links = spark.range(4000).selectExpr("id % 7 AS who", "IF(id % 50 = 0, NULL, id % 900) AS event")
    events = spark.range(800).selectExpr("id AS event", "IF(id % 3 = 0, 'F', 'O') AS status")
    who = spark.range(9).selectExpr("id AS entity")
    ask = lambda: gold.activity(who, links, events, "entity", "who", "event", "status", "F", [])
    few = ask()
    monkeypatch.setattr(gold, "tasks_for", lambda df, f=gold.tasks_for: f(df, 1000))
    many = ask()
    assert gold.tasks_for(links) > 30 and f", {gold.tasks_for(links.where('event IS NOT NULL'))})" in _plan(many)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    assert {r["entity"]: (r["total"], r["done"]) for r in few.collect()}[8] == (0, 0)
