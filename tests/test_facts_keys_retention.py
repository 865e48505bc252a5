"""Fact keys by interval index, dense keys by an offsets table, retention on disk, closed dimensions, rule overrides."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, rules as R
from strata.operators.keys import assign_dense
from strata.plans import jobs
from strata.sources import config, io

NOW = dt.datetime(2024, 3, 1)
DAY = dt.timedelta(days=1)


def facts_and_dims(spark, n=3000):
    rng = random.Random(2)
    day = lambda d: dt.datetime(2020, 1, 1) + d * DAY
    facts = [(i, None if i % 7 == 0 else "hot" if i % 3 == 0 else f"c{rng.randrange(40)}", None if i % 5 == 0 else f"s{rng.randrange(9)}",
              None if i % 11 == 0 else day(rng.randrange(-5, 420))) for i in range(n)]
    dims = {}
    for name, keys in (("c", ["hot", *[f"c{k}" for k in range(30)]]), ("s", [f"s{k}" for k in range(7)])):
        rows, sk = [], 0
        for k in keys:
            at = 0
            for _ in range(rng.randrange(1, 60 if k == "hot" else 6)):
                end = at + rng.randrange(1, 40)
                rows.append((k, sk, day(at), day(end)))
                sk, at = sk + 1, end + rng.choice([0, 0, 3])  # gaps here and there
        dims[name] = rows
    make = lambda rows: spark.createDataFrame(rows, "k string, sk long, valid_from timestamp, valid_to timestamp")
    return facts, dims, spark.createDataFrame(facts, "id int, c string, s string, at timestamp").repartition(5), make(dims["c"]), make(dims["s"])


def test_fact_keys_equal_brute_force(spark):
    facts, dims, df, c, s = facts_and_dims(spark)

    def sk(name, key, t):
        hit = [r[1] for r in dims[name] if r[0] == key and t is not None and r[2] <= t < r[3]]
        return hit[0] if hit else -1

    out = gold.fact_keys(df, [gold.Lookup(c, "k", "c", "at", "sk", "c_sk"), gold.Lookup(s, "k", "s", "at", "sk", "s_sk")], {"day": "at"})
    got = {r.id: (r.c_sk, r.s_sk, r.day) for r in out.collect()}
    assert got == {i: (sk("c", ck, t), sk("s", skey, t), -1 if t is None else t.year * 10000 + t.month * 100 + t.day) for i, ck, skey, t in facts}
    assert out.columns == ["id", "c", "s", "at", "c_sk", "s_sk", "day"]
    assert gold.fact_keys(df.limit(0), [gold.Lookup(c, "k", "c", "at", "sk")]).count() == 0
    empty = gold.fact_keys(df, [gold.Lookup(c.limit(0), "k", "c", "at", "sk")])
    assert {r.sk for r in empty.collect()} == {-1}


def test_facts_are_neither_sorted_nor_windowed(spark):
    _, _, df, c, s = facts_and_dims(spark, 200)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gold.fact_keys(df, [gold.Lookup(c, "k", "c", "at", "sk", "c_sk"), gold.Lookup(s, "k", "s", "at", "sk", "s_sk")])
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in plan and "Window" not in plan and "NestedLoop" not in plan


def test_a_version_is_searched_once(spark):
    versions = F.expr("transform(sequence(1, 9), x -> named_struct('from', x * 2, 'to', x * 2 + if(x % 3 = 0, 1, 2), 'sk', x))")
    df = spark.range(-1, 24).select("id", gold.version_at(versions, F.col("id"))["sk"].alias("sk"))
    want = {i: next((x for x in range(1, 10) if 2 * x <= i < 2 * x + (1 if x % 3 == 0 else 2)), None) for i in range(-1, 24)}
    assert {r.id: r.sk for r in df.collect()} == want
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1


def test_many_versions_of_one_key(spark):
    dim = spark.range(20_000).selectExpr("'k' AS k", "id AS sk", "timestamp_seconds(id * 10) AS valid_from", "timestamp_seconds(id * 10 + 7) AS valid_to")
    facts = spark.range(0, 210_000, 101).selectExpr("id", "'k' AS k", "timestamp_seconds(id) AS at")
    for r in gold.fact_keys(facts, [gold.Lookup(dim, "k", "k", "at", "sk")]).collect():
        assert r.sk == (r.id // 10 if r.id % 10 < 7 and r.id < 200_000 else -1)


@pytest.mark.parametrize("partitions", [1, 3, 37])
def test_dense_keys_over_groups_of_partitions(spark, monkeypatch, partitions):
    from strata.operators import keys
    monkeypatch.setattr(keys, "GROUP", 4)
    df = spark.range(0, 5000, 3).selectExpr("id * 7919 % 5003 AS v", "id")
    got = assign_dense(df, ["v", "id"], "sk", 100, partitions=partitions).orderBy("v", "id").collect()
    assert [r.sk for r in got] == list(range(101, 101 + len(got)))
    assert assign_dense(df.limit(0), ["v"], "sk").count() == 0


def test_offsets_are_no_literals(spark):
    df = assign_dense(spark.range(4000).selectExpr("id * 31 % 4001 AS v"), ["v"], "sk", partitions=300)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert [r.sk for r in df.orderBy("v").collect()] == list(range(1, 4001))


def files_of(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def rows(spark, ages):
    return spark.createDataFrame([(a, NOW - a * DAY) for a in ages], "age int, at timestamp")


def test_purge_rewrites_boundary_parts_only(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "t")
    io.append(rows(spark, [1, 2]), t, part="001", run_date=NOW)
    io.append(rows(spark, [1, 50]), t, part="002", run_date=NOW)
    io.append(rows(spark, [40, 50]), t, part="003", run_date=NOW - 40 * DAY)
    young = [f for f in files_of(t) if "_part=001" in f]
    assert io.purge(spark, t, "at", NOW, 30) == 3
    assert sorted(r.age for r in io.read(spark, t).collect()) == [1, 1, 2]
    left = files_of(t)
    assert young == [f for f in left if "_part=001" in f]  # not touched
    assert not any("_part=003" in f or "_part=2" in f.replace("_part=002", "") for f in left)
    assert not [n for n in os.listdir(tmpdir_path) if n != "t"]  # no copy is left beside the table
    import pyarrow.parquet as pq
    assert sum(pq.read_metadata(os.path.join(t, f)).num_rows for f in left) == 3  # purged rows are gone from disk
    io.append(rows(spark, [3]), t, part="002", run_date=NOW)  # the run's retry replaces its part
    assert sorted(r.age for r in io.read(spark, t).collect()) == [1, 2, 3]
    assert io.purge(spark, t, "at", NOW, 30) == 3


def test_retention_days_come_from_the_environment(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "quarantine_records")
    made = spark.createDataFrame([(a, NOW - a * DAY) for a in (1, 59, 61, 89, 91)], "age int, created_at timestamp")
    for env, ages in (("dev", [1, 59, 61, 89]), ("test", [1, 59])):
        path = f"{t}-{env}"
        made.write.parquet(f"{path}/run_date=2024-01-01/_part=a")
        run = jobs.Run("r", NOW, env, config.load_config(env))
        assert jobs.run_retention(spark, {"quarantine_records": path, "other": "nowhere"}, run) == {"quarantine_records": len(ages)}
        assert sorted(r.age for r in io.read(spark, path).collect()) == ages


def test_append_mode_copy_survives_a_retry(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "copy")
    entry = config.ConfigEntry("c", "src", "tgt", "silver", "simple_copy", {"columns": ["id"], "write_mode": "append"})
    for run_id in ("r1", "r1", "r2"):
        assert jobs.run_config(spark, [entry], lambda n: spark.range(1), lambda n: t, jobs.Run(run_id, NOW))[0]["status"] == "succeeded"
    assert io.read(spark, t).count() == 2


def test_dimension_without_current_rows_goes_on(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "dim")
    rule = {"business_key": "k", "tracked_columns": ["v"], "metadata_columns": {"surrogate_key": "sk"}, "on_missing": "close"}
    snap = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for n, s in enumerate([snap, snap.limit(0), snap.limit(0), snap]):
        jobs.run_scd2(spark, s, rule, "t", t, None, jobs.Run(f"r{n}", NOW + n * DAY))
    got = sorted((r.k, r.sk, r.is_current) for r in io.read_dimension(spark, t).collect())
    assert got == [("a", 1, False), ("a", 3, True), ("b", 2, False), ("b", 4, True)]


def test_rules_of_the_table_replace_and_add():
    a = R.compile_rules([{"field": "x", "type": "not_null"}, {"field": "y", "type": "not_null"}])
    b = R.compile_rules([{"field": "x", "type": "regex", "pattern": "q", "name": "x_null"}, {"field": "y", "type": "enum", "name": "y_known", "allowed_values": ["1"]}])
    out = R.override(a, b)
    assert [(r.name, r.type) for r in out] == [("x_null", "regex"), ("y_null", "not_null"), ("y_known", "enum")]
    assert len({r.key for r in out}) == 3


def test_whitelist_entries_hold_under_the_short_table_name(spark):
    wl = spark.createDataFrame([("bronze.account", 1), ("account", 2), ("other", 3)], "table_name string, n int")
    assert sorted((r.table_name, r.n) for r in jobs._for_table(wl, "bronze.account").collect()) == [("bronze.account", 1), ("bronze.account", 2)]
    assert jobs._for_table(None, "x") is None
