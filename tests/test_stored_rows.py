"""Stored rows stay readable: appended layouts, retention, pointers, stable ids, keyless facts."""

import os
from datetime import datetime

from strata.operators import compare, gold, quarantine
from strata.operators.rules import compile_rules, evaluate
from strata.sources import io

NOW = datetime(2024, 6, 1)


def rows(spark, values):
    return spark.createDataFrame([(v, NOW) for v in values], "v int, at timestamp")


def test_plain_and_parted_appends_are_all_read(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "t_append")
    io.append(rows(spark, [1]), t)
    io.append(rows(spark, [2]), t, part="a", run_date=NOW)
    io.append(rows(spark, [3]), t)
    io.append(rows(spark, [4]), t, part="b")
    assert sorted(r.v for r in io.read(spark, t).collect()) == [1, 2, 3, 4]


def test_purge_then_append_keeps_the_kept_rows(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "t_purge")
    io.append(rows(spark, [1, 2, 3]), t, part="a", run_date=NOW)
    assert io.purge(spark, t, "at", NOW, 30, "p1") == 3
    io.append(rows(spark, [4]), t, part="b", run_date=NOW)
    assert sorted(r.v for r in io.read(spark, t).collect()) == [1, 2, 3, 4]
    assert io.purge(spark, t, "at", datetime(2030, 1, 1), 30, "p2") == 0
    io.append(rows(spark, [5]), t, part="c", run_date=NOW)
    assert [r.v for r in io.read(spark, t).collect()] == [5]


def test_dimension_run_ids_and_column_name_come_from_the_pointer(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "dim")
    df = spark.createDataFrame([(1, True), (2, False)], "sk int, live boolean")
    io.write_dimension_run(spark, df, t, "007", "live")
    io.publish_dimension_run(spark, t, "007", 2, "live")
    assert sorted((r.sk, r.live) for r in io.read_current(spark, t).collect()) == [(1, True), (2, False)]
    io.write_dimension_run(spark, df, t, "008", "live")
    io.publish_dimension_run(spark, t, "008", 2, "live")
    assert sorted((r.sk, r.live) for r in io.read_current(spark, t).collect()) == [(1, True), (2, False), (2, False)]
    assert io.vacuum(spark, t) == ["run=007/live=true"]


def test_quarantine_ids_do_not_depend_on_partitions(spark):
    rules = compile_rules([{"type": "not_null", "field": "a"}])
    df = spark.createDataFrame([(None, i % 3) for i in range(9000)], "a string, b int")
    ids = []
    for n in (1, 4):
        q = quarantine.build(evaluate(df.repartition(n), rules).where("not _is_valid"), rules, "t", "r", NOW)
        ids.append({r.quarantine_id for r in q.select("quarantine_id").collect()})
    assert ids[0] == ids[1] and len(ids[0]) == 9000


def test_keyless_facts_are_unknown(spark):
    dim = spark.createDataFrame([("a", 1, datetime(2020, 1, 1), datetime(2030, 1, 1))],
                                "k string, sk long, valid_from timestamp, valid_to timestamp")
    facts = spark.createDataFrame([(i, None if i % 2 else "a", NOW) for i in range(40)], "i int, fk string, ts timestamp")
    got = gold.as_of_lookup(facts, dim, "fk", "k", "ts", "sk", max_group_rows=5).collect()
    assert sorted((r.i, r.sk) for r in got) == [(i, -1 if i % 2 else 1) for i in range(40)]


def test_compare_counts_repeated_rows(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "q")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "z"), (2, "z"), (4, "q")], "k int, v string")
    got = sorted(tuple(r) for r in compare.diff(a, b, ["k"]).collect())
    assert got == [(2, "changed"), (3, "only_in_a"), (4, "only_in_b")]
