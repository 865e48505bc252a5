"""Type-2 history scenarios: new, changed, same, missing, A->B->A, untracked
change, null key, duplicate keys, rerun, empty source, reopen, checks."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash
from strata.operators import scd2
from strata.operators.keys import assign_dense

SPEC = scd2.ScdSpec("id", ["email"], ["city"], "sk")
SCHEMA = "id string, email string, city string"
D1, D30, D60 = "2024-01-01 00:00:00", "2024-01-30 00:00:00", "2024-03-01 00:00:00"


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_key(dim):
    out = {}
    for r in dim.orderBy("id", "valid_from").collect():
        out.setdefault(r.id, []).append((r.email, r.city, r.is_current, str(r.valid_from), str(r.valid_to)))
    return out


def test_timeline_touching_bounds(spark):
    d1 = scd2.initial_load(snap(spark, [("max", "max@alt.de", "A")]), SPEC, D1)
    d2 = scd2.merge(d1, snap(spark, [("max", "max@neu.de", "A")]), SPEC, D30)
    v = d2.orderBy("valid_from").collect()
    assert [(r.email, r.is_current) for r in v] == [("max@alt.de", False), ("max@neu.de", True)]
    assert v[0].valid_to == v[1].valid_from == dt.datetime(2024, 1, 30)
    assert [r.sk for r in v] == [1, 2]


def test_all_classes(spark):
    d1 = scd2.initial_load(snap(spark, [("a", "a1", "X"), ("b", "b1", "X"), ("c", "c1", "X"), ("d", "d1", "X")]),
                           SPEC, D1)
    s2 = snap(spark, [("a", "a2", "X"), ("b", "b1", "Y"), ("e", "e1", "X"), (None, "n", "X")])
    classes = {r.id: r._class for r in scd2.classify(d1, s2, SPEC).collect()}
    assert classes == {"a": "changed", "b": "same", "c": "missing", "d": "missing", "e": "new"}
    c = scd2.counts(scd2.classify(d1, s2, SPEC)).first()
    assert (c.scd_inserts, c.scd_updates, c.scd_no_changes, c.scd_missing) == (1, 1, 1, 2)
    d2 = scd2.merge(d1, s2, SPEC, D30)
    h = by_key(d2)
    assert [x[0] for x in h["a"]] == ["a1", "a2"]
    assert h["b"] == [("b1", "X", True, "2024-01-01 00:00:00", "9999-12-31 23:59:59")]  # untracked city ignored
    assert h["c"][0][2] is True  # missing stays open
    assert None not in h  # the null key never enters the dimension
    assert sorted(r.sk for r in d2.collect()) == list(range(1, 7))


def test_a_b_a_and_rerun(spark):
    d = scd2.initial_load(snap(spark, [("k", "A", "X")]), SPEC, D1)
    d = scd2.merge(d, snap(spark, [("k", "B", "X")]), SPEC, D30)
    d = scd2.merge(d, snap(spark, [("k", "A", "X")]), SPEC, D60)
    assert [x[0] for x in by_key(d)["k"]] == ["A", "B", "A"]
    again = scd2.merge(d, snap(spark, [("k", "A", "X")]), SPEC, "2024-04-01 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, d.collect()))


def test_empty_source_and_close_missing(spark):
    d1 = scd2.initial_load(snap(spark, [("a", "a1", "X")]), SPEC, D1)
    empty = snap(spark, [])
    assert scd2.merge(d1, empty, SPEC, D30).filter("is_current").count() == 1
    closed = scd2.merge(d1, empty, SPEC, D30, on_missing="close")
    assert closed.filter("is_current").count() == 0


def test_reopen_key_without_current(spark):
    d1 = scd2.initial_load(snap(spark, [("a", "a1", "X")]), SPEC, D1)
    broken = d1.withColumn("is_current", F.lit(False)).withColumn("valid_to", F.lit(D30).cast("timestamp"))
    fixed = scd2.merge(broken, snap(spark, [("a", "a2", "X")]), SPEC, D60)
    assert fixed.filter("is_current").count() == 1
    assert scd2.check_one_current(fixed, SPEC).count() == 0


def test_duplicate_and_null_keys(spark):
    s = snap(spark, [("a", "1", "X"), ("a", "2", "X"), (None, "3", "X")])
    assert [r.id for r in scd2.duplicate_keys(s, SPEC).collect()] == ["a"]
    assert scd2.null_keys(s, SPEC).count() == 1


def test_checks_find_planted_faults(spark):
    d = scd2.initial_load(snap(spark, [("a", "a1", "X"), ("b", "b1", "X")]), SPEC, D1)
    d = scd2.merge(d, snap(spark, [("a", "a2", "X"), ("b", "b1", "X")]), SPEC, D30)
    clean = {r.check: r.violations for r in scd2.check_counts(d, SPEC).collect()}
    assert clean == {"keys_not_one_current": 0, "overlapping_versions": 0, "invalid_date_ranges": 0}
    # containment: a long version that contains a later one (lag would miss it)
    extra = d.filter("id = 'a' AND NOT is_current").withColumn("sk", F.lit(99).cast("long")) \
        .withColumn("valid_from", F.lit("2023-12-01 00:00:00").cast("timestamp")) \
        .withColumn("valid_to", F.lit(D60).cast("timestamp"))
    nocur = d.filter("id = 'b'").withColumn("is_current", F.lit(False))
    bad_dates = d.filter("id = 'b'").withColumn("valid_to", F.col("valid_from")).withColumn("sk", F.lit(98).cast("long"))
    faulty = d.filter("id = 'a'").unionByName(extra).unionByName(nocur).unionByName(bad_dates)
    got = {r.check: r.violations for r in scd2.check_counts(faulty, SPEC).collect()}
    assert got["overlapping_versions"] >= 1 and got["invalid_date_ranges"] == 1
    assert got["keys_not_one_current"] == 0  # b: one current row (the bad-dates copy)
    assert scd2.check_one_current(d.filter("id = 'a'").unionByName(nocur), SPEC).count() == 1  # zero current


def test_as_of_transitions_totals(spark):
    d = scd2.initial_load(snap(spark, [("a", "a1", "X")]), SPEC, D1)
    d = scd2.merge(d, snap(spark, [("a", "a2", "X")]), SPEC, D30)
    assert [r.email for r in scd2.as_of(d, SPEC, "2024-01-15 00:00:00").collect()] == ["a1"]
    assert [r.email for r in scd2.as_of(d, SPEC, D30).collect()] == ["a2"]
    t = scd2.transitions(d, SPEC, "email").collect()
    assert [(r.old_value, r.new_value) for r in t] == [("a1", "a2")]
    tot = scd2.totals(d, SPEC).first()
    assert (tot.total_rows, tot.current_rows, tot.historical_rows) == (2, 1, 1)
    assert scd2.latest(d, SPEC, 5, closed=True).count() == 1


def test_from_changes(spark):
    log = spark.createDataFrame([("a", "x", "C", dt.datetime(2024, 1, 1)), ("a", "x", "C", dt.datetime(2024, 1, 2)),
                                 ("a", "y", "C", dt.datetime(2024, 1, 3)), ("b", "z", "C", dt.datetime(2024, 1, 1))],
                                "id string, email string, city string, ts timestamp")
    h = scd2.from_changes(log, SPEC, "ts")
    rows = [(r.id, r.email, r.is_current, r.sk) for r in h.orderBy("sk").collect()]
    assert rows == [("a", "x", False, 1), ("b", "z", True, 2), ("a", "y", True, 3)]


def test_hash_modes_collisions(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("NULL", "x")], "p string, q string")
    pipe = [r.h for r in df.select(row_hash(["p", "q"]).alias("h")).collect()]
    js = [r.h for r in df.select(row_hash(["p", "q"], "json").alias("h")).collect()]
    assert pipe[0] == pipe[1] and pipe[2] == pipe[3]
    assert len(set(js)) == 4


def test_dense_keys_equal_global_rank(spark):
    # string keys with a long shared prefix, spread over many buckets
    df = spark.range(0, 3000).selectExpr("concat('CONTACT-000-', lpad(CAST((id * 7919) % 3000 AS STRING), 6, '0')) AS k")
    got = assign_dense(df, ["k"], "sk", 10, partitions=16)
    exp = df.withColumn("sk", 10 + F.row_number().over(Window.orderBy("k")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    nums = spark.range(0, 2000).selectExpr("(id * 37) % 2000 - 500 AS k")
    got = assign_dense(nums, ["k"], "sk", 0, partitions=8)
    exp = nums.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_dense_keys_split_ties_in_first_column(spark):
    # one timestamp shared by most rows: the second column must spread them
    df = spark.range(0, 4000).selectExpr("CASE WHEN id % 10 = 0 THEN id ELSE 7 END AS t",
                                         "concat('k', CAST(id AS STRING)) AS k")
    got = assign_dense(df, ["t", "k"], "sk", 0, partitions=8)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500  # not all 3600 tied rows in one partition
    exp = df.withColumn("sk", F.row_number().over(Window.orderBy("t", "k")).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_from_changes_hot_key_spans_partitions(spark):
    # key 'h' holds 90% of the log; runs of equal values cross partition seams
    log = spark.range(0, 5000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN concat('c', CAST(id % 7 AS STRING)) ELSE 'h' END AS id",
        "concat('v', CAST(CAST(id / 37 AS INT) % 5 AS STRING)) AS email", "'C' AS city",
        "timestamp_seconds(id * 60) AS ts")
    got = scd2.from_changes(log, SPEC, "ts", partitions=8, max_group_rows=500)
    w = Window.partitionBy("id").orderBy("ts")
    hh = log.withColumn("h", row_hash(["email"]))
    kept = hh.withColumn("prev", F.lag("h").over(w)).filter(F.col("prev").isNull() | (F.col("prev") != F.col("h")))
    exp = kept.select("id", "email", F.col("ts").alias("valid_from"),
                      F.lead("ts").over(w).alias("nx"))
    g = sorted((r.id, r.email, r.valid_from, None if r.is_current else r.valid_to) for r in got.collect())
    e = sorted((r.id, r.email, r.valid_from, r.nx) for r in exp.collect())
    assert g == e
    assert sorted(r.sk for r in got.collect()) == list(range(1, len(e) + 1))


def test_change_counts_by_quarter(spark):
    d = scd2.initial_load(snap(spark, [("a", "a1", "X"), ("b", "b1", "X")]), SPEC, D1)
    d = scd2.merge(d, snap(spark, [("a", "a2", "X"), ("b", "b1", "X")]), SPEC, "2024-04-02 00:00:00")
    got = {r.period: (r.new_versions, r.changed_keys) for r in
           scd2.change_counts(d, SPEC, D1, "2025-01-01 00:00:00", "quarter").collect()}
    assert got == {"2024-Q1": (2, 2), "2024-Q2": (1, 1)}


def test_two_runs_at_the_same_instant_are_caught(spark):
    # a second change at the same timestamp would close a version with an empty range
    d = scd2.initial_load(snap(spark, [("a", "a1", "X")]), SPEC, D1)
    d = scd2.merge(d, snap(spark, [("a", "a2", "X")]), SPEC, D30)
    rows = scd2.next_rows(scd2.current(d, SPEC), snap(spark, [("a", "a3", "X")]), SPEC, D30, 2)
    got = {r.check: r.violations for r in scd2.run_checks(rows, SPEC, D30).collect()}
    assert got["invalid_date_ranges"] == 1


def test_a_run_joins_current_rows_and_snapshot_once(spark):
    """The rows of a run come from the stored join; the join itself (as a left one for the old rows) is no part of their plan."""
    d = scd2.initial_load(snap(spark, [("a", "a1", "X"), ("b", "b1", "X")]), SPEC, D1)
    rows = scd2.next_rows(scd2.current(d, SPEC), snap(spark, [("a", "a2", "X"), ("c", "c1", "X")]), SPEC, D30, 2, "close", True)
    assert "Outer" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.code, r.sk, r.is_current, r._class) for r in rows.select(F.col(SPEC.business_key).alias("code"), F.col(SPEC.surrogate_key).alias("sk"), "is_current", "_class").collect()) == [
        ("a", 1, False, "changed"), ("a", 3, True, "changed"), ("b", 2, False, "missing"), ("c", 4, True, "new")]
