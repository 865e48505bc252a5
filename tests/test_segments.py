"""Neighbours over cut keys against one window a key."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import segments


def _expected(df):
    w = Window.partitionBy("k").orderBy("t")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return df.select("k", "t", "v", F.lag("v").over(w), F.lead("v").over(w), F.max("v").over(before),
                     F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull())


def _key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("partitions", [1, 3, 16])
@pytest.mark.parametrize("hot", ["'h'", "CAST(NULL AS STRING)"])
def test_neighbours_of_a_hot_key(spark, partitions, hot):
    # two thirds of the rows in one key (null in one case), null values, values null over whole segments
    df = spark.range(0, 900).selectExpr(
        f"CASE WHEN id % 3 < 2 THEN {hot} ELSE concat('c', CAST(id % 31 AS STRING)) END AS k", "id AS t",
        "CASE WHEN id % 5 = 0 OR id BETWEEN 200 AND 500 THEN NULL ELSE (id * 37) % 101 END AS v")
    laid = segments.lay_out(df, "k", ["t"], partitions)
    got = segments.neighbours(laid, "k", ["t"], previous=["v"], following=["v"], top=["v"]).select(
        "k", "t", "v", "__prev_v", "__next_v", "__top_v", segments.FIRST, segments.LAST)
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(map(tuple, _expected(df).collect()), key=_key)
    if partitions == 16:  # no task holds the hot key
        assert max(r[1] for r in laid.groupBy(segments.SEGMENT).count().collect()) < 200


def test_neighbours_after_a_filter_and_of_an_empty_table(spark):
    df = spark.range(0, 600).selectExpr("CASE WHEN id % 4 > 0 THEN 'h' ELSE concat('c', CAST(id % 7 AS STRING)) END AS k", "id AS t", "id % 11 AS v")
    laid = segments.lay_out(df, "k", ["t"], 9)
    few = "t < 40 OR t > 520"  # whole segments lose their rows
    got = segments.neighbours(laid.where(few), "k", ["t"], previous=["v"], following=["v"], top=["v"]).select(
        "k", "t", "v", "__prev_v", "__next_v", "__top_v", segments.FIRST, segments.LAST)
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(map(tuple, _expected(df.where(few)).collect()), key=_key)
    empty = segments.lay_out(df.where("t < 0"), "k", ["t"], 4)
    assert segments.neighbours(empty, "k", ["t"], previous=["v"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_successors_of_kept_rows_need_no_second_sort(spark, partitions):
    df = spark.range(0, 600).selectExpr("CASE WHEN id % 4 > 0 THEN 'h' ELSE concat('c', CAST(id % 7 AS STRING)) END AS k", "id AS t",
                                        "CASE WHEN id BETWEEN 100 AND 400 THEN 1 ELSE id % 11 END AS v")
    laid = segments.lay_out(df, "k", ["t"], partitions)
    starts = (segments.neighbours(laid, "k", ["t"], previous=["v"]).where(f"{segments.FIRST} OR __prev_v != v").select(*laid.columns))
    marked = segments.mark_following(starts, "k", ["t"], ["t"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"Exchange hashpartitioning\({segments.SEGMENT}#\d+, k#", plan)) == 1
    got = segments.following(marked.checkpoint(eager=True), "k", ["t"], ["t"]).select("k", "t", "__next_t").collect()
    w = Window.partitionBy("k").orderBy("t")
    kept = df.withColumn("p", F.lag("v").over(w)).where("p IS NULL OR p != v")
    assert sorted(map(tuple, got), key=_key) == sorted(map(tuple, kept.select("k", "t", F.lead("t").over(w)).collect()), key=_key)
