"""Interleaved clustering: same rows, narrow files in every column, odd values."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest

from strata.operators import zorder
from strata.sources import io


def groups_read(path, column, lo, hi):
    """Row groups whose statistics let a filter on the column skip nothing of [lo, hi], and all row groups."""
    hit = total = 0
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            meta = pq.read_metadata(os.path.join(path, f))
            for g in range(meta.num_row_groups):
                s = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == column)
                total += 1
                hit += s.min <= hi and s.max >= lo
    return hit, total


def test_filters_on_either_column_skip_files(spark, tmpdir_path):
    df = spark.range(40_000).selectExpr("id * 7919 % 40009 AS a", "CAST(pow(id * 104729 % 39979, 2) AS BIGINT) AS b", "id")
    paths = {}
    for name, laid in (("z", zorder.cluster(df, ["a", "b"], partitions=16)), ("lex", io.layout(df, ["a", "b"], partitions=16))):
        paths[name] = os.path.join(tmpdir_path, name)
        laid.write.parquet(paths[name])
    assert sorted(map(tuple, spark.read.parquet(paths["z"]).collect())) == sorted(map(tuple, df.collect()))
    read = {(name, c): groups_read(p, c, lo, hi)[0] for name, p in paths.items() for c, lo, hi in (("a", 20_000, 20_100), ("b", 4 * 10**8, 4 * 10**8 + 10**6))}
    assert groups_read(paths["z"], "a", 0, 10**12)[1] == 16 and read["lex", "b"] == 16
    assert read["z", "a"] <= 8 and read["z", "b"] <= 8


def test_odd_values_keep_every_row(spark):
    rows = [(None, None, None, None), ("", 0.0, dt.date(1, 1, 1), True), ("é", float("nan"), dt.date(9999, 12, 31), False), ("z" * 50, -1e300, None, None)] * 30
    df = spark.createDataFrame(rows, "s string, x double, d date, b boolean")
    for columns in (["s", "x"], ["d", "b"], ["s", "x", "d", "b"], ["x"]):
        out = zorder.cluster(df, columns, partitions=3)
        assert out.columns == df.columns and out.count() == len(rows)
    assert zorder.cluster(df.limit(0), ["s", "x"]).count() == 0
    only_null = zorder.cluster(df.where("s IS NULL"), ["s", "d"])
    assert only_null.count() == 30
    with pytest.raises(ValueError):
        zorder.cluster(spark.sql("SELECT array(1) AS v"), ["v"])


def test_ranks_are_even_and_ordered(spark):
    df = spark.range(4096).selectExpr("CAST(exp(id / 300.0) AS DOUBLE) AS v")
    got = [r.z for r in df.select("v", zorder.interleaved(df, ["v"], bits=4).alias("z")).orderBy("v").collect()]
    assert got == sorted(got) and set(got) == set(range(16))
    assert max(got.count(k) for k in range(16)) < 300
