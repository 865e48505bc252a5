"""Compare two snapshots of a table by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash


def _per_key(df: DataFrame, keys: list[str], cols: list[str], tag: str) -> DataFrame:
    """One row per key: row count and an order-independent hash of its rows
    (exact sums of both 64-bit halves of the md5), so duplicate keys never pair up."""
    md5 = row_hash(cols, "json")
    halves = [F.sum(F.conv(F.substring(md5, at, 16), 16, 10).cast("decimal(20,0)")) for at in (1, 17)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_n{tag}"), F.struct(*halves).alias(f"_h{tag}"))


def diff(a: DataFrame, b: DataFrame, keys: list[str], value_cols: list[str] | None = None) -> DataFrame:
    """Keys only in ``a``, only in ``b``, or in both with different rows.

    Each side is reduced to one row per key first (partial aggregation, so a
    hot key costs one row per task), then a full outer join on the keys.
    Values are compared through a hash of ``value_cols`` (default: the common
    non-key columns, json mode so nulls and separators cannot collide).
    Returns (keys..., side) with side in only_in_a / only_in_b / changed.
    """
    cols = value_cols or [c for c in a.columns if c in b.columns and c not in keys]
    j = _per_key(a, keys, cols, "a").join(_per_key(b, keys, cols, "b"), keys, "full_outer")
    side = (F.when(F.col("_nb").isNull(), F.lit("only_in_a"))
            .when(F.col("_na").isNull(), F.lit("only_in_b"))
            .when((F.col("_ha") != F.col("_hb")) | (F.col("_na") != F.col("_nb")), F.lit("changed")))
    return j.select(*keys, side.alias("side")).filter(F.col("side").isNotNull())


def diff_counts(d: DataFrame) -> DataFrame:
    return d.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
