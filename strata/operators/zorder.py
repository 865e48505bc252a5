"""Clustering on several columns: rows in the order of the interleaved bits of their columns' ranks.

A column's rank is the number of its approximate quantiles (``2**bits - 1`` of them, one pass for all columns) that are
at most the value, so every column is spread evenly whatever its distribution.  Range partitions over the
interleaved ranks make files that are narrow in every column at once; a filter on any of them skips files and row groups
by their statistics.  Lexicographic clustering serves its first column only.

Numbers, dates, timestamps and strings (by their first six bytes) can be clustered on.  Nulls rank lowest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.search import count_at_most


def _number(df: DataFrame, name: str) -> Column:
    """A double in the order of the column's values."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), "UTC")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    raise ValueError(f"cannot cluster on {name} of type {kind.simpleString()}")


def interleaved(df: DataFrame, columns: list[str], bits: int = 8) -> Column:
    """The z-value of every row: bit b of column j's rank is bit ``b * len(columns) + j``."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("one column at least, and 62 bits at most")
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), steps, 10_000).alias(f"c{j}") for j, c in enumerate(columns)]).first()
    z = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        bounds = F.lit([float(v) for v in cuts[j]]) if cuts[j] else F.lit([float("inf")])  # 2**bits - 1 values
        rank = F.coalesce(count_at_most(F.size(bounds), lambda i, b=bounds: F.get(b, i), _number(df, c)), F.lit(0)).cast("long")
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)), b * len(columns) + j))
    return z


def cluster(df: DataFrame, columns: list[str], partitions: int | None = None, bits: int = 8) -> DataFrame:
    """``df`` range-partitioned and sorted by the interleaved ranks (ties by the columns themselves)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_z", interleaved(df, columns, bits))
    return keyed.repartitionByRange(n, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")
