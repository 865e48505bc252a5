"""Neighbours of rows in the order of their key, when one key may hold any share of the rows.

A window per key gives one task all rows of a key.  Here the rows are range-partitioned on (key, order), so a
large key is cut into segments, one for each partition it lies in, and the layout is fixed by a reliable checkpoint:

1. only a partition's first and last key can reach into other partitions; their segments are summarised (first
   values, last values, maximum), two rows a partition at most;
2. a window over the segments of a key turns summaries into carries: what the segments before and
   after hold.  They are a table, joined by (partition, key) and broadcast, as they number twice the partitions;
3. ``lag``, ``lead`` and the running maximum run inside (partition, key), never larger than a partition, and
   take the carry at its seams.

Previous value, next value and maximum of the earlier rows are associative, so the segments' results are those
of one window a key.  A null key is a key like any other.  ``order`` must be total within a key, or rows equal
in it may change places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

SEGMENT, EDGE = "__segment", "__edge"
FIRST, LAST, STOPS = "__is_first", "__is_last", "__stops"


def lay_out(rows: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """``rows`` by (key, order) in partitions of about equal size, numbered in ``SEGMENT``."""
    spark = rows.sparkSession
    checkpoint_dir(spark)
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartitionByRange(n, *[F.col(c) for c in (key, *order)])
            .withColumn(SEGMENT, F.spark_partition_id()).checkpoint(eager=True))


def _carries(laid: DataFrame, key: str, order: list[str], previous: list[str], following: list[str], top: list[str]) -> DataFrame:
    """(SEGMENT, EDGE key) with the values that neighbouring segments of the key pass on."""
    place = F.struct(F.col(key).alias(EDGE))
    ends = laid.groupBy(SEGMENT).agg(F.array_distinct(F.array(F.min(place), F.max(place))).alias("ends"))
    edges = ends.select(F.col(SEGMENT).alias("__of"), F.explode("ends").alias("e")).select("__of", f"e.{EDGE}")
    at = F.struct(*order)
    segments = (laid.join(F.broadcast(edges), (F.col(SEGMENT) == F.col("__of")) & F.col(key).eqNullSafe(F.col(EDGE)))
                .groupBy("__of", EDGE).agg(F.max_by(F.struct(F.lit(True), *previous), at).alias("last"),
                                           F.min_by(F.struct(F.lit(True), *following), at).alias("first"),
                                           *[F.max(c).alias(f"__top_{c}") for c in top]))
    w = Window.partitionBy(EDGE).orderBy("__of")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return segments.select("__of", EDGE, F.lag("last").over(w).alias("__before"), F.lead("first").over(w).alias("__after"),
                           *[F.max(f"__top_{c}").over(before).alias(f"__carry_{c}") for c in top])


def neighbours(laid: DataFrame, key: str, order: list[str], previous: list[str] = (), following: list[str] = (),
               top: list[str] = ()) -> DataFrame:
    """``laid`` with ``__prev_<c>``, ``__next_<c>`` and ``__top_<c>`` (maximum over the key's earlier rows) of the
    named columns, and whether a row is its key's first (``FIRST``) or last (``LAST``)."""
    carries = _carries(laid, key, order, list(previous), list(following), list(top))
    seg = Window.partitionBy(SEGMENT, key).orderBy(*order)
    earlier = seg.rowsBetween(Window.unboundedPreceding, -1)
    starts, stops = F.row_number().over(seg) == 1, F.lead(F.lit(True)).over(seg).isNull()
    met = laid.join(F.broadcast(carries), (F.col(SEGMENT) == F.col("__of")) & F.col(key).eqNullSafe(F.col(EDGE)), "left")
    return met.select(
        *laid.columns,
        (starts & F.col("__before").isNull()).alias(FIRST), (stops & F.col("__after").isNull()).alias(LAST),
        *[F.when(starts, F.col(f"__before.{c}")).otherwise(F.lag(c).over(seg)).alias(f"__prev_{c}") for c in previous],
        *[F.when(stops, F.col(f"__after.{c}")).otherwise(F.lead(c).over(seg)).alias(f"__next_{c}") for c in following],
        *[F.greatest(F.max(c).over(earlier), F.col(f"__carry_{c}")).alias(f"__top_{c}") for c in top])


def mark_following(rows: DataFrame, key: str, order: list[str], following: list[str]) -> DataFrame:
    """Rows that ``neighbours`` gave (all or some) with the next row's values inside their segment, ``__in_<c>``, and whether
    they are their key's last there: in the same order and partitions, so that no row is shuffled or sorted again."""
    seg = Window.partitionBy(SEGMENT, key).orderBy(*order)
    return rows.select("*", *[F.lead(c).over(seg).alias(f"__in_{c}") for c in following],
                       F.lead(F.lit(True)).over(seg).isNull().alias(STOPS))


def following(marked: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """``marked`` (by ``mark_following``, checkpointed) with ``__next_<c>``: only a segment's last rows look beyond it."""
    carries = _carries(marked, key, order, [], cols, [])
    met = marked.join(F.broadcast(carries), F.col(STOPS) & (F.col(SEGMENT) == F.col("__of")) & F.col(key).eqNullSafe(F.col(EDGE)), "left")
    return met.select(*[c for c in marked.columns if c != STOPS and c not in [f"__in_{c}" for c in cols]],
                      *[F.when(F.col(STOPS), F.col(f"__after.{c}")).otherwise(F.col(f"__in_{c}")).alias(f"__next_{c}") for c in cols])
