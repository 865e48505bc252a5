"""Exact deduplication with a heavy-hitter split, DataFrame functions only.

Texts are equal when they agree after lower-casing A-Z; the row with the largest
``doc_id`` of a class stays.

Method: a frequent-items (Misra-Gries) pass over the digests keeps a fixed number of counters,
so its result is bounded whatever the input.  The candidates'
winner and size are then verified by an exact aggregate with map-side combine, and
that bounded table is broadcast: losing rows of a frequent class are settled map-side
and never shuffled.  All other digests, none above ``support`` of the rows, take
one ordinary shuffle.

Defined cases: null text equals empty text.  A null ``doc_id`` sorts below every
other.  Rows tied on the largest ``doc_id`` (repeated rows): exactly one stays.
Extra columns are passed through inside ``__row``.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, frequent_items, materialize, text_or_empty


def text_digest(c: Column) -> Column:
    return F.sha2(ascii_lower(text_or_empty(c)), 256)


def frequent_winners(rows: DataFrame, digest: str, id_col: str, support: float) -> DataFrame:
    """(digest, __hot_id, __hot_n) of every digest above ``support`` of the rows and some others; a bounded table
    (see ``frequent_items``)."""
    spark = rows.sparkSession
    hot = spark.createDataFrame([(h,) for h in frequent_items(rows, digest, support)], "__hot string")
    verified = (rows.join(F.broadcast(hot), F.col(digest) == F.col("__hot")).groupBy("__hot")
                .agg(F.max(id_col).alias("__hot_id"), F.count(F.lit(1)).alias("__hot_n"))
                .where(F.col("__hot_n") > 1))
    # bounded by the candidates; the one that matches nothing keeps one plan with and without frequent digests
    return spark.createDataFrame([*verified.collect(), ("", None, 0)], verified.schema)


def assign_winners(rows: DataFrame, digest: str, id_col: str, support: float = 1e-3) -> DataFrame:
    """Add keep_id, group_size and kept to ``rows``; the digest must not be null."""
    hot = F.broadcast(frequent_winners(rows, digest, id_col, support))
    marked = rows.join(hot, F.col(digest) == F.col("__hot"), "left").drop("__hot")
    # `<` is null for a null id or winner: those rows go on to the window
    loses = F.col("__hot_id").isNotNull() & F.coalesce(F.col(id_col) < F.col("__hot_id"), F.col(id_col).isNull())
    settled = (marked.where(loses)
               .withColumn("keep_id", F.col("__hot_id")).withColumn("group_size", F.col("__hot_n"))
               .withColumn("kept", F.lit(False)))
    group = Window.partitionBy(digest)
    first = Window.partitionBy(digest).orderBy(F.desc_nulls_last(id_col))
    rest = (marked.where(~loses)
            .withColumn("kept", F.row_number().over(first) == 1)
            .withColumn("keep_id", F.first(id_col).over(first))
            .withColumn("group_size", F.coalesce("__hot_n", F.count(F.lit(1)).over(group))))
    return settled.unionByName(rest).drop("__hot_id", "__hot_n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 1e-3,
                carry: bool = False) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256 (and the whole row
    as ``__row`` with ``carry``)."""
    rows = docs.select(F.col(id_col).alias("__doc"), text_digest(F.col(text_col)).alias("__digest"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")] if carry else []))
    out = assign_winners(rows if carry else materialize(rows, "digests"), "__digest", "__doc", support)
    return out.select(F.col("__doc").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      "kept", F.col("__digest").alias("text_sha256"), *(["__row"] if carry else []))
