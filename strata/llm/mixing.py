"""Mixing sources to target weights, DataFrame functions only.

Sources share the total size by weight; a target stops at ``max_epochs`` times its
source's size and the excess goes to the others by weight (water filling, exact).

Method: each source's documents, in a fixed pseudorandom order, form one stream of
words that is packed into blocks of ``block`` words.  The output has one slot per
block's worth of words, in shards of ``shard_slots`` slots.  Each shard draws how many of its slots
every source gets: the multinomial draw is stratified (slot k draws from
[k/K, (k+1)/K) of the cumulative target shares), so that a count never strays more
than two slots from its expectation.  A source's slots are numbered on through the shards;
slot j maps to block perm(j mod blocks), a pseudorandom permutation of the source's
block numbers, so every block is used once before any is used again.  Slots and
documents meet in a join on (source, block number).

Prefix sums are taken in chunks of hashed documents, never over a whole source in
one task.  All draws are hashes of ``seed`` and stable keys: reruns agree.

Defined cases: null or empty text has size 0 and takes nothing; null is a source of its
own, last in order; repeated rows each hold a place in the stream; sources of size 0
get target 0; extra columns pass through inside ``__row``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, materialize, text_or_empty

SRC = ["__null", "__source"]


def n_words(c: Column) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """(__null, __source, __size, __target): one row per source of ``sizes`` (__null, __source, __size)."""
    order = Window.orderBy(*SRC)
    by_ratio = Window.orderBy("__ratio", *SRC)
    every = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    rows = (sizes.withColumn("__w", w).withColumn("__cap", F.col("__size") * F.lit(float(max_epochs)))
            .withColumn("__ratio", F.col("__cap") / F.col("__w"))
            .withColumn("__total", F.sum("__size").over(every)))
    # sources are capped in the order of cap / weight; the level is what is left over the weights left
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("__level", (F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                            / (F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
            .withColumn("__free", F.col("__ratio") > F.col("__level")))
    # the first source below its cap fixes the level for itself and all after it
    level = F.min_by(F.when(F.col("__free"), F.col("__level")), F.when(F.col("__free"), F.struct("__ratio", *SRC))).over(every)
    return rows.select(*SRC, "__size", F.coalesce(F.least(F.col("__cap"), F.col("__w") * level), F.col("__cap")).alias("__target"))


def permuted(i: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1: four Feistel rounds over a grid a x b that just covers n,
    walked on until the value lies below n."""
    a = F.ceil(F.sqrt(n)).cast("long")
    b = F.ceil(n / a).cast("long")

    def rounds(x: Column) -> Column:
        l, r = F.floor(x / b).cast("long"), F.pmod(x, b)
        for k in (0, 2):
            l = F.pmod(l + F.pmod(F.xxhash64(r, key, F.lit(k)), a), a)
            r = F.pmod(r + F.pmod(F.xxhash64(l, key, F.lit(k + 1)), b), b)
        return l * b + r

    # at most a-1 of the values lie at or above n: nearly all are done at the first step, a small n
    # within its a steps, a large one but for chance below 1e-40
    first = rounds(i)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(40)), first, lambda x, k: F.when(x < n, x).otherwise(rounds(x)))
    return F.when(first < n, first).otherwise(walk)


def sized(docs: DataFrame, source_col: str, text_col: str, id_col: str, carry: bool) -> DataFrame:
    return docs.select(F.col(id_col).alias("__doc"), F.col(source_col).isNull().alias("__null"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("__source"),
                       n_words(F.col(text_col)).alias("__n"), F.xxhash64(F.col(text_col)).alias("__th"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")] if carry else []))


def streamed(rows: DataFrame, seed: int, chunk_docs: int) -> DataFrame:
    """Add __start: the words before this row in its source's stream."""
    total = rows.agg(F.count(F.lit(1))).first()[0]
    chunks = max(1, -(-total // chunk_docs))
    rows = rows.withColumn("__chunk", F.pmod(F.xxhash64(F.col("__doc"), F.col("__th"), F.lit(seed)), F.lit(chunks)))
    base = (rows.groupBy(*SRC, "__chunk").agg(F.sum("__n").alias("__words"))
            .withColumn("__base", F.sum("__words").over(Window.partitionBy(*SRC).orderBy("__chunk")) - F.col("__words"))
            .select(F.col("__null").alias("__bn"), F.col("__source").alias("__bs"), F.col("__chunk").alias("__bc"), "__base"))
    within = (Window.partitionBy(*SRC, "__chunk").orderBy("__doc", "__th", "__n")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("__start", F.sum("__n").over(within) - F.col("__n"))
            .join(base, (F.col("__null") == F.col("__bn")) & (F.col("__source") == F.col("__bs"))
                  & (F.col("__chunk") == F.col("__bc")))
            .withColumn("__start", F.col("__start") + F.col("__base")).drop("__bn", "__bs", "__bc", "__base", "__chunk"))


def slot_table(targets: DataFrame, block: int, shard_slots: int, seed: int, max_epochs: int) -> DataFrame:
    """(__null, __source, __shard, __slot, __block): one row per output slot."""
    every = Window.partitionBy()
    order = Window.orderBy(*SRC)
    shares = (targets.withColumn("__all", F.sum("__target").over(every))
              .withColumn("__to", F.sum("__target").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.col("__all"))
              .withColumn("__from", F.coalesce(F.lag("__to").over(order), F.lit(0.0)))
              .withColumn("__to", F.when(F.lead("__to").over(order).isNull(), F.lit(1.0)).otherwise(F.col("__to")))
              .withColumn("__slots", F.round(F.col("__all") / block).cast("long"))
              .withColumn("__blocks", F.ceil(F.col("__size") / block).cast("long"))
              .where(F.col("__size") > 0))
    shards = shares.withColumn("__shard", F.explode(F.expr(
        f"sequence(0L, greatest(0L, cast(ceil(__slots / {shard_slots}) as long) - 1))")))
    k = F.least(F.lit(shard_slots).cast("long"), F.col("__slots") - F.col("__shard") * shard_slots)

    def points_below(x: Column) -> Column:
        """How many of the shard's stratified draws fall below x."""
        stratum = F.floor(x * F.col("__k")).cast("long")
        u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("__shard"), stratum), 11) / F.lit(float(1 << 53))
        return F.when(x >= 1, F.col("__k")).otherwise(
            stratum + F.when(u < x * F.col("__k") - stratum, 1).otherwise(0)).cast("long")

    counts = (shards.withColumn("__k", k)
              .withColumn("__drawn", points_below(F.col("__to")) - points_below(F.col("__from"))))
    running = Window.partitionBy(*SRC).orderBy("__shard").rowsBetween(Window.unboundedPreceding, 0)
    parts = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (counts.withColumn("__end", F.sum("__drawn").over(running)).where(F.col("__drawn") > 0)
             .repartition(parts, *SRC, "__shard")  # few rows, each of which unfolds: not to be coalesced
             .withColumn("__slot", F.explode(F.expr("sequence(__end - __drawn, __end - 1)")))
             .where(F.col("__slot") < F.col("__blocks") * max_epochs))
    return slots.select(*SRC, "__shard", "__slot",
                        permuted(F.pmod(F.col("__slot"), F.col("__blocks")), F.col("__blocks"),
                                 F.xxhash64(F.lit(seed), *SRC)).alias("__block"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), block: int = 32, shard_slots: int = 4096, max_epochs: int = 3,
        seed: int = 17, chunk_docs: int = 4096, carry: bool = False) -> DataFrame:
    """One row per document row: __doc, __source, size, source_size, target, taken and ``uses``
    (array<struct<from, to, times>>: the word spans the mix takes and how often), plus ``__row`` with ``carry``."""
    rows = materialize(sized(docs, source_col, text_col, id_col, carry)
                       .withColumn("__rid", F.monotonically_increasing_id()), "mix")
    spans = streamed(rows.drop("__row"), seed, chunk_docs)
    sizes = rows.groupBy(*SRC).agg(F.sum("__n").alias("__size"))
    targets = materialize(source_targets(sizes, weights, max_epochs), "mix-targets")
    used = (slot_table(targets, block, shard_slots, seed, max_epochs)
            .groupBy(*SRC, "__block").agg(F.count(F.lit(1)).alias("__times")))
    cuts = (spans.where(F.col("__n") > 0)
            .select("__rid", *SRC, "__n", "__start", F.explode(F.sequence(
                F.floor(F.col("__start") / block).cast("long"),
                F.floor((F.col("__start") + F.col("__n") - 1) / block).cast("long"))).alias("__block")))
    # the planner cannot know how far explode widens the slots: never a broadcast
    taken = (cuts.join(used.hint("merge"), [*SRC, "__block"])
             .select("__rid", F.greatest(F.col("__block") * block - F.col("__start"), F.lit(0)).alias("from"),
                     F.least((F.col("__block") + 1) * block - F.col("__start"), F.col("__n")).alias("to"), "__times")
             .groupBy("__rid").agg(F.sum((F.col("to") - F.col("from")) * F.col("__times")).alias("taken"),
                                   F.array_sort(F.collect_list(F.struct("from", "to", F.col("__times").alias("times")))).alias("uses")))
    facts = targets.select(*[F.col(c).alias(f"t{c}") for c in SRC], F.col("__size").alias("source_size"),
                           F.col("__target").alias("target"))
    return (rows.join(taken.hint("merge"), "__rid", "left")
            .join(facts, (F.col("__null") == F.col("t__null")) & (F.col("__source") == F.col("t__source")))
            .select("__doc", F.when(~F.col("__null"), F.col("__source")).alias("__source"), F.col("__n").alias("size"),
                    "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "uses",
                    *(["__row"] if carry else [])))
