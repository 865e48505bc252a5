"""Gold-layer analytics: config aggregates, activity per entity, fact lookup
against a type-2 dimension, calendar dimension, year-over-year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.search import count_at_most

AGG_FUNCS = ("count", "count_distinct", "sum", "avg", "min", "max")


def _measure(m: dict) -> Column:
    fn = m.get("fn", "count")
    e = F.expr(m["expr"]) if m.get("expr") else F.lit(1)
    if m.get("where"):
        e = F.when(F.expr(m["where"]), e)
    if fn == "count":
        c = F.count(e)
    elif fn == "count_distinct":
        c = F.countDistinct(e)
    elif fn in ("sum", "avg", "min", "max"):
        c = getattr(F, fn)(e)
    else:
        raise ValueError(f"unknown aggregate fn {fn!r}; known: {AGG_FUNCS}")
    return c.alias(m["name"])


def aggregate_rule(df: DataFrame, rule: dict) -> DataFrame:
    """``{"group_by": [...], "measures": [{"name", "fn", "expr", "where"}]}``
    -> one ``groupBy().agg()`` (partial aggregation before the shuffle)."""
    measures = rule.get("measures") or []
    if not measures:
        raise ValueError("aggregate rule needs measures")
    return df.groupBy(*(rule.get("group_by") or [])).agg(*[_measure(m) for m in measures])


#: Bytes a task by Spark's own size figure of stored columns; as sorted and hashed rows they take about ten times that.
TASK_BYTES = 4 << 20


def tasks_for(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Partitions for a shuffle of ``df``: the session's number, or more where its size asks for it."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // task_bytes))


def activity(entities: DataFrame, links: DataFrame, events: DataFrame, entity_key: str, link_key: str,
             event_key: str, status_col: str, done_value: str, keep: list[str]) -> DataFrame:
    """Per entity: distinct linked events and those in the done status
    (sessions per student: contact ⟕ participant ⟕ session).

    Repeated links are settled by one aggregate over (entity, event), combined map-side and spread over both keys, so an
    entity with a third of all links is no single group; two plain counts follow.  No row is duplicated for the second count.
    Join and aggregate share one shuffle by event; beyond what the session's partitions hold it gets more of them, so that a
    task's rows do not grow with the links."""
    links, events = links.where(F.col(event_key).isNotNull()), events.select(event_key, status_col)
    n = tasks_for(links.select(link_key, event_key))
    if n > int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        links, events = links.repartition(n, event_key), events.repartition(n, event_key)
    j = links.join(events, event_key, "left")
    once = j.groupBy(link_key, event_key).agg(F.max(F.coalesce(F.col(status_col) == done_value, F.lit(False))).alias("_done"))
    per = once.groupBy(link_key).agg(F.count(F.lit(1)).alias("total"), F.count_if("_done").alias("done"))
    return (entities.select(entity_key, *keep)
            .join(per, entities[entity_key] == per[link_key], "left")
            .select(entity_key, *keep, F.coalesce("total", F.lit(0)).alias("total"),
                    F.coalesce("done", F.lit(0)).alias("done")))


@dataclass(frozen=True)
class Lookup:
    """One dimension key of a fact: the version of ``dim_key = fact_key`` valid at ``fact_ts``."""
    dim: DataFrame
    dim_key: str
    fact_key: str
    fact_ts: str
    sk: str
    out: str | None = None
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    unknown: int = -1


def interval_index(dim: DataFrame, key: str, sk: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """(_key, _versions): a key's versions as one array of struct(from, to, sk) in order of their start.

    One row a key, 24 bytes a version: a dimension gains one version of a key a run at most."""
    version = F.struct(F.col(valid_from).alias("from"), F.col(valid_to).alias("to"), F.col(sk).cast("long").alias("sk"))
    return (dim.where(F.col(key).isNotNull()).groupBy(F.concat(F.lit("k"), F.col(key).cast("string")).alias("_key"))
            .agg(F.sort_array(F.collect_list(version)).alias("_versions")))


def version_at(versions: Column, t: Column) -> Column:
    """The version with the last start at or before ``t`` if it is still valid then, else null: a binary search, run once
    (the end is compared inside it)."""
    at = lambda i: F.get(versions, i)
    return count_at_most(F.size(versions), lambda i: at(i)["from"], t, lambda n: F.when(t < at(n - 1)["to"], at(n - 1)))


def _by_size(side: DataFrame, source: DataFrame) -> DataFrame:
    """Broadcast below the session's threshold by Spark's own size figure of ``source``; a hash table per partition
    above, so that the facts are dealt out but never sorted (adaptive execution splits a partition of a hot key)."""
    spark = source.sparkSession
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(side) if small else side.hint("shuffle_hash")


def fact_keys(facts: DataFrame, lookups: list[Lookup], dates: dict[str, str] | None = None) -> DataFrame:
    """Facts with all their keys: for every lookup the surrogate key of the version valid at the fact's time
    (``valid_from <= t < valid_to``; ``unknown`` otherwise), and ``dates`` (new column -> time column) as calendar keys yyyymmdd
    (-1 for null).

    Every dimension becomes an index of one row per key, joined by key and searched in the row: a fact meets one index row
    a lookup, is never sorted and never paired with versions.  Facts without a key take join keys of their own, spread
    evenly, that no index row has."""
    columns = facts.columns
    plain = [f.name for f in facts.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.concat(F.lit("n"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(1 << 16)).cast("string"))
    out, names = facts, []
    for i, u in enumerate(lookups):
        tt = u.dim.schema[u.valid_from].dataType  # compare in the dimension's own time type (no zone shift)
        if not isinstance(tt, (T.TimestampType, T.TimestampNTZType)):
            tt = T.TimestampType()
        dim = u.dim.select(u.dim_key, F.col(u.valid_from).cast(tt).alias("valid_from"), F.col(u.valid_to).cast(tt).alias("valid_to"), u.sk)
        index = interval_index(dim, u.dim_key, u.sk).select(F.col("_key").alias(f"_key{i}"), F.col("_versions").alias(f"_versions{i}"))
        key = F.coalesce(F.concat(F.lit("k"), F.col(u.fact_key).cast("string")), spread)
        names.append(u.out or u.sk)
        found = version_at(F.col(f"_versions{i}"), F.col(u.fact_ts).cast(tt))["sk"]
        out = (out.withColumn(f"_fact{i}", key).join(_by_size(index, dim), F.col(f"_fact{i}") == F.col(f"_key{i}"), "left")
               .withColumn(f"_sk{i}", F.coalesce(found, F.lit(u.unknown).cast("long"))).drop(f"_fact{i}", f"_key{i}", f"_versions{i}"))
    day = lambda c: F.coalesce(F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c), F.lit(-1))
    return out.select(*columns, *[F.col(f"_sk{i}").alias(n) for i, n in enumerate(names)],
                      *[day(F.col(c).cast("date")).cast("int").alias(n) for n, c in (dates or {}).items()])


def as_of_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_ts: str,
                 sk: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                 unknown: int = -1, out: str | None = None, max_group_rows: int | None = None) -> DataFrame:
    """``fact_keys`` with one lookup.  ``max_group_rows`` is kept for callers and has no effect: facts of one key
    take the same way however many they are."""
    return fact_keys(facts, [Lookup(dim, dim_key, fact_key, fact_ts, sk, out, valid_from, valid_to, unknown)])


def calendar(bounds: DataFrame, lo_col: str = "lo", hi_col: str = "hi") -> DataFrame:
    """Calendar rows for every day between the dates of a one-row ``bounds``
    frame (e.g. min/max of a fact's dates), with the usual attributes."""
    days = bounds.select(F.explode(F.sequence(F.col(lo_col).cast("date"), F.col(hi_col).cast("date"))).alias("d"))
    d = F.col("d")
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_sk"),
        d.alias("date"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def monthly_yoy(df: DataFrame, ts_col: str, value: Column | None = None) -> DataFrame:
    """Count (or sum of ``value``) per month next to the same month one year
    earlier; a join on month - 12, so gaps in the months do not shift it."""
    m = F.trunc(F.col(ts_col).cast("date"), "month")
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    cur = df.groupBy(m.alias("month")).agg(agg.alias("n"))
    prev = cur.select(F.add_months("month", 12).alias("month"), F.col("n").alias("n_prev_year"))
    return (cur.join(prev, "month", "left")
            .withColumn("yoy_change", F.col("n") - F.col("n_prev_year")))


def enrich(dim: DataFrame, meta: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """A dimension with the attributes of a lookup table (join strategy left
    to Spark/AQE: it broadcasts the lookup only when its size is known small)."""
    return dim.join(meta, on, how)


def participation(df: DataFrame, group_by: list[str], current: str, maximum: str) -> DataFrame:
    """Participants and fill rate per group; a group with no capacity has no rate."""
    return (df.groupBy(*group_by)
            .agg(F.count(F.lit(1)).alias("courses"), F.sum(current).alias("participants"),
                 F.sum(maximum).alias("capacity"))
            .withColumn("fill_rate_pct", F.when(F.col("capacity") > 0,
                                                F.round(F.col("participants") * 100.0 / F.col("capacity"), 2)
                                                .cast("double"))))
