"""Keep one row per key.

``keep_one`` is ``row_number() == 1`` over the key window.  Catalyst turns
that filter into a partial ``WindowGroupLimit`` that runs *before* the shuffle,
so every map task forwards at most one row per key: a key holding a third of
all rows costs one row per map task in the exchange, not a third of the data
in one task.

``keep_one_agg`` is the same result through a two-phase ``max``/``min`` of a
struct (partial aggregation), for callers that want an aggregate plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sort(col: str, order: str) -> Column:
    # desc: nulls last (latest non-null wins); asc: nulls first (null wins),
    # as the reference's F.desc / F.asc do.
    return F.col(col).desc_nulls_last() if order == "desc" else F.col(col).asc_nulls_first()


def keep_one(df: DataFrame, keys: list[str], order_by: str | list[str], order: str = "desc",
             tie_breakers: list[str] | None = None) -> DataFrame:
    """Latest (``desc``) or first (``asc``) row per ``keys``.

    Ties on ``order_by`` are broken by ``tie_breakers`` in the same direction;
    without them, by a hash of the other columns, so a rerun keeps the same row.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc' or 'desc'")
    order_cols = [order_by] if isinstance(order_by, str) else list(order_by)
    sorts = [_sort(c, order) for c in order_cols]
    if tie_breakers is None:
        rest = [c for c in df.columns if c not in keys and c not in order_cols]
        if rest:
            h = F.xxhash64(*[F.col(c) for c in rest])
            sorts.append(h.desc() if order == "desc" else h.asc())
    else:
        sorts += [_sort(c, order) for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*sorts)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_one_agg(df: DataFrame, keys: list[str], order_by: str, order: str = "desc",
                 tie_breakers: list[str] | None = None) -> DataFrame:
    """Same choice as ``keep_one`` via max/min over a struct (nulls compare
    smallest, which matches nulls-last on desc and nulls-first on asc)."""
    tb = list(tie_breakers or [])
    rest = [c for c in df.columns if c not in keys]
    ordered = [order_by] + [c for c in tb if c != order_by]
    payload = [c for c in rest if c not in ordered]
    s = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(ordered)],
                 F.struct(*payload).alias("p"))
    pick = F.max(s) if order == "desc" else F.min(s)
    out = df.groupBy(*keys).agg(pick.alias("_w"))
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_w.o{i}").alias(c) for i, c in enumerate(ordered)]
    cols += [F.col(f"_w.p.{c}").alias(c) for c in payload]
    return out.select(*cols).select(*df.columns)


def duplicates_removed(before: int, after: int) -> int:
    return before - after
