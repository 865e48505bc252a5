"""Type-2 slowly changing dimensions without MERGE.

``merge`` is one plan: the current rows meet the new snapshot in a single
full outer join on the business key, every pair becomes at most two output
rows (the kept or closed current version, and the new version), history is
carried over untouched.  The run timestamp is one literal, so a closed
``valid_to`` always equals the next ``valid_from`` (touching half-open
intervals ``[valid_from, valid_to)``).

Classes per key: ``new`` (no current row), ``changed`` (hash differs),
``same``, ``missing`` (absent from the snapshot; kept open, the reference has
no delete handling; ``on_missing="close"`` closes it instead).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.hashing import row_hash
from strata.operators import segments
from strata.operators.keys import assign_dense
from strata.session import checkpoint_dir

# Fixed value: the open-ended validity sentinel.
END_OF_TIME = "9999-12-31 23:59:59"


@dataclass
class ScdSpec:
    business_key: str
    tracked: list[str]
    additional: list[str] = field(default_factory=list)
    surrogate_key: str = "sk"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"
    hash_value: str = "hash_value"
    hash_mode: str = "pipe"

    @classmethod
    def from_rule(cls, rule: dict) -> "ScdSpec":
        meta = rule.get("metadata_columns") or {}
        return cls(
            business_key=rule["business_key"],
            tracked=list(rule.get("tracked_columns") or []),
            additional=list(rule.get("additional_columns") or []),
            surrogate_key=meta.get("surrogate_key") or rule.get("surrogate_key") or "sk",
            valid_from=meta.get("valid_from") or "valid_from",
            valid_to=meta.get("valid_to") or "valid_to",
            is_current=meta.get("is_current") or "is_current",
            hash_value=meta.get("hash_value") or "hash_value",
            hash_mode=rule.get("hash_mode") or "pipe",
        )

    @property
    def payload(self) -> list[str]:
        return [self.business_key] + self.tracked + [c for c in self.additional if c not in self.tracked]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate_key] + self.payload + [self.hash_value, self.valid_from,
                                                      self.valid_to, self.is_current]


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def end_of_time(dtype=None) -> Column:
    return F.lit(END_OF_TIME).cast(dtype or "timestamp")


def _time_type(df: DataFrame, col: str):
    """Keep a timestamp column's own type (with or without zone), so no
    session-zone conversion happens; other types become timestamps."""
    dt = df.schema[col].dataType
    return dt if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else T.TimestampType()


def prepare(src: DataFrame, spec: ScdSpec) -> DataFrame:
    """Payload columns + hash of the tracked columns; NULL keys removed (they
    never match and belong in quarantine, see ``null_keys``)."""
    missing = [c for c in spec.payload if c not in src.columns]
    if missing:
        raise ValueError(f"snapshot lacks columns {missing}")
    return (src.filter(F.col(spec.business_key).isNotNull())
            .select(*spec.payload, row_hash(spec.tracked, spec.hash_mode).alias(spec.hash_value)))


def null_keys(src: DataFrame, spec: ScdSpec) -> DataFrame:
    return src.filter(F.col(spec.business_key).isNull())


def duplicate_keys(src: DataFrame, spec: ScdSpec) -> DataFrame:
    """Keys occurring more than once in a snapshot (they would fan out)."""
    return (src.groupBy(spec.business_key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def initial_load(src: DataFrame, spec: ScdSpec, run_ts, start_sk: int = 0) -> DataFrame:
    """Every row becomes version 1, keys dense from ``start_sk + 1`` by business key."""
    p = prepare(src, spec).select(
        "*", _ts(run_ts).alias(spec.valid_from), end_of_time().alias(spec.valid_to),
        F.lit(True).alias(spec.is_current))
    return assign_dense(p, [spec.business_key], spec.surrogate_key, start_sk).select(*spec.columns)


def classify(dim: DataFrame, src: DataFrame, spec: ScdSpec) -> DataFrame:
    """One row per key of current ∪ snapshot with its ``_class``."""
    k, h = spec.business_key, spec.hash_value
    cur = dim.filter(F.col(spec.is_current)).select(k, F.col(h).alias("_cur_h"))
    s = prepare(src, spec).select(k, F.col(h).alias("_src_h"))
    j = cur.join(s, k, "full_outer")
    return j.select(k, _class_expr(F.col("_cur_h"), F.col("_src_h")).alias("_class"))


def _class_expr(cur_h: Column, src_h: Column) -> Column:
    return (F.when(cur_h.isNull(), F.lit("new"))
            .when(src_h.isNull(), F.lit("missing"))
            .when(cur_h == src_h, F.lit("same"))
            .otherwise(F.lit("changed")))


def counts(classes: DataFrame) -> DataFrame:
    """inserts / updates / no_changes / missing in one aggregate."""
    c = F.col("_class")
    return classes.agg(
        F.count_if(c == "new").alias("scd_inserts"),
        F.count_if(c == "changed").alias("scd_updates"),
        F.count_if(c == "same").alias("scd_no_changes"),
        F.count_if(c == "missing").alias("scd_missing"))


def next_rows(cur: DataFrame, src: DataFrame, spec: ScdSpec, run_ts, max_sk: int, on_missing: str = "keep",
              with_class: bool = False) -> DataFrame:
    """The rows a run writes: every current row (kept open, or closed at
    ``run_ts``) and the new versions of changed and new keys, keyed above
    ``max_sk``.  History is not touched, so a run costs current + changes,
    not the whole dimension."""
    k, sk = spec.business_key, spec.surrogate_key
    ts = _ts(run_ts)
    cols = spec.columns
    c = cur.select(*[F.col(x).alias(f"c_{x}") for x in cols])
    s = prepare(src, spec).select(*[F.col(x).alias(f"s_{x}") for x in spec.payload + [spec.hash_value]])
    j = c.join(s, F.col(f"c_{k}") == F.col(f"s_{k}"), "full_outer")
    # both kinds of rows read the join from its checkpoint: it and the snapshot are made once, the range sample of the keys included
    checkpoint_dir(cur.sparkSession)
    j = j.withColumn("_class", _class_expr(F.col(f"c_{spec.hash_value}"), F.col(f"s_{spec.hash_value}"))).checkpoint(eager=True)
    close = (F.col("_class") == "changed") | ((F.col("_class") == "missing") & F.lit(on_missing == "close"))
    old = j.filter(F.col(f"c_{k}").isNotNull()).select(
        *[F.col(f"c_{x}").alias(x) for x in cols if x not in (spec.valid_to, spec.is_current)],
        F.when(close, ts).otherwise(F.col(f"c_{spec.valid_to}")).alias(spec.valid_to),
        F.when(close, F.lit(False)).otherwise(F.col(f"c_{spec.is_current}")).alias(spec.is_current),
        *([F.col("_class")] if with_class else []))
    new = j.filter(F.col("_class").isin("new", "changed")).select(
        *[F.col(f"s_{x}").alias(x) for x in spec.payload + [spec.hash_value]],
        ts.alias(spec.valid_from), end_of_time().alias(spec.valid_to), F.lit(True).alias(spec.is_current),
        *([F.col("_class")] if with_class else []))
    new = assign_dense(new, [k], sk, int(max_sk or 0))
    return old.unionByName(new.select(*cols, *(["_class"] if with_class else [])))


def merge(dim: DataFrame, src: DataFrame, spec: ScdSpec, run_ts, on_missing: str = "keep",
          with_class: bool = False) -> DataFrame:
    """The next version of the whole dimension after snapshot ``src`` at ``run_ts``.

    Result = history ∪ current(same, missing) ∪ current(changed, closed at
    run_ts) ∪ snapshot(changed, new) with fresh surrogate keys above the
    dimension's maximum.  A key with history but no current row (an
    interrupted earlier write) simply gets a new open version.
    """
    hist = dim.filter(~F.col(spec.is_current)).select(*spec.columns)
    if with_class:
        hist = hist.withColumn("_class", F.lit("history"))
    max_sk = dim.agg(F.max(spec.surrogate_key)).first()[0]
    return hist.unionByName(next_rows(dim.filter(F.col(spec.is_current)), src, spec, run_ts, max_sk or 0,
                                      on_missing, with_class))


def run_checks(rows: DataFrame, spec: ScdSpec, run_ts) -> DataFrame:
    """Checks on what one run wrote (its rows only, so they cost the run's
    size): one current row per key, closed rows with valid_from < valid_to,
    new versions starting at the run timestamp.  (check, violations) rows."""
    ts = _ts(run_ts)
    cur = rows.filter(F.col(spec.is_current))
    parts = [("duplicate_current_keys", cur.groupBy(spec.business_key).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1)),
             ("invalid_date_ranges", rows.filter(F.col(spec.valid_from) >= F.col(spec.valid_to))),
             ("new_versions_off_run_time", cur.filter((F.col(spec.valid_from) > ts)))]
    out = None
    for name, df in parts:
        row = df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


# --------------------------------------------------------------------------- checks

def check_one_current(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """Keys whose number of current rows is not exactly one (also finds zero)."""
    return (dim.groupBy(spec.business_key)
            .agg(F.count_if(F.col(spec.is_current)).alias("current_count"))
            .filter(F.col("current_count") != 1))


def check_overlap(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """Versions that overlap an earlier version of their key.

    A running max of ``valid_to`` over the earlier rows (by valid_from) finds
    containment that a plain ``lag`` misses, without a self-join; a key with any share of the versions spans
    several partitions (``segments``)."""
    k, sk, vf, vt = spec.business_key, spec.surrogate_key, spec.valid_from, spec.valid_to
    laid = segments.lay_out(dim.select(k, sk, vf, vt), k, [vf, sk])
    seen = segments.neighbours(laid, k, [vf, sk], top=[vt])
    return (seen.filter(F.col(f"__top_{vt}") > F.col(vf))
            .select(k, sk, vf, vt, F.col(f"__top_{vt}").alias("prev_max_valid_to")))


def check_dates(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    return dim.filter(F.col(spec.valid_from) >= F.col(spec.valid_to))


def check_counts(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """The three checks as (check, violations) rows."""
    parts = [("keys_not_one_current", check_one_current(dim, spec)),
             ("overlapping_versions", check_overlap(dim, spec)),
             ("invalid_date_ranges", check_dates(dim, spec))]
    out = None
    for name, df in parts:
        row = df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


# --------------------------------------------------------------------------- queries

def current(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    return dim.filter(F.col(spec.is_current))


def as_of(dim: DataFrame, spec: ScdSpec, t) -> DataFrame:
    """The dimension as it was at ``t``: ``valid_from <= t < valid_to``."""
    ts = _ts(t)
    return dim.filter((F.col(spec.valid_from) <= ts) & (ts < F.col(spec.valid_to)))


def changed_between(dim: DataFrame, spec: ScdSpec, start, end) -> DataFrame:
    """Versions that started inside ``[start, end)``."""
    return dim.filter((F.col(spec.valid_from) >= _ts(start)) & (F.col(spec.valid_from) < _ts(end)))


def change_counts(dim: DataFrame, spec: ScdSpec, start, end, grain: str = "month") -> DataFrame:
    """Versions started per period inside ``[start, end)`` and how many keys
    changed (``grain`` month -> 'yyyy-MM', quarter -> 'yyyy-Qn')."""
    vf = F.col(spec.valid_from)
    if grain == "month":
        period = F.date_format(vf, "yyyy-MM")
    elif grain == "quarter":
        period = F.concat(F.year(vf).cast("string"), F.lit("-Q"), F.quarter(vf).cast("string"))
    else:
        raise ValueError("grain must be month or quarter")
    return (changed_between(dim, spec, start, end).groupBy(period.alias("period"))
            .agg(F.count(F.lit(1)).alias("new_versions"), F.countDistinct(spec.business_key).alias("changed_keys")))


def transitions(dim: DataFrame, spec: ScdSpec, attr: str) -> DataFrame:
    """Each version change of ``attr``: key, old value, new value, when (keys of any size)."""
    k, vf, sk = spec.business_key, spec.valid_from, spec.surrogate_key
    laid = segments.lay_out(dim.select(k, vf, sk, F.col(attr).alias("new_value")), k, [vf, sk])
    seen = segments.neighbours(laid, k, [vf, sk], previous=["new_value"])
    old = F.col("__prev_new_value")
    return (seen.filter(~F.col(segments.FIRST) & ~old.eqNullSafe(F.col("new_value")))
            .select(k, F.col(vf).alias("changed_at"), old.alias("old_value"), "new_value"))


def totals(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col(spec.is_current)).alias("current_rows"),
                   F.count_if(~F.col(spec.is_current)).alias("historical_rows"))


def latest(dim: DataFrame, spec: ScdSpec, n: int = 5, closed: bool = False) -> DataFrame:
    """Top-n current rows by valid_from, or closed rows by valid_to (a report)."""
    if closed:
        return dim.filter(~F.col(spec.is_current)).orderBy(F.desc(spec.valid_to), spec.business_key).limit(n)
    return dim.filter(F.col(spec.is_current)).orderBy(F.desc(spec.valid_from), spec.business_key).limit(n)


def from_changes(changes: DataFrame, spec: ScdSpec, ts_col: str, start_sk: int = 0,
                 partitions: int | None = None, max_group_rows: int | None = None) -> DataFrame:
    """Type-2 history from a change log (one row per key and change time).

    Consecutive rows of a key with equal tracked values collapse into one
    version; a version is valid from its first row's time to the next
    version's.  One path for keys of any size: the log is laid out by (key, time) once (``segments``), the rows that
    start a version are kept, and their successors found on the same layout.
    ``max_group_rows`` is kept for callers and has no effect.
    """
    k, h, vf = spec.business_key, spec.hash_value, spec.valid_from
    tt = _time_type(changes, ts_col)
    p = (changes.filter(F.col(k).isNotNull())
         .select(*spec.payload, F.col(ts_col).cast(tt).alias(vf),
                 row_hash(spec.tracked, spec.hash_mode).alias(h)))
    order = [vf, h]
    laid = segments.lay_out(p, k, order, partitions)
    starts = (segments.neighbours(laid, k, order, previous=[h])
              .filter(F.col(segments.FIRST) | (F.col(f"__prev_{h}") != F.col(h))).select(*laid.columns))
    kept = segments.mark_following(starts, k, order, [vf]).checkpoint(eager=True)
    nxt = F.col(f"__next_{vf}")
    v = segments.following(kept, k, order, [vf]).select(
        *spec.payload, h, vf, F.coalesce(nxt, end_of_time(tt)).alias(spec.valid_to), nxt.isNull().alias(spec.is_current))
    # keys by (valid_from, key, hash): total, so same-instant versions of a key number the same way
    return assign_dense(v, [vf, k, h], spec.surrogate_key, start_sk).select(*spec.columns)
