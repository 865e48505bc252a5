"""Whitelist entries of any number, matched through an inverted index of pattern fragments.

An entry excuses a failing value of its (field, rule type) when the value equals the pattern, or when the
pattern holds ``%`` and the value is LIKE it, or when the pattern is a regular expression that matches the whole value.
Null patterns and expressions that the engine's own regex compiler refuses are no patterns (the latter still excuse an
equal value); ``report`` counts them.

One path at every size:

1. the distinct failing values of all rules come from one scan of the input;
2. equal values: an equi-join;
3. LIKE and regex entries are filed under a fragment (12, 6 or 3 letters, from the start or the end) of a literal run that every
   match must hold, the one that the fewest entries of the rule offer: entries that share their longest run do not meet all
   values that hold it.  Values are exploded to their fragments of these lengths, candidates found by an equi-join, row by
   row, and tested exactly;
4. entries without such a run (``report`` counts them as ``unindexed``) are tested on every distinct failing value of their rule,
   dealt over ``SPREAD`` keys.

No side of these joins is sent whole to the driver: they are dealt by key however small Spark takes the entries to be.

The excused values are joined back by value; rows that fail nothing take keys of their own, spread evenly, so neither
nulls nor a value held by a third of the rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP = "\x01"
FRAGMENTS = (12, 6, 3)
SPREAD = 64
#: What ends a literal run of a regular expression, in the order it is cut out: Unicode classes, class and anchor
#: escapes, escaped punctuation, bracket classes, three levels of groups, quantified atoms, the rest of the operators.
CUTS = [r"\\[pP](\{[^}]*\}|.)", r"\\[dDwWsSbBhHvVAzZGtnrf]", r"\\[^A-Za-z0-9]", r"\[\^?\]?[^\[\]]*\]",
        r"\([^()]*\)", r"\([^()]*\)", r"\([^()]*\)", r"(?s).(?:[?*+]|\{[^}]*\})", r"[.^$?*+{}]"]
#: Where one of these is found (after the cuts, for the second) no run is taken.
UNSURE, LEFT_OVER = r"\||\(\?|&&|\\[QE]", r"[\[\]()\\]"


def _compiles(pattern: Column) -> Column:
    return F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern).isNotNull()


def _like_regex(pattern: Column) -> Column:
    """A LIKE pattern as a regular expression; a backslash quotes ``%``, ``_`` and itself."""
    p = pattern
    for quoted, mark in (("\\\\", "\x02"), ("\\%", "\x03"), ("\\_", "\x04")):
        p = F.replace(p, F.lit(quoted), F.lit(mark))
    p = F.regexp_replace(p, r"([\\.\[\]{}()*+?^$|#&-])", r"\\$1")
    for mark, text in (("%", ".*"), ("_", "."), ("\x02", "\\\\"), ("\x03", "%"), ("\x04", "_")):
        p = F.replace(p, F.lit(mark), F.lit(text))
    return F.concat(F.lit(r"(?s)\A"), p, F.lit(r"\z"))


def _longest(runs: Column) -> Column:
    return F.array_max(F.transform(runs, lambda r: F.struct(F.char_length(r).alias("n"), r.alias("run"))))["run"]


def literal_runs(pattern: Column, kind: Column) -> Column:
    """Literal texts that every match must hold (none where that is not sure)."""
    like = F.regexp_replace(pattern, r"(?s)\\.|[%_\\]", GAP)
    regex = pattern
    for cut in CUTS:
        regex = F.regexp_replace(regex, cut, GAP)
    unsure = pattern.rlike(UNSURE) | regex.rlike(LEFT_OVER)
    return F.when(kind == "like", F.split(like, GAP)).when(unsure, F.array(F.lit(""))).otherwise(F.split(regex, GAP))


def literal_run(pattern: Column, kind: Column) -> Column:
    """The longest literal text that every match must hold (the empty string where none is sure)."""
    return _longest(literal_runs(pattern, kind))


def _offers(runs: Column) -> Column:
    """Both ends of every run, as fragments of the greatest length that fits."""
    def ends(run: Column) -> Column:
        n = F.coalesce(*[F.when(F.char_length(run) >= n, F.lit(n)) for n in FRAGMENTS])
        return F.array(F.struct(n.alias("size"), F.substring(run, F.lit(1), n).alias("fragment")),
                       F.struct(n.alias("size"), F.substring(run, F.char_length(run) - n + 1, n).alias("fragment")))

    return F.array_distinct(F.filter(F.flatten(F.transform(runs, ends)), lambda o: o["size"].isNotNull()))


def entries(whitelist: DataFrame, table: str, as_of) -> DataFrame:
    """(field_name, rule_type, pattern, kind, regex, size, offers) of the table's active, unexpired entries; ``offers`` are the
    fragments it may be filed under, ``size`` the length of the longest (0 without any)."""
    active = whitelist.filter(
        (F.col("table_name") == table) & F.coalesce(F.col("active"), F.lit(True))
        & (F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(as_of).cast("timestamp"))))
    p, whole = F.col("pattern"), F.concat(F.lit(r"\A(?:"), F.col("pattern"), F.lit(r")\z"))
    kind = (F.when(p.isNull(), F.lit("null")).when(p.contains("%"), F.lit("like"))
            .when(_compiles(p) & _compiles(whole), F.lit("regex")).otherwise(F.lit("refused")))
    known = F.col("kind").isin("like", "regex")
    return (active.select("field_name", "rule_type", "pattern").distinct().withColumn("kind", kind)
            .withColumn("regex", F.when(F.col("kind") == "like", _like_regex(p)).when(F.col("kind") == "regex", whole))
            .withColumn("offers", F.when(known, _offers(literal_runs(p, F.col("kind")))))
            .withColumn("size", F.when(known, F.coalesce(F.array_max(F.transform("offers", lambda o: o["size"])), F.lit(0)))))


def report(whitelist: DataFrame, table: str, as_of) -> DataFrame:
    """Entries by field, rule type and kind (``null`` and ``refused`` ones are no patterns), and how many have no fragment."""
    return (entries(whitelist, table, as_of).groupBy("field_name", "rule_type", "kind")
            .agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("size") == 0).alias("unindexed")))


def filed(listed: DataFrame) -> DataFrame:
    """(slot, size, fragment, regex): every LIKE and regex entry under the offer that the fewest of its slot make, or
    without an offer under each of the ``SPREAD`` keys of size 0."""
    offers = listed.where(F.col("size") > 0).select("slot", "regex", F.inline("offers"))
    makers = offers.groupBy("slot", "size", "fragment").agg(F.count(F.lit(1)).alias("makers"))
    place = F.struct("size", "fragment")
    chosen = (offers.join(makers.hint("merge"), ["slot", "size", "fragment"]).groupBy("slot", "regex")
              .agg(F.min_by(place, F.struct("makers", -F.col("size"), "fragment")).alias("place"))
              .select("slot", "place.size", "place.fragment", "regex"))
    keys = F.explode(F.array(*[F.lit(str(i)) for i in range(SPREAD)]))
    return chosen.unionByName(listed.where("size = 0").select("slot", "size", keys.alias("fragment"), "regex"))


def excused(failing: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct (slot, value) of ``failing`` that an entry of ``listed`` (slot, pattern, regex, size, offers) excuses."""
    patterns = listed.where("pattern IS NOT NULL").select("slot", F.col("pattern").alias("value")).distinct()
    equal = failing.join(patterns.hint("merge"), ["slot", "value"], "left_semi")

    def pieces(n: int) -> Column:
        every = F.regexp_extract_all("value", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
        return F.transform(F.array_distinct(every), lambda x: F.struct(F.lit(n).alias("size"), x.alias("fragment")))

    # every value also asks for the entries without a fragment
    none = F.array(F.struct(F.lit(0).alias("size"), F.pmod(F.xxhash64("value"), F.lit(SPREAD)).cast("string").alias("fragment")))
    asked = failing.select("slot", "value", F.inline(F.concat(none, *[pieces(n) for n in FRAGMENTS]))).alias("a")
    same = [F.col(f"a.{c}") == F.col(f"e.{c}") for c in ("slot", "size", "fragment")]
    found = asked.join(filed(listed).alias("e").hint("merge"), [*same, F.regexp_like(F.col("a.value"), F.col("e.regex"))], "left_semi")
    return equal.unionByName(found.select("slot", "value")).distinct()


def mark(df: DataFrame, rules: list, whitelist: DataFrame, table: str, as_of) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with one marker column for each (field, rule type) that has entries, and rule key -> marker.

    A marker is true where the row fails a rule of that field and type and its value is excused."""
    found = entries(whitelist, table, as_of)
    have = {(r["field_name"], r["rule_type"]) for r in found.select("field_name", "rule_type").distinct()
            .where(F.concat_ws(GAP, "field_name", "rule_type").isin(*[GAP.join((r.field, r.type)) for r in rules if r.field] or [""])).collect()}
    slots: dict[tuple[str, str], list] = {}
    for r in rules:
        if (r.field, r.type) in have:
            slots.setdefault((r.field, r.type), []).append(r)
    if not slots:
        return df, {}
    names = {slot: n for n, slot in enumerate(slots)}
    number = F.coalesce(*[F.when((F.col("field_name") == f) & (F.col("rule_type") == t), F.lit(n)) for (f, t), n in names.items()])
    listed = found.withColumn("slot", number).where(F.col("slot").isNotNull())

    def fails(slot) -> Column:
        bad = F.lit(False)
        for r in slots[slot]:
            bad = bad | ~r.expr()
        return bad

    value = {slot: F.col(slot[0]).cast("string") for slot in slots}
    asked = F.array_compact(F.array(*[F.when(fails(s) & value[s].isNotNull(), F.struct(F.lit(n).alias("slot"), value[s].alias("value")))
                                      for s, n in names.items()]))
    failing = df.select(F.inline(asked)).distinct()
    # one key holds slot and value: a filter on the slot would turn the joins on it into loops
    good = excused(failing, listed).select(F.concat_ws(GAP, "slot", "value").alias("_wl_hit"))
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.concat(F.lit("n"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0), F.lit(1 << 16)).cast("string"))
    marks = {}
    for slot, n in names.items():
        own = good.withColumnRenamed("_wl_hit", f"_wl{n}_hit")
        key = F.when(fails(slot) & value[slot].isNotNull(), F.concat(F.lit(f"{n}{GAP}"), value[slot])).otherwise(spread)
        df = (df.withColumn(f"_wl{n}_key", key).join(own, F.col(f"_wl{n}_key") == F.col(f"_wl{n}_hit"), "left")
              .withColumn(f"_wl{n}", F.col(f"_wl{n}_hit").isNotNull()).drop(f"_wl{n}_key", f"_wl{n}_hit"))
        marks |= {r.key: f"_wl{n}" for r in slots[slot]}
    return df, marks
