"""URL rules judged with Bloom filter cascades, DataFrame functions only.

A rule is a host, a path and an action (``allow`` or ``block``).  It fits its host and all subdomains when the
url's path starts with the rule's; the longest fitting rule (host and path together, then the longer host) wins.
A url that no rule fits is on no list and is allowed.

Method: a url has one candidate key for each shape (number of host labels, length of the path) that occurs among
the rules.  A cascade answers exactly, for every candidate key of the corpus, whether it is listed: level 1
is a Bloom filter of the listed keys; level 2 holds the corpus's keys that pass level 1 without being
listed; level 3 the listed keys that pass level 2, and so on until none is left.  A key is listed when the
first level it fails has an even number (or it passes all of an odd number).  One cascade holds the block list, another
the allow list.  Urls are then judged by bit tests alone: no join, no shuffle.

Sizes: level 1 takes ``log2(candidates / keys)`` bits a key more than a plain filter, so about as many false positives
as listed keys are expected whatever the corpus's size; later levels halve.  All filters together are thus bounded
by the rule list and the logarithm of the corpus; a cascade above ``max_filter_bits`` raises.

Defined cases: host and path of a null url, or one without ``://``, are empty.  Only A-Z are lower-cased.
Rules repeated or with null host or path count once or not at all; a key on both lists is blocked.
Repeated rows are judged each, null ids are kept, extra columns are ignored, an empty table gives an empty
result, and without rules every url is allowed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, discard, materialize, text_or_empty

MAX_LEVELS = 200


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/``, ``?``, ``#`` or end; then up to ``?``, ``#`` or end."""
    text = text_or_empty(url)
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.char_length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rules]
    return spark.range(1).select(F.inline(F.array(*rows).cast("array<struct<host:string,path:string,action:string>>")))


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, code points of the path) of the rules; distinct pairs only."""
    shapes = rules.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.char_length("path").alias("chars")).distinct()
    return sorted((r["labels"], r["chars"]) for r in shapes.collect())


def candidate_key(host: Column, path: Column, shape: tuple[int, int]) -> tuple[Column, Column]:
    """The url's key of a shape (null where the url is too short for it) and its number of host code points."""
    n, chars = shape
    suffix = F.substring_index(host, ".", -n)
    long_enough = (host != "") & (F.size(F.split(host, r"\.", -1)) >= n) & (F.char_length(path) >= chars)
    return F.when(long_enough, F.concat(suffix, F.substring(path, 1, chars))), F.char_length(suffix)


class Level:
    """One Bloom filter: ``bits`` (a power of two) and ``hashes``; its words are the column ``name`` (an array of longs) that
    ``attach`` adds as a scalar subquery.  Tests are SQL text, parsed once."""

    def __init__(self, name: str, number: int, bits: int, hashes: int, words: DataFrame | None = None):
        self.name, self.number, self.bits, self.hashes, self.words = name, number, bits, hashes, words

    def places(self, key: str) -> list[str]:
        """The key's bits: double hashing with the level's own seeds.  40 bits of each hash are taken, so sums stay
        far below overflow; the step is odd."""
        a, b = (f"shiftrightunsigned(xxhash64('{seed}{self.number}', {key}), 24)" for seed in "ab")
        return [f"(({a} + ({b} | 1) * {i}) & {self.bits - 1})" for i in range(self.hashes)]

    def passes(self, key: str) -> str:
        return "(" + " AND ".join(
            f"(shiftrightunsigned(element_at({self.name}, CAST(shiftrightunsigned({p}, 6) + 1 AS INT)), CAST({p} & 63 AS INT)) & 1) = 1"
            for p in self.places(key)) + ")"

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, self.words.scalar())

    def passing(self, keys: DataFrame) -> DataFrame:
        """The rows of a table of keys that pass."""
        return self.attach(keys).where(self.passes("key")).drop(self.name)


def encode(keys: DataFrame, level: Level) -> Level:
    """Fill the filter with a table of keys: one bit-or per word, words in order as one array of ``bits / 64`` longs, stored."""
    places = keys.select(F.explode(F.expr(f"array({', '.join(level.places('key'))})")).alias("p"))
    ones = places.selectExpr("shiftrightunsigned(p, 6) AS word", "shiftleft(1L, CAST(p & 63 AS INT)) AS set")
    every = keys.sparkSession.range(level.bits // 64).selectExpr("id AS word", "0L AS set")
    words = ones.unionByName(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    row = words.agg(F.expr("transform(array_sort(collect_list(struct(word, set))), w -> w.set)").alias("words"))
    level.words = materialize(row, "filter")
    return level


def _power_of_two(n: float) -> int:
    return max(64, 1 << math.ceil(math.log2(max(n, 1))))


class Cascade:
    """Exact membership in a list for every key of a corpus."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def attach(self, df: DataFrame) -> DataFrame:
        for level in self.levels:
            df = level.attach(df)
        return df

    def listed(self, key: str) -> str:
        """SQL text of the test, over the columns of ``attach``."""
        # innermost first: a key that passes every level is listed when their number is odd
        answer = str(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = f"CASE WHEN {level.passes(key)} THEN {answer} ELSE {level.number % 2 == 0} END"
        return answer


def build_cascade(name: str, universe: DataFrame, keys: DataFrame, n_universe: int, max_filter_bits: int = 1 << 28) -> Cascade:
    """``universe``: the corpus's keys (repeats allowed, ``n_universe`` rows at most); ``keys``: the listed ones, distinct."""
    n_keys = keys.count()
    if n_keys == 0:
        return Cascade([])
    hashes = max(1, min(24, math.ceil(math.log2(max(2.0, n_universe / n_keys)))))
    levels, used = [], 0

    def add(table: DataFrame, n: int, hashes: int) -> Level:
        nonlocal used
        bits = _power_of_two(n * hashes / math.log(2))
        used += bits
        if used > max_filter_bits:
            raise ValueError(f"the filters of {n_keys} listed keys need over {max_filter_bits} bits")
        number = len(levels) + 1
        levels.append(encode(table, Level(f"__{name}{number}", number, bits, hashes)))
        return levels[-1]

    first = add(keys, n_keys, hashes)
    # the keys that pass without being listed: an aggregate over both sides, hot keys combine map-side
    both = (first.passing(universe).select("key", F.lit(0).alias("on"))
            .unionByName(keys.select("key", F.lit(1).alias("on"))))
    others = materialize(both.groupBy("key").agg(F.max("on").alias("on"), F.min("on").alias("seen")), "cascade")
    wrong, right = others.where("on = 0").select("key"), others.where("on = 1 AND seen = 0").select("key")
    while (n := wrong.count()) and len(levels) < MAX_LEVELS:
        level = add(wrong, n, 1)
        wrong, right = level.passing(right), wrong
    if n:
        raise ValueError("the cascade does not end")
    discard(others)
    return Cascade(levels)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          max_filter_bits: int = 1 << 28) -> DataFrame:
    """One row per page row: id, host, path, rule (null where none fits) and verdict."""
    rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & (F.col("host") != "")
                         & F.col("action").isin("allow", "block"))
             .select(ascii_lower(F.col("host")).alias("host"), "path", F.concat(ascii_lower(F.col("host")), F.col("path")).alias("key"), "action"))
    shapes = rule_shapes(rules)
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    found = [candidate_key(F.col("host"), F.col("path"), s) for s in shapes]
    # the urls are parsed once; every later pass reads their keys
    urls = materialize(parts.select("*", *[c for n, (key, size) in enumerate(found) for c in (
        key.alias(f"__key{n}"), size.alias(f"__size{n}"))]), "urls")
    every = ", ".join(f"__key{n}" for n in range(len(shapes)))
    keys = urls.selectExpr(f"explode(array_compact(array({every}))) AS key") if shapes else urls.selectExpr("host AS key").limit(0)
    n_universe = keys.count()
    lists = {a: build_cascade(a, keys, rules.where(F.col("action") == a).select("key").distinct(), n_universe, max_filter_bits)
             for a in ("block", "allow")}
    fits = []
    for n, (_, chars) in enumerate(shapes):
        blocked, allowed = (lists[a].listed(f"__key{n}") for a in ("block", "allow"))
        fits.append(f"CASE WHEN __key{n} IS NOT NULL THEN struct(__size{n} + {chars} AS chars, __size{n} AS host_chars, __key{n} AS key, "
                    f"{blocked} AS blocked, {allowed} AS allowed) END")
    listed = f"array_max(filter(array({', '.join(fits)}), f -> f.blocked OR f.allowed))" if fits else "NULL"
    kind = "struct<chars:int,host_chars:int,key:string,blocked:boolean,allowed:boolean>"
    judged = lists["allow"].attach(lists["block"].attach(urls)).withColumn("__fit", F.expr(f"CAST({listed} AS {kind})"))
    return judged.select(id_col, "host", "path", F.col("__fit.key").alias("rule"),
                         F.when(F.coalesce(F.col("__fit.blocked"), F.lit(False)), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
