"""Whitelist entries: literal runs, kinds, and verdicts against brute force at several sizes."""

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import rules as R
from strata.operators import whitelist as W
from strata.sources.schemas import DQ_WHITELIST

NOW = dt.datetime(2024, 1, 1)
RULES = [{"field": "email", "type": "email", "required": True}, {"field": "id", "type": "regex", "pattern": "^ok", "required": True},
         {"field": "id", "type": "not_null"}]


def frame(spark, patterns, field="email", rule="email", expires=None):
    return spark.createDataFrame([(f"w{n}", "t", field, rule, p, None, True, expires, NOW, "x") for n, p in enumerate(patterns)],
                                 _nullable(DQ_WHITELIST))


def _nullable(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def matches(value, pattern):
    if value is None or pattern is None:
        return False
    if value == pattern:
        return True
    if "%" in pattern:
        out, i = "", 0
        while i < len(pattern):
            c = pattern[i]
            if c == "\\" and pattern[i + 1:i + 2] in ("%", "_", "\\"):
                out, i = out + re.escape(pattern[i + 1]), i + 1
            else:
                out += {"%": ".*", "_": "."}.get(c, re.escape(c))
            i += 1
        return re.fullmatch(out, value, re.S) is not None
    try:
        return re.fullmatch(pattern, value) is not None
    except re.error:
        return False


PATTERNS = ["kontakt@firma", "%@intern", "a_c%", "50\\%%", "back\\\\slash%", "x.y@z", "id-[0-9]+", "(foo|bar)baz", "ab+c@", "opt(ional)?text@x",
            "cls[]x]end", "[^@]{3}tail", "q{2,3}uit", "(?i)MiXeD@", "\\d{4}-lit", "\\x41bc", "a\\.b\\.c", "nested((a)b)run", "[odd", "(open", "", None, "né%ü"]
VALUES = ["kontakt@firma", "xxkontakt@firmaYY", "who@intern", "who@internal", "abc", "abcd", "ac", "50% off", "500 off", "back\\slash!", "x.y@z", "xay@z",
          "id-42", "my id-42 x", "foobaz", "barbaz", "baz", "abbbc@", "ac@", "opttext@x", "optionaltext@x", "cls]end", "clsxend", "defztail", "abctail",
          "qquit", "quit", "mixed@", "MIXED@", "2024-lit", "Abc", "41bc", "a.b.c", "axbxc", "nestedabrun", "nestedrun", "[odd", "(open", "", None, "néXü", "two\nlines@intern"]


def verdicts(spark, patterns, values=VALUES):
    df = spark.createDataFrame([(str(n), v) for n, v in enumerate(values)], "id string, email string")
    ev = R.evaluate(df, R.compile_rules(RULES[:1]), frame(spark, patterns), "t", NOW)
    return {values[int(r.id)]: r._email_valid for r in ev.collect()}


def test_every_kind_equals_brute_force(spark):
    plain = verdicts(spark, [None])
    got = verdicts(spark, PATTERNS)
    assert got == {v: plain[v] or any(matches(v, p) for p in PATTERNS) for v in VALUES}
    assert not got["xxkontakt@firmaYY"] and got["kontakt@firma"]


def test_same_verdicts_among_five_thousand_entries(spark):
    more = [f"other{n}@x{'%' if n % 2 else ''}" for n in range(5000)]
    assert verdicts(spark, PATTERNS + more) == verdicts(spark, PATTERNS)
    assert all(ok for v, ok in verdicts(spark, more + ["%"]).items() if v is not None)


def test_a_pattern_that_only_java_knows(spark):
    got = verdicts(spark, ["\\p{L}+@firma", "(?P<n>info)@x"], ["müller@firma", "1@firma", "info@x"])
    assert got == {"müller@firma": True, "1@firma": False, "info@x": False}
    kinds = {r.kind: (r.entries, r.unindexed) for r in W.report(frame(spark, ["\\p{L}+@firma", "(?P<n>info)@x", None, "%", "a%"]), "t", NOW).collect()}
    assert kinds == {"regex": (1, 0), "refused": (1, 0), "null": (1, 0), "like": (2, 2)}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab.*+?()[]{}2,|^$\\d%_", min_size=1, max_size=14), min_size=30, max_size=60))
def test_literal_runs_are_in_every_match(spark, patterns):
    """Whatever a pattern is, a value it matches holds its run: checked with Java's own matcher on values made of the same letters."""
    values = [p.translate({ord(c): None for c in "*+?()[]{}|^$\\%_"}) for p in patterns] + ["aaa", "abab", "a.b", "bbba22", "ab2ab2ab2ab2", ""]
    runs = W.entries(frame(spark, patterns), "t", NOW).withColumn("run", W.literal_run(F.col("pattern"), F.col("kind"))).where("regex IS NOT NULL")
    bad = (runs.withColumn("value", F.explode(F.array(*[F.lit(v) for v in values]))).where(F.regexp_like("value", F.col("regex")))
           .where(~F.col("value").contains(F.col("run"))))
    assert bad.count() == 0


def test_two_rules_nulls_and_a_value_of_most_rows(spark):
    rows = [(None if n % 3 == 0 else "no" if n % 3 == 1 else f"ok{n}", "kontakt@firma" if n % 2 else None) for n in range(600)]
    df = spark.createDataFrame(rows, "id string, email string")
    wl = frame(spark, ["kontakt@%"]).unionByName(frame(spark, ["n."], "id", "regex"))
    ev = R.evaluate(df, R.compile_rules(RULES), wl, "t", NOW).collect()
    assert len(ev) == 600
    assert all(r._email_valid == (r.email is not None) for r in ev)
    assert all(r._id_valid == (r.id is not None) for r in ev)


def test_plan_has_no_nested_loop_and_no_python(spark):
    df = spark.range(500).selectExpr("concat('v', id) AS id", "concat('v', id) AS email")
    wl = spark.range(3000).selectExpr("CAST(id AS STRING) AS whitelist_id", "'t' AS table_name", "'email' AS field_name", "'email' AS rule_type",
                                      "concat('v', id, if(id % 2 = 0, '%', '')) AS pattern", "true AS active", "CAST(NULL AS TIMESTAMP) AS expires_at")
    ev = R.evaluate(df, R.compile_rules(RULES), wl, "t", NOW)
    ev.write.format("noop").mode("overwrite").save()
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "InArrow" not in plan


def test_entries_that_share_their_longest_run_are_filed_apart(spark):
    """The longest run of all entries is the same; each is filed under a fragment that few share, and nothing is broadcast."""
    patterns = [f"%large_copper_{n * 7919:05d}%" for n in range(1, 400)] + [f".*large copper plate.* {n % 97}[0-4]" for n in range(400)] + ["%_%"]
    listed = W.entries(frame(spark, patterns), "t", NOW).withColumn("slot", F.lit(0))
    index = W.filed(listed)
    kept = index.where("size > 0").groupBy("size", "fragment").count()
    assert kept.agg(F.max("count")).first()[0] <= 20
    assert index.where("size > 0").select("regex").distinct().count() == 399 + 97 and index.where("size = 0").count() == W.SPREAD
    values = ["large copper plate 15838 x", "large copper plate old 453", "large copper 7919", "none"]
    failing = spark.createDataFrame([(0, v) for v in values], "slot int, value string")
    out = W.excused(failing, listed.where(F.col("pattern") != "%_%"))
    assert {r["value"] for r in out.collect()} == {v for v in values if any(matches(v, p) for p in patterns if p != "%_%")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("patterns", [[], [None]])
def test_no_entries(spark, patterns):
    assert verdicts(spark, patterns or [None], ["x@y.de", "no"]) == {"x@y.de": True, "no": False}
