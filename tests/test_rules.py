import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import quarantine, rules as R
from strata.sources.config import CONTACT_RULES
from strata.sources.schemas import DQ_RULES, DQ_WHITELIST

CONTACT_SCHEMA = "contactid string, firstname string, surname string, emailaddress1 string, mobilephone string"


def contacts(spark):
    rows = [("123-abc", "  Max  ", "Muster", "max@@falsch", "017012345"),  # the documented dirty row
            ("1", "Anna", "Berg", "anna@example.de", "0170 123-456(78)"),
            ("2", None, "Kurz", "k@x.de", None),
            ("3", "Eva", "  ", "eva@x.de", "+4917012345678")]
    return spark.createDataFrame(rows, CONTACT_SCHEMA)


def test_verdicts_and_split_add_up(spark):
    rules = R.compile_rules(CONTACT_RULES)
    ev = R.evaluate(contacts(spark), rules, with_score=True, with_failed=True)
    valid, bad, rej = R.split(ev)
    assert valid.count() + bad.count() + rej.count() == 4
    assert [r.contactid for r in valid.collect()] == ["1"]
    row = ev.filter("contactid = '123-abc'").first()
    assert (row._email_valid, row._phone_valid, row._firstname_valid, row._surname_valid) == (False, False, True, True)
    assert row._dq_score == 50.0
    assert row._dq_failed == ["email_invalid", "phone_invalid"]


def test_dirty_row_quarantine(spark):
    rules = R.compile_rules(CONTACT_RULES)
    ev = R.evaluate(contacts(spark), rules)
    _, bad, _ = R.split(ev)
    q = quarantine.build(bad, rules, "contact", "run1", dt.datetime(2024, 1, 1),
                         ["contactid", "firstname", "surname", "emailaddress1", "mobilephone"])
    r = q.filter(F.get_json_object("raw_record", "$.contactid") == "123-abc").first()
    assert r.error_type == "email_invalid" and r.error_field == "emailaddress1"
    assert r.error_message == "Invalid email format; Invalid phone format"
    assert r.status == "new" and r.quarantine_id and len(r.quarantine_id) == 32
    types = {x.error_type: x.error_count for x in quarantine.by_type(q).collect()}
    assert types == {"email_invalid": 1, "firstname_null": 1, "surname_null": 1}


def test_breakdown_and_failure_counts(spark):
    rules = R.compile_rules(CONTACT_RULES)
    ev = R.evaluate(contacts(spark), rules)
    b = R.breakdown(ev, rules).collect()
    assert sum(r.row_count for r in b) == 4
    f = {r.rule_name: r.failed for r in R.failure_counts(ev, rules).collect()}
    assert f == {"email_invalid": 1, "phone_invalid": 1, "firstname_null": 1, "surname_null": 1}


def test_actions_flag_and_reject(spark):
    df = spark.createDataFrame([(1, "A", 5), (2, "Z", 5), (3, "A", -1)], "id int, s string, n int")
    rules = R.compile_rules([
        {"field": "s", "type": "enum", "allowed_values": ["A"], "error_action": "flag"},
        {"field": "n", "type": "range", "min": 0, "error_action": "reject"}])
    ev = R.evaluate(df, rules)
    valid, bad, rej = R.split(ev)
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    assert [r._dq_flags for r in valid.orderBy("id").collect()] == [[], ["s_invalid"]]
    assert bad.count() == 0 and [r.id for r in rej.collect()] == [3]


def test_custom_null_is_a_failure(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    ev = R.evaluate(df, R.compile_rules([{"type": "custom", "name": "order", "expression": "a < b"}]))
    assert sorted((r.a, r._is_valid) for r in ev.collect() if r.a) == [(1, True)]
    assert ev.filter("_is_valid").count() + ev.filter("NOT _is_valid").count() == 2


def test_whitelist_expired_and_inactive(spark):
    df = spark.createDataFrame([("1", "kontakt@firma"), ("2", "bad@@x"), ("3", "ok@x.de"), ("4", "a@b.com")],
                               "id string, email string")
    rules = R.compile_rules([{"field": "email", "type": "email"}])
    now = dt.datetime(2024, 1, 1)
    wl = spark.createDataFrame([
        ("w1", "t", "email", "email", "kontakt@firma", None, True, None, now, "x"),
        ("w2", "t", "email", "email", "bad@@x", None, True, dt.datetime(2023, 1, 1), now, "x"),  # expired
        ("w3", "t", "email", "email", "%.com", None, False, None, now, "x"),  # inactive
    ], DQ_WHITELIST)
    got = {r.id: r._is_valid for r in R.evaluate(df, rules, wl, "t", now).collect()}
    assert got == {"1": True, "2": False, "3": True, "4": True}


def test_whitelist_like_pattern(spark):
    df = spark.createDataFrame([("1", "x+y@z"), ("2", "nope")], "id string, email string")
    rules = R.compile_rules([{"field": "email", "type": "email"}])
    now = dt.datetime(2024, 1, 1)
    wl = spark.createDataFrame([("w", "t", "email", "email", "%+%@%", None, True, None, now, "x")], DQ_WHITELIST)
    got = {r.id: r._is_valid for r in R.evaluate(df, rules, wl, "t", now).collect()}
    assert got == {"1": True, "2": False}


def test_whitelist_patterns_beyond_the_inline_limit(spark):
    """1,001 entries and more: LIKE and regex entries count as they do inline."""
    rows = [("1", "x+y@z"), ("2", "nope"), ("3", "value7"), ("4", "my id-42 x"), ("5", None), ("6", "ok@x.de"), ("7", "[odd"), ("2", "nope")]
    df = spark.createDataFrame(rows, "id string, email string")
    rules = R.compile_rules([{"field": "email", "type": "email", "required": True}, {"field": "id", "type": "not_null"}])
    now = dt.datetime(2024, 1, 1)
    few = ["%+%@%", ".*id-[0-9]+.*", "[odd", "value7"]  # an expression matches whole values
    entry = lambda n, p: (f"w{n}", "t", "email", "email", p, None, True, None, now, "x")
    small = spark.createDataFrame([entry(n, p) for n, p in enumerate(few)], DQ_WHITELIST)
    large = spark.createDataFrame([entry(n, p) for n, p in enumerate(few + [f"other{n}!" for n in range(1000)])], DQ_WHITELIST)
    got = [sorted((r.id, r._email_valid, r._is_valid) for r in R.evaluate(df, rules, wl, "t", now).collect()) for wl in (small, large)]
    assert got[0] == got[1] and len(got[1]) == len(rows)
    assert {i for i, ok, _ in got[1] if ok} >= {"1", "3", "4", "6", "7"} and ("2", False, False) in got[1]


def test_rules_from_table(spark):
    now = dt.datetime(2024, 1, 1)
    t = spark.createDataFrame([
        ("r1", "email_invalid", "contact", "emailaddress1", "email", "{}", "error", "quarantine", True, now, None, "x"),
        ("r2", "old", "contact", "surname", "not_null", "{}", "error", "quarantine", False, now, None, "x")], DQ_RULES)
    rules = R.rules_from_table(t, "contact")
    assert [(r.name, r.type, r.field) for r in rules] == [("email_invalid", "email", "emailaddress1")]


def test_schema_check_and_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    rules = R.compile_rules([{"field": "b", "type": "not_null"}])
    assert R.check_schema(df, rules) == ["b"]
    with pytest.raises(ValueError):
        R.evaluate(df, rules)
    with pytest.raises(ValueError):
        R.compile_rules([{"type": "regex"}])
    with pytest.raises(ValueError):
        R.evaluate(df, R.compile_rules([{"field": "a", "type": "bogus"}]))


def test_legacy_spellings():
    r = R.compile_rules({"field": "x", "type": "enum", "values": ["a"]})
    assert r[0].allowed == ["a"] and r[0].name == "x_invalid"


def test_no_python_udf_in_plan(spark):
    ev = R.evaluate(contacts(spark), R.compile_rules(CONTACT_RULES))
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_repair_and_merge_into_silver(spark):
    from pyspark.sql import types as T
    rules = R.compile_rules(CONTACT_RULES)
    rows = [("1", "Max", "M", "max@@x.de", None, 2), ("2", "Eva", "B", "eva@x.de", None, 1)]
    df = spark.createDataFrame(rows, CONTACT_SCHEMA + ", v int")
    ev = R.evaluate(df, rules)
    valid, bad, _ = R.split(ev)
    q = quarantine.build(bad, rules, "contact", "r", dt.datetime(2024, 1, 1))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["contactid", "firstname", "surname", "emailaddress1", "mobilephone"]] +
                          [T.StructField("v", T.IntegerType())])
    repaired, updated = quarantine.repair(q, schema, {"emailaddress1": [("@@", "@")]}, CONTACT_RULES)
    assert [r.emailaddress1 for r in repaired.collect()] == ["max@x.de"]
    assert [r.status for r in updated.collect()] == ["fixed"]
    silver = R.strip_helpers(valid, rules)
    merged = quarantine.merge_repaired(silver, repaired, ["contactid"], "v")
    assert sorted((r.contactid, r.emailaddress1) for r in merged.collect()) == [("1", "max@x.de"), ("2", "eva@x.de")]
