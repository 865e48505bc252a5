"""Edge values per rule (FIXTURES.md §3), checked against native expressions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import validators as V

EMAIL_PASS = ["a@b.de", "max@example.de", "x+tag@e.com", "a@b.de\n"]
EMAIL_FAIL = [None, "", "max@@falsch", " a@b.de", "a@b.d", "a@b.de\r\n", "a@b.de\u2028"]
PHONE_PASS = [None, "", "+4917012345678", "0170 123-456(78)", "01" + "2" * 14, "0170123456\n",
              "01" + "\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668"]
PHONE_FAIL = ["017012345", "01" + "2" * 15, "004917012345678", "0170\t12345678"]
NN_PASS = ["x", "\u200b"]
NN_FAIL = [None, "", " ", "\t", "\u00a0", "\u3000", "\u001c"]


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.StringType())]))
    return [r.ok for r in df.select("i", fn(F.col("v")).alias("ok")).orderBy("i").collect()]


def test_email(spark):
    assert _eval(spark, EMAIL_PASS, V.is_email) == [True] * len(EMAIL_PASS)
    assert _eval(spark, EMAIL_FAIL, V.is_email) == [False] * len(EMAIL_FAIL)


def test_phone(spark):
    assert _eval(spark, PHONE_PASS, V.is_phone_de) == [True] * len(PHONE_PASS)
    assert _eval(spark, PHONE_FAIL, V.is_phone_de) == [False] * len(PHONE_FAIL)


def test_phone_plain_regex_rule_keeps_separators(spark):
    pat = r"^(\+49|0)[1-9]\d{8,14}$"
    res = _eval(spark, ["+4917012345678", None, "0170 123 456"], lambda c: V.matches(c, pat, required=False))
    assert res == [True, True, False]


def test_not_null(spark):
    assert _eval(spark, NN_PASS, V.is_not_blank) == [True] * len(NN_PASS)
    assert _eval(spark, NN_FAIL, V.is_not_blank) == [False] * len(NN_FAIL)


def test_python_semantics_agree():
    """The native patterns give what the reference's Python functions give."""
    import re

    def py_email(e):
        return bool(e) and bool(re.match(r'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$', str(e)))

    def py_nn(v):
        return not (v is None or str(v).strip() == "")

    assert all(py_email(v) for v in EMAIL_PASS) and not any(py_email(v) for v in EMAIL_FAIL)
    assert all(py_nn(v) for v in NN_PASS) and not any(py_nn(v) for v in NN_FAIL)


def test_enum(spark):
    vals = [None, "Gold", "gold", "Tin", ""]
    assert _eval(spark, vals, lambda c: V.is_in(c, ["Bronze", "Silver", "Gold", "Platinum"])) == \
        [True, True, False, False, False]
    assert _eval(spark, [None], lambda c: V.is_in(c, ["Gold"], required=True)) == [False]


def test_range(spark):
    df = spark.createDataFrame([(0.0,), (5.5,), (None,), (-0.01,)], "x double")
    got = [r.ok for r in df.select(V.in_range("x", 0).alias("ok")).collect()]
    assert got == [True, True, True, False]
    got = [r.ok for r in df.select(V.in_range("x", 0, required=True).alias("ok")).collect()]
    assert got == [True, True, False, False]
    got = [r.ok for r in df.select(V.in_range("x", None, 1.0).alias("ok")).collect()]
    assert got == [True, False, True, True]


def test_custom_before(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (None, 2), (1, None)], "a int, b int")
    assert [r.ok for r in df.select(V.is_before("a", "b").alias("ok")).collect()] == [True, False, False, False, False]


def test_sql_functions(spark):
    names = V.register_sql(spark)
    assert names == ["validate_email", "validate_phone_de", "validate_not_null"]
    r = spark.sql("SELECT validate_email('a@b.de') e1, validate_email(' a@b.de') e2, "
                  "validate_phone_de('0170 123-456(78)') p1, validate_phone_de(NULL) p2, "
                  "validate_not_null(' ') n1, validate_not_null('x') n2").first()
    assert (r.e1, r.e2, r.p1, r.p2, r.n1, r.n2) == (True, False, True, True, False, True)


@pytest.mark.parametrize("pattern,value,expected", [("^a+$", "aaa", True), ("^a+$", "b", False)])
def test_matches_required(spark, pattern, value, expected):
    assert _eval(spark, [value], lambda c: V.matches(c, pattern, required=True)) == [expected]
