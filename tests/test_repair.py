"""One repair for the records of several tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from strata.operators import repair

RUN_TS = dt.datetime(2024, 1, 2, 3)
REPAIRS = {
    "a": repair.TableRepair([{"type": "email", "field": "mail"}, {"type": "range", "field": "n", "min": 1, "required": True}],
                            {"mail": [("@@", "@"), ("^ +", "")]}, {"n": "double"}),
    "b": repair.TableRepair([{"type": "enum", "field": "mail", "allowed_values": ["x"], "required": True},
                             {"type": "custom", "name": "order", "expression": "lo < hi"}], {}, {"lo": "date", "hi": "date"}),
}


def test_repair_all(spark):
    cases = [
        ("a", "new", '{"mail":" u@@v.de","n":2,"gone":null,"deep":{"k":[1,2]}}', {"mail": "u@v.de", "n": 2, "gone": None, "deep": {"k": [1, 2]}}),
        ("a", "new", '{"mail":"u@@v.de","n":0}', None),
        ("a", "new", '{"mail":"u@@v.de"}', None),
        ("a", "ignored", '{"mail":"u@@v.de","n":2}', None),
        ("a", "new", '{"mail":{"x":1},"n":2}', None),
        ("b", "new", '{"mail":"x","lo":"2024-01-01","hi":"2024-01-02"}', {"mail": "x", "lo": "2024-01-01", "hi": "2024-01-02"}),
        ("b", "new", '{"mail":"x","lo":"2024-01-03","hi":"2024-01-02"}', None),
        ("b", "new", '{"mail":"u@@v.de","n":2}', None),  # the other table's fixes and rules do not hold here
        ("c", "new", '{"mail":"u@v.de","n":2}', None), ("a", "new", None, None), ("a", "new", "no json", None), ("a", "new", "[1]", None),
        (None, "new", '{"mail":"u@v.de","n":2}', None)]
    q = spark.createDataFrame([(i, t, s, r, None, None) for i, (t, s, r, _) in enumerate(cases)],
                              "quarantine_id int, source_table string, status string, raw_record string, resolved_by string, resolved_at timestamp")
    out = repair.repair_all(q, REPAIRS, RUN_TS)
    got = {r.quarantine_id: r for r in out.collect()}
    for i, (table, status, raw, want) in enumerate(cases):
        r = got[i]
        assert (json.loads(r.repaired_record) if r.repaired_record else None) == want, i
        assert r.raw_record == raw and r.source_table == table
        assert (r.status, r.resolved_by, r.resolved_at) == (("fixed", "repair", RUN_TS) if want else (status, None, None))
    assert [tuple(r) for r in repair.records(out, "a", {"mail": "string", "n": "int", "gone": "string"}).collect()] == [("u@v.de", 2, None)]
    assert repair.repair_all(q.where(F.lit(False)), REPAIRS, RUN_TS).count() == 0
