"""Property tests: the validators on generated strings whose verdict is known from how they
were built, with the characters where engines differ."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from strata.functions import validators as V

def words(alphabet, least, most):
    return st.text(alphabet=st.sampled_from(list(alphabet)), min_size=least, max_size=most)


# every case carries its verdict: valid parts are put together, then one part is broken
local, host, top = words("abZ09._%+-", 1, 6), words("abZ09-", 1, 6), words("deDE", 2, 4)
good_mail = st.builds(lambda a, b, c, end: (f"{a}@{b}.{c}{end}", True), local, host, top, st.sampled_from(["", "\n"]))
bad_mail = st.one_of(
    st.sampled_from([(None, False), ("", False)]),
    st.builds(lambda a, b, c: (f"{a}{b}.{c}", False), local, host, top),
    st.builds(lambda b, c: (f"@{b}.{c}", False), host, top),
    st.builds(lambda a, b, c: (f"{a}@{b}{c}", False), local, host, top),
    st.builds(lambda a, b, c: (f"{a}@{b}.{c}", False), local, host, words("deDE", 0, 1)),
    st.builds(lambda a, b, c, odd: (f"{a}{odd}@{b}.{c}", False), local, host, top, st.sampled_from([" ", "\u00e4", "\t", "@"])),
    st.builds(lambda a, b, c, end: (f"{a}@{b}.{c}{end}", False), local, host, top,
              st.sampled_from(["\r\n", " ", "\u2028", "\n\n", "1"])))
lead, first = st.sampled_from(["0", "+49", "(0)", "0 ", "+4-9"]), words("123456789", 1, 1)
good_phone = st.one_of(
    st.sampled_from([(None, True), ("", True)]),
    st.builds(lambda p, f, gap, d, end: (p + f + gap + d + end, True), lead, first, st.sampled_from(["", " ", "-", ")("]),
              words("0123456789\u0661", 8, 14), st.sampled_from(["", "\n", " "])))
bad_phone = st.one_of(
    st.builds(lambda f, d: (f + d, False), first, words("0123456789", 8, 14)),
    st.builds(lambda p, d: (p + "0" + d, False), lead, words("0123456789", 8, 14)),
    st.builds(lambda p, f, d: (p + f + d, False), lead, first, words("0123456789", 0, 7)),
    st.builds(lambda p, f, d: (p + f + d, False), lead, first, words("0123456789", 15, 18)),
    st.builds(lambda p, f, d, odd: (p + f + d + odd, False), lead, first, words("0123456789", 8, 14),
              st.sampled_from(["\t", "a", "\n\n", "/"])))
blank = words(" \t\n\r\x0b\x0c\x1c\x85\u00a0\u2028\u3000", 0, 5)
blanks = st.one_of(st.just((None, False)), st.builds(lambda a: (a, False), blank),
                   st.builds(lambda a, b, c: (a + b + c, True), blank, words("aZ0.\u200b", 1, 3), blank))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.one_of(good_mail, bad_mail), st.one_of(good_phone, bad_phone), blanks), min_size=1, max_size=40))
def test_validators_on_built_cases(spark, batch):
    fields = [T.StructField("i", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in "epn")]
    df = spark.createDataFrame([(i, *(v for v, _ in case)) for i, case in enumerate(batch)], T.StructType(fields))
    got = df.select("i", V.is_email("e").alias("e"), V.is_phone_de("p").alias("p"),
                    V.is_not_blank("n").alias("n")).orderBy("i").collect()
    for r, case in zip(got, batch):
        assert (r.e, r.p, r.n) == tuple(ok for _, ok in case), repr(case)


# ---------------------------------------------------------------------------- type-2 merge

from strata.operators import scd2  # noqa: E402

SPEC = scd2.ScdSpec("id", ["v"], [], "sk")
TS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]
snapshot = st.dictionaries(st.sampled_from(list("abcdef")), st.sampled_from(["x", "y", "z", None]), max_size=6)


def model(snaps):
    """Brute force: per key keep a run's value when it differs from the key's
    last kept value (absent runs keep the version open); keys numbered by
    (run, key)."""
    rows, last = [], {}
    for n, snap in enumerate(snaps):
        for k in sorted(snap):
            if k not in last or last[k][0] != snap[k]:
                if k in last:
                    rows[last[k][1]]["to"] = TS[n]
                rows.append({"id": k, "v": snap[k], "from": TS[n], "to": None})
                last[k] = (snap[k], len(rows) - 1)
    return sorted((i + 1, r["id"], r["v"], r["from"], r["to"]) for i, r in enumerate(rows))


@settings(max_examples=12, deadline=None)
@given(st.lists(snapshot, min_size=2, max_size=4))
def test_merge_matches_model(spark, snaps):
    def frame(s):
        return spark.createDataFrame(sorted(s.items()), "id string, v string")

    dim = scd2.initial_load(frame(snaps[0]), SPEC, TS[0])
    for n in range(1, len(snaps)):
        dim = scd2.merge(dim, frame(snaps[n]), SPEC, TS[n])
    got = sorted((r.sk, r.id, r.v, r.valid_from.strftime("%Y-%m-%d %H:%M:%S"),
                  None if r.is_current else r.valid_to.strftime("%Y-%m-%d %H:%M:%S")) for r in dim.collect())
    assert got == model(snaps)


# ---------------------------------------------------------------------------- change logs and dedup

import datetime as _dt  # noqa: E402

from strata.operators import dedup  # noqa: E402

LOG_SPEC = scd2.ScdSpec("id", ["v"], [], "sk")
log_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["x", "y", None]),
                              st.integers(min_value=0, max_value=40)), min_size=1, max_size=80)


@settings(max_examples=10, deadline=None)
@given(log_rows)
def test_segmented_history_equals_simple_path(spark, rows):
    log = spark.createDataFrame([(k, v, _dt.datetime(2024, 1, 1) + _dt.timedelta(hours=t)) for k, v, t in rows],
                                "id string, v string, ts timestamp")
    simple = scd2.from_changes(log, LOG_SPEC, "ts")
    split = scd2.from_changes(log, LOG_SPEC, "ts", partitions=5, max_group_rows=3)
    assert sorted(map(tuple, simple.collect())) == sorted(map(tuple, split.collect()))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 10 ** 6)), min_size=1, max_size=60, unique_by=lambda r: r[2]),
       st.sampled_from(["asc", "desc"]))
def test_keep_one_matches_model(spark, rows, order):
    df = spark.createDataFrame(rows, "k string, o int, tb long")
    got = {r.k: r.tb for r in dedup.keep_one(df, ["k"], "o", order, ["tb"]).collect()}
    exp = {}
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        if order == "desc":  # largest non-null o wins, nulls last; ties -> larger tb
            best = max(group, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        else:  # smallest o wins, nulls first; ties -> smaller tb
            best = min(group, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        exp[k] = best[2]
    assert got == exp
