"""Registered queries (Spark, through the library) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables.  Inputs that the tables lack (contacts, courses, accounts,
metric rows) are derived by the shared SQL of ``sources.derived``; the
oracle is an independent SQL formulation of the *operator* over the same
derived input.  Timestamps the library keeps as TIMESTAMP are shown as text
here (``yyyy-MM-dd HH:mm:ss``) and the open end as NULL, so results compare
across engines.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import cleaning, validators
from strata.functions.hashing import row_hash
from strata.operators import compare, dedup, gold, quarantine, repair, rules as R, scd2, whitelist
from strata.operators.keys import assign_dense
from strata.plans import jobs, monitor
from strata.sources import derived as D
from strata.sources import io
from strata.session import checkpoint_dir
from strata.sources.config import CONTACT_RECORD_COLUMNS, CONTACT_RULES, CONTACT_SILVER_COLUMNS, ConfigEntry, seed_rule

RUN = jobs.Run("20240101_020000", datetime.datetime(2024, 1, 1, 2, 0, 0))
SCD_TS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-04-01 00:00:00"]
TODAY = "2024-01-30"
CONTACT_SPEC = scd2.ScdSpec("contactid", ["emailaddress1", "mobilephone", "firstname", "surname"],
                            ["address1_city"], "contact_sk")


def _fmt(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _dim_out(dim: DataFrame, spec: scd2.ScdSpec) -> DataFrame:
    return dim.select(*spec.payload, spec.surrogate_key, spec.hash_value,
                      _fmt(spec.valid_from).alias("valid_from_s"),
                      F.when(~F.col(spec.is_current), _fmt(spec.valid_to)).alias("valid_to_s"),
                      spec.is_current)


# ============================================================================ DuckDB fragments

EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z'"
PHONE = r"'^(\+49|0)[1-9]\p{Nd}{8,14}\n?\z'"
BLANK = r"'^[\s\x0b\x1c-\x1f\x85\p{Z}]*\z'"


def _d_email(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {EMAIL}), false)"


def _d_phone(x: str) -> str:
    return f"coalesce({x} IS NULL OR {x} = '' OR regexp_matches(translate({x}, ' -()', ''), {PHONE}), false)"


def _d_nb(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT coalesce(regexp_matches(CAST({x} AS VARCHAR), {BLANK}), false))"


D_CONTACT = D.duck(D.BRONZE_CONTACT_SQL)
D_CONTACT_EVAL = f"""
  c AS ({D_CONTACT}),
  v AS (SELECT c.*, {_d_email('emailaddress1')} AS email_ok, {_d_phone('mobilephone')} AS phone_ok,
               {_d_nb('firstname')} AS firstname_ok, {_d_nb('surname')} AS surname_ok FROM c),
  e AS (SELECT v.*, email_ok AND phone_ok AND firstname_ok AND surname_ok AS is_valid FROM v)
"""


def _spark_contact_eval(spark, sf) -> tuple[DataFrame, list]:
    rules = R.compile_rules(CONTACT_RULES)
    return R.evaluate(D.bronze_contact(spark, sf), rules, with_score=True), rules


# ============================================================================ B: validation

def q_dq_verdicts(spark, sf):
    ev, _ = _spark_contact_eval(spark, sf)
    return ev.select("contactid", "versionnumber", F.col("_email_valid").alias("email_ok"),
                     F.col("_phone_valid").alias("phone_ok"), F.col("_firstname_valid").alias("firstname_ok"),
                     F.col("_surname_valid").alias("surname_ok"), F.col("_is_valid").alias("is_valid"))


O_DQ_VERDICTS = f"""WITH {D_CONTACT_EVAL}
SELECT contactid, versionnumber, email_ok, phone_ok, firstname_ok, surname_ok, is_valid FROM e"""


def q_dq_breakdown(spark, sf):
    ev, rules = _spark_contact_eval(spark, sf)
    return R.breakdown(ev, rules)


O_DQ_BREAKDOWN = f"""WITH {D_CONTACT_EVAL}
SELECT email_ok, phone_ok, firstname_ok, surname_ok, count(*) AS row_count FROM e GROUP BY ALL"""


def q_dq_score(spark, sf):
    ev, _ = _spark_contact_eval(spark, sf)
    return ev.select("versionnumber", F.col("_dq_score").alias("dq_score"))


O_DQ_SCORE = f"""WITH {D_CONTACT_EVAL}
SELECT versionnumber, CAST(100.0 * (CAST(email_ok AS INT) + CAST(phone_ok AS INT) + CAST(firstname_ok AS INT)
       + CAST(surname_ok AS INT)) AS DOUBLE) / 4 AS dq_score FROM e"""


def q_dq_rule_failures(spark, sf):
    ev, rules = _spark_contact_eval(spark, sf)
    return R.failure_counts(ev, rules)


O_DQ_RULE_FAILURES = f"""WITH {D_CONTACT_EVAL}
SELECT 'email_invalid' AS rule_name, 'email' AS rule_key, CAST(count_if(NOT email_ok) AS BIGINT) AS failed, count(*) AS total FROM e
UNION ALL SELECT 'phone_invalid', 'phone', CAST(count_if(NOT phone_ok) AS BIGINT), count(*) FROM e
UNION ALL SELECT 'firstname_null', 'firstname', CAST(count_if(NOT firstname_ok) AS BIGINT), count(*) FROM e
UNION ALL SELECT 'surname_null', 'surname', CAST(count_if(NOT surname_ok) AS BIGINT), count(*) FROM e"""


def q_dq_course_rules(spark, sf):
    rules = R.compile_rules(seed_rule("hs_course_bronze_silver_dq")["validations"])
    ev = R.evaluate(D.bronze_course(spark, sf), rules)
    return ev.select("hs_courseid", *[F.col(r.flag).alias(f"{r.key}_ok") for r in rules],
                     F.col("_is_valid").alias("is_valid"))


D_COURSE_EVAL = f"""
  c AS ({D.duck(D.BRONZE_COURSE_SQL)}),
  v AS (SELECT c.*, {_d_nb('hs_name')} AS hs_name_ok, hs_startdate IS NOT NULL AS hs_startdate_ok,
        hs_enddate IS NOT NULL AS hs_enddate_ok, coalesce(hs_startdate < hs_enddate, false) AS date_logic_check_ok,
        (hs_coursestatus IS NULL OR coalesce(hs_coursestatus IN ('Planned', 'Active', 'Completed', 'Cancelled'), false))
          AS hs_coursestatus_ok FROM c)
"""
O_DQ_COURSE_RULES = f"""WITH {D_COURSE_EVAL}
SELECT hs_courseid, hs_name_ok, hs_startdate_ok, hs_enddate_ok, date_logic_check_ok, hs_coursestatus_ok,
       hs_name_ok AND hs_startdate_ok AND hs_enddate_ok AND date_logic_check_ok AND hs_coursestatus_ok AS is_valid
FROM v"""

CUSTOMER_RULES = [
    {"field": "c_acctbal", "type": "range", "min": 0, "required": True, "name": "negative_balance"},
    {"field": "c_mktsegment", "type": "enum", "allowed_values": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
     "required": True},
    {"field": "c_name", "type": "regex", "pattern": "^Customer#[0-9]{9}$", "required": True},
]


def q_dq_customer_rules(spark, sf):
    rules = R.compile_rules(CUSTOMER_RULES)
    ev = R.evaluate(D.table(spark, sf, "customer"), rules)
    return ev.select("c_custkey", *[F.col(r.flag).alias(f"{r.key}_ok") for r in rules],
                     F.col("_is_valid").alias("is_valid"))


O_DQ_CUSTOMER_RULES = """WITH v AS (SELECT c_custkey, coalesce(c_acctbal >= 0, false) AS c_acctbal_ok,
  (c_mktsegment IS NOT NULL AND coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'), false))
    AS c_mktsegment_ok,
  coalesce(regexp_matches(c_name, '^Customer#[0-9]{9}$'), false) AS c_name_ok FROM customer)
SELECT *, c_acctbal_ok AND c_mktsegment_ok AND c_name_ok AS is_valid FROM v"""

D_ACCOUNT_EVAL = f"""
  a AS ({D.duck(D.BRONZE_ACCOUNT_SQL)}),
  v AS (SELECT a.*, {_d_nb('name')} AS name_ok,
    (hs_partner_level IS NULL OR coalesce(hs_partner_level IN ('Bronze', 'Silver', 'Gold', 'Platinum'), false))
      AS hs_partner_level_ok,
    (emailaddress1 IS NULL OR emailaddress1 = ''
      OR coalesce(regexp_matches(emailaddress1, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$'), false))
      AS emailaddress1_ok FROM a)
"""


def q_dq_account_rules(spark, sf):
    rules = R.compile_rules(seed_rule("account_bronze_silver_dq")["validations"])
    ev = R.evaluate(D.bronze_account(spark, sf), rules)
    return ev.select("accountid", *[F.col(r.flag).alias(f"{r.key}_ok") for r in rules],
                     F.col("_is_valid").alias("is_valid"))


O_DQ_ACCOUNT_RULES = f"""WITH {D_ACCOUNT_EVAL}
SELECT accountid, name_ok, hs_partner_level_ok, emailaddress1_ok,
       name_ok AND hs_partner_level_ok AND emailaddress1_ok AS is_valid FROM v"""

WHITELIST_ROWS = [
    ("w1", "account", "emailaddress1", "regex", "kontakt@firma", "shared inbox", True, None),
    ("w2", "account", "hs_partner_level", "enum", "None", "legacy level", True, None),
    ("w3", "account", "name", "not_null", " ", "expired exception", True, "2023-12-31 00:00:00"),
    ("w4", "account", "emailaddress1", "regex", "%@firma.com", "inactive", False, None),
]


def whitelist_frame(spark: SparkSession) -> DataFrame:
    from strata.sources.schemas import DQ_WHITELIST
    rows = [(i, t, f, rt, p, why, act, datetime.datetime.fromisoformat(exp) if exp else None,
             datetime.datetime(2023, 1, 1), "steward") for i, t, f, rt, p, why, act, exp in WHITELIST_ROWS]
    return spark.createDataFrame(rows, DQ_WHITELIST)


def q_dq_whitelist(spark, sf):
    rules = R.compile_rules(seed_rule("account_bronze_silver_dq")["validations"])
    ev = R.evaluate(D.bronze_account(spark, sf), rules, whitelist=whitelist_frame(spark), table="account",
                    as_of=RUN.run_ts)
    return ev.select("accountid", *[F.col(r.flag).alias(f"{r.key}_ok") for r in rules],
                     F.col("_is_valid").alias("is_valid"))


O_DQ_WHITELIST = f"""WITH {D_ACCOUNT_EVAL},
  w AS (SELECT accountid, name_ok,
     hs_partner_level_ok OR coalesce(hs_partner_level = 'None', false) AS hs_partner_level_ok,
     emailaddress1_ok OR coalesce(emailaddress1 = 'kontakt@firma', false) AS emailaddress1_ok FROM v)
SELECT *, name_ok AND hs_partner_level_ok AND emailaddress1_ok AS is_valid FROM w"""


# Part names against a rule that most of them fail, and over three entries for each part: exact names, LIKE and regex patterns,
# near misses, nulls, expired and inactive ones (by key arithmetic; every part gives its entries).
WL_RULES = [{"field": "p_name", "type": "regex", "name": "name_short", "pattern": "^.{1,11}$", "required": True},
            {"field": "p_type", "type": "enum", "name": "type_known", "allowed_values": ["STANDARD"], "required": True}]
WL_PARTS_SQL = """
SELECT p_partkey, CASE p_partkey % 41 WHEN 40 THEN NULL WHEN 39 THEN '' ELSE p_name || ' ' || CAST(p_partkey AS STRING) END AS p_name, p_type
FROM {part}"""
WL_ENTRIES_SQL = """
SELECT 'w' || CAST(p_partkey AS STRING) || '_' || CAST(k AS STRING) AS whitelist_id, 'part' AS table_name,
  CASE WHEN k = 3 THEN 'p_type' ELSE 'p_name' END AS field_name,
  CASE WHEN k = 3 THEN 'enum' ELSE 'regex' END AS rule_type,
  CASE WHEN p_partkey % 23 = 0 THEN NULL
       WHEN k = 0 THEN p_name || ' ' || CAST(p_partkey + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1000000 END AS STRING)
       WHEN k = 1 THEN '%' || substr(p_name, 3, 9) || '_' || CAST(p_partkey * 7 AS STRING) || '%'
       WHEN k = 2 THEN '.*' || substr(p_name, 1, 8) || '.* ' || CAST(p_partkey % 97 AS STRING) || '[0-4]'
       ELSE p_type || CASE WHEN p_partkey % 400 = 7 THEN '' ELSE CAST(p_partkey AS STRING) END END AS pattern,
  p_partkey % 19 <> 0 AS active,
  CASE WHEN p_partkey % 13 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' END AS expires_at
FROM (SELECT *, 0 AS k FROM {part} UNION ALL SELECT *, 1 FROM {part} UNION ALL SELECT *, 2 FROM {part} UNION ALL SELECT *, 3 FROM {part}) ks"""


def q_dq_whitelist_large(spark, sf):
    part = D.table(spark, sf, "part")
    ev = R.evaluate(spark.sql(WL_PARTS_SQL, part=part), R.compile_rules(WL_RULES),
                    whitelist=spark.sql(WL_ENTRIES_SQL, part=part), table="part", as_of=RUN.run_ts)
    return ev.select("p_partkey", F.col("_p_name_valid").alias("name_ok"), F.col("_p_type_valid").alias("type_ok"),
                     F.col("_is_valid").alias("is_valid"))


O_DQ_WHITELIST_LARGE = f"""WITH p AS ({D.duck(WL_PARTS_SQL)}),
  e AS (SELECT DISTINCT field_name, pattern FROM ({D.duck(WL_ENTRIES_SQL)})
        WHERE active AND (expires_at IS NULL OR expires_at > TIMESTAMP '{RUN.run_ts}') AND pattern IS NOT NULL),
  good AS (SELECT DISTINCT p_partkey, field_name FROM p JOIN e ON
    CASE WHEN field_name = 'p_type' THEN p_type = pattern OR CASE WHEN contains(pattern, '%') THEN p_type LIKE pattern ELSE regexp_full_match(p_type, pattern) END
         ELSE p_name = pattern OR CASE WHEN contains(pattern, '%') THEN p_name LIKE pattern ELSE regexp_full_match(p_name, pattern) END END),
  v AS (SELECT p_partkey,
    coalesce(regexp_matches(p_name, '^.{{1,11}}$'), false) OR EXISTS (FROM good g WHERE g.p_partkey = p.p_partkey AND field_name = 'p_name') AS name_ok,
    coalesce(p_type = 'STANDARD', false) OR EXISTS (FROM good g WHERE g.p_partkey = p.p_partkey AND field_name = 'p_type') AS type_ok FROM p)
SELECT *, name_ok AND type_ok AS is_valid FROM v"""


def q_dq_whitelist_report(spark, sf):
    return whitelist.report(spark.sql(WL_ENTRIES_SQL, part=D.table(spark, sf, "part")), "part", RUN.run_ts).drop("unindexed")


O_DQ_WHITELIST_REPORT = f"""SELECT field_name, rule_type, CASE WHEN pattern IS NULL THEN 'null' WHEN contains(pattern, '%') THEN 'like' ELSE 'regex' END AS kind,
  count(DISTINCT coalesce(pattern, '')) AS entries
FROM ({D.duck(WL_ENTRIES_SQL)}) WHERE active AND (expires_at IS NULL OR expires_at > TIMESTAMP '{RUN.run_ts}') GROUP BY 1, 2, 3"""


def q_dq_actions(spark, sf):
    vals = [dict(v) for v in seed_rule("hs_course_bronze_silver_dq")["validations"]]
    for v in vals:
        if v["type"] == "enum":
            v["error_action"] = "flag"
        if v["type"] == "custom":
            v["error_action"] = "reject"
    rules = R.compile_rules(vals)
    ev = R.evaluate(D.bronze_course(spark, sf), rules)
    outcome = (F.when(F.col("_is_valid"), F.lit("valid")).when(F.col("_is_rejected"), F.lit("rejected"))
               .otherwise(F.lit("quarantined")))
    return ev.select("hs_courseid", outcome.alias("outcome"), (F.size("_dq_flags") > 0).alias("flagged"))


O_DQ_ACTIONS = f"""WITH {D_COURSE_EVAL}
SELECT hs_courseid,
  CASE WHEN hs_name_ok AND hs_startdate_ok AND hs_enddate_ok AND date_logic_check_ok THEN 'valid'
       WHEN NOT date_logic_check_ok THEN 'rejected' ELSE 'quarantined' END AS outcome,
  NOT hs_coursestatus_ok AS flagged FROM v"""


# ============================================================================ C: cleaning

def q_clean_ops(spark, sf):
    ev, rules = _spark_contact_eval(spark, sf)
    valid = R.strip_helpers(ev.filter("_is_valid"), rules)
    out = cleaning.apply_ops(valid, seed_rule("contact_bronze_silver_dq")["transformations"])
    return out.select("versionnumber", "contactid", "firstname", "surname", "emailaddress1", "mobilephone")


O_CLEAN_OPS = f"""WITH {D_CONTACT_EVAL}
SELECT versionnumber, contactid, trim(firstname) AS firstname, trim(surname) AS surname,
       lower(trim(emailaddress1)) AS emailaddress1, trim(mobilephone) AS mobilephone FROM e WHERE is_valid"""


def q_clean_ops_extra(spark, sf):
    b = D.bronze_contact(spark, sf).select("versionnumber", "firstname", "surname", "mobilephone", "address1_city")
    out = cleaning.apply_ops(b, [{"field": "firstname", "operations": ["remove_whitespace", "uppercase"]},
                                 {"field": "surname", "operations": ["trim", "uppercase"]},
                                 {"field": "mobilephone", "operations": ["normalize_phone", "fill_unknown"]},
                                 {"field": "address1_city", "operations": ["lowercase"]}])
    return out


O_CLEAN_OPS_EXTRA = f"""WITH c AS ({D_CONTACT})
SELECT versionnumber, upper(regexp_replace(firstname, '[\\t\\n\\x0b\\f\\r ]+', '', 'g')) AS firstname,
  upper(trim(surname)) AS surname,
  coalesce(regexp_replace(translate(mobilephone, ' -()', ''), '^0', '+49'), 'UNKNOWN') AS mobilephone,
  lower(address1_city) AS address1_city FROM c"""


def q_phone_normalize(spark, sf):
    b = D.bronze_contact(spark, sf).filter(F.col("mobilephone").isNotNull())
    return b.select("versionnumber", "mobilephone",
                    cleaning.op_expr("mobilephone", ["normalize_phone"]).alias("phone_normalized"))


O_PHONE_NORMALIZE = f"""WITH c AS ({D_CONTACT})
SELECT versionnumber, mobilephone, regexp_replace(translate(mobilephone, ' -()', ''), '^0', '+49') AS phone_normalized
FROM c WHERE mobilephone IS NOT NULL"""


# ============================================================================ D: dedup + the whole silver job

def q_silver_contact(spark, sf):
    rule = {"validations": CONTACT_RULES,
            "transformations": [{"field": "firstname", "operations": ["trim"]},
                                {"field": "surname", "operations": ["trim"]},
                                {"field": "emailaddress1", "operations": ["trim", "lowercase"]},
                                {"field": "mobilephone", "operations": ["trim"]}],
            "deduplication": {"enabled": True, "key_fields": ["contactid"], "order_by": "modifiedon",
                              "order": "desc", "tie_breakers": ["versionnumber"]}}
    f = jobs.dq_frames(D.bronze_contact(spark, sf), rule, "contact", RUN,
                       silver_columns=CONTACT_SILVER_COLUMNS, record_columns=CONTACT_RECORD_COLUMNS)
    return f.silver.drop("_silver_timestamp")


O_SILVER_CONTACT = f"""WITH {D_CONTACT_EVAL},
  s AS (SELECT * FROM e WHERE is_valid
        QUALIFY row_number() OVER (PARTITION BY contactid ORDER BY modifiedon DESC NULLS LAST, versionnumber DESC) = 1)
SELECT contactid, trim(firstname) AS firstname, trim(surname) AS surname, lower(trim(emailaddress1)) AS emailaddress1,
  trim(mobilephone) AS mobilephone, address1_city, address1_postalcode, birthdate, gendercode, createdon, modifiedon,
  statecode, statuscode, '20240101_020000' AS _silver_loaded_at FROM s"""


def q_dedup_latest(spark, sf):
    ev = D.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return dedup.keep_one(ev, ["user_id"], "ts", "desc", ["event_id"])


O_DEDUP_LATEST = """SELECT event_id, user_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""


def q_dedup_first(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return dedup.keep_one(o, ["o_custkey"], "o_orderdate", "asc", ["o_orderkey"])


O_DEDUP_FIRST = """SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC) = 1"""


def q_dedup_agg(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return dedup.keep_one_agg(o, ["o_custkey"], "o_orderdate", "desc", ["o_orderkey"])


O_DEDUP_AGG = """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"""


# ============================================================================ E: quarantine

def _spark_quarantine(spark, sf) -> DataFrame:
    ev, rules = _spark_contact_eval(spark, sf)
    _, bad, _ = R.split(ev)
    return quarantine.build(bad, rules, "contact", RUN.run_id, RUN.run_ts, CONTACT_RECORD_COLUMNS)


def q_quarantine_records(spark, sf):
    q = _spark_quarantine(spark, sf)
    return q.select("source_table", "pipeline_run_id", "error_type", "error_message", "error_field", "status",
                    *[F.get_json_object("raw_record", f"$.{c}").alias(c) for c in CONTACT_RECORD_COLUMNS])


D_QUARANTINE = f"""{D_CONTACT_EVAL},
  q AS (SELECT 'contact' AS source_table, '20240101_020000' AS pipeline_run_id,
    CASE WHEN NOT email_ok THEN 'email_invalid' WHEN NOT phone_ok THEN 'phone_invalid'
         WHEN NOT firstname_ok THEN 'firstname_null' WHEN NOT surname_ok THEN 'surname_null' ELSE 'unknown' END AS error_type,
    concat_ws('; ', CASE WHEN NOT email_ok THEN 'Invalid email format' END,
      CASE WHEN NOT phone_ok THEN 'Invalid phone format' END, CASE WHEN NOT firstname_ok THEN 'First name is null' END,
      CASE WHEN NOT surname_ok THEN 'Surname is null' END) AS error_message,
    CASE WHEN NOT email_ok THEN 'emailaddress1' WHEN NOT phone_ok THEN 'mobilephone'
         WHEN NOT firstname_ok THEN 'firstname' WHEN NOT surname_ok THEN 'surname' ELSE 'multiple' END AS error_field,
    'new' AS status, contactid, firstname, surname, emailaddress1, mobilephone
    FROM e WHERE NOT is_valid)
"""
O_QUARANTINE_RECORDS = f"""WITH {D_QUARANTINE} SELECT * FROM q"""


def q_quarantine_by_type(spark, sf):
    return quarantine.by_type(_spark_quarantine(spark, sf))


O_QUARANTINE_BY_TYPE = f"""WITH {D_QUARANTINE} SELECT error_type, count(*) AS error_count FROM q GROUP BY error_type"""


def q_quarantine_by_message(spark, sf):
    return quarantine.by_message(_spark_quarantine(spark, sf))


O_QUARANTINE_BY_MESSAGE = f"""WITH {D_QUARANTINE}
SELECT source_table, error_type, error_message, count(*) AS occurrences FROM q GROUP BY ALL"""

RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONTACT_RECORD_COLUMNS])
REPAIR_FIXES = {"emailaddress1": [("@@", "@"), (r"^\s+", "")]}


def q_quarantine_repair(spark, sf):
    q = _spark_quarantine(spark, sf)
    repaired, _ = quarantine.repair(q, RECORD_SCHEMA, REPAIR_FIXES, CONTACT_RULES)
    return repaired


O_QUARANTINE_REPAIR = f"""WITH {D_QUARANTINE},
  f AS (SELECT contactid, firstname, surname,
          regexp_replace(regexp_replace(emailaddress1, '@@', '@', 'g'), '^[\\t\\n\\x0b\\f\\r ]+', '', 'g') AS emailaddress1,
          mobilephone FROM q)
SELECT contactid, firstname, surname, emailaddress1, mobilephone FROM f
WHERE {_d_email('emailaddress1')} AND {_d_phone('mobilephone')} AND {_d_nb('firstname')} AND {_d_nb('surname')}"""


REPAIRS = {
    "contact": repair.TableRepair(CONTACT_RULES, REPAIR_FIXES),
    "account": repair.TableRepair(seed_rule("account_bronze_silver_dq")["validations"], {
        "emailaddress1": [("^kontakt@firma$", "kontakt@firma.de")], "hs_partner_level": [("^None$", "Bronze")]}),
    "hs_course": repair.TableRepair(seed_rule("hs_course_bronze_silver_dq")["validations"], {
        "hs_coursestatus": [("^Pending$", "Planned")]}, {"hs_startdate": "timestamp_ntz", "hs_enddate": "timestamp_ntz"}),
}


def q_quarantine_repair_all(spark, sf):
    """The quarantine of contacts, accounts and courses, repaired in one pass."""
    q = None
    for table, bronze, cols in (("contact", D.bronze_contact, CONTACT_RECORD_COLUMNS), ("account", D.bronze_account, None),
                                ("hs_course", D.bronze_course, None)):
        rules = R.compile_rules(REPAIRS[table].validations)
        bad = R.split(R.evaluate(bronze(spark, sf), rules))[1]
        rows = quarantine.build(bad, rules, table, RUN.run_id, RUN.run_ts, cols, keep_nulls=True)
        q = rows if q is None else q.unionByName(rows)
    out = repair.repair_all(q, REPAIRS, RUN.run_ts)
    raw, done = F.col("raw_record"), F.col("repaired_record")
    ids = F.coalesce(*[F.get_json_object(raw, f"$.{c}") for c in ("contactid", "accountid", "hs_courseid")])
    return out.select("source_table", ids.alias("record_id"), "status", "resolved_by",
                      *[F.get_json_object(done, f"$.{c}").alias(c) for c in ("emailaddress1", "hs_partner_level", "hs_coursestatus")],
                      F.when(done.isNotNull(), F.size(F.json_object_keys(done))).alias("n_fields"))


O_QUARANTINE_REPAIR_ALL = f"""WITH
  contacts AS (WITH {D_QUARANTINE} SELECT contactid, mobilephone, firstname, surname,
    regexp_replace(regexp_replace(emailaddress1, '@@', '@', 'g'), '^[\\t\\n\\x0b\\f\\r ]+', '', 'g') AS mail FROM q),
  accounts AS (WITH {D_ACCOUNT_EVAL} SELECT accountid, name_ok,
    CASE WHEN emailaddress1 = 'kontakt@firma' THEN 'kontakt@firma.de' ELSE emailaddress1 END AS mail,
    CASE WHEN hs_partner_level = 'None' THEN 'Bronze' ELSE hs_partner_level END AS lev
    FROM v WHERE NOT (name_ok AND hs_partner_level_ok AND emailaddress1_ok)),
  courses AS (WITH {D_COURSE_EVAL} SELECT hs_courseid, hs_name_ok AND hs_startdate_ok AND hs_enddate_ok AND date_logic_check_ok AS ok,
    CASE WHEN hs_coursestatus = 'Pending' THEN 'Planned' ELSE hs_coursestatus END AS cs
    FROM v WHERE NOT (hs_name_ok AND hs_startdate_ok AND hs_enddate_ok AND date_logic_check_ok AND hs_coursestatus_ok)),
  r AS (SELECT 'contact' AS source_table, contactid AS record_id, mail, NULL AS lev, NULL AS cs, {len(CONTACT_RECORD_COLUMNS)} AS n,
      {_d_email('mail')} AND {_d_phone('mobilephone')} AND {_d_nb('firstname')} AND {_d_nb('surname')} AS ok FROM contacts
    UNION ALL SELECT 'account', accountid, mail, lev, NULL, 10, name_ok AND coalesce(lev IN ('Bronze', 'Silver', 'Gold', 'Platinum'), true)
      AND (coalesce(mail, '') = '' OR regexp_matches(mail, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')) FROM accounts
    UNION ALL SELECT 'hs_course', hs_courseid, NULL, NULL, cs, 9, ok AND coalesce(cs IN ('Planned', 'Active', 'Completed', 'Cancelled'), true) FROM courses)
SELECT source_table, record_id, CASE WHEN ok THEN 'fixed' ELSE 'new' END AS status, CASE WHEN ok THEN 'repair' END AS resolved_by,
  CASE WHEN ok THEN mail END AS emailaddress1, CASE WHEN ok THEN lev END AS hs_partner_level, CASE WHEN ok THEN cs END AS hs_coursestatus,
  CASE WHEN ok THEN CAST(n AS INTEGER) END AS n_fields FROM r"""


# ============================================================================ F: hashing and type-2 history

def q_row_hash(spark, sf):
    li = D.table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
    return li.select("l_orderkey", "l_linenumber", row_hash(cols).alias("hash_value"))


O_ROW_HASH = """SELECT l_orderkey, l_linenumber, md5(concat_ws('|', coalesce(CAST(l_quantity AS VARCHAR), 'NULL'),
  coalesce(CAST(l_extendedprice AS VARCHAR), 'NULL'), coalesce(CAST(l_discount AS VARCHAR), 'NULL'),
  coalesce(CAST(l_tax AS VARCHAR), 'NULL'), coalesce(CAST(l_returnflag AS VARCHAR), 'NULL'),
  coalesce(CAST(l_shipdate AS VARCHAR), 'NULL'))) AS hash_value FROM lineitem"""


def _dims(spark, sf, upto: int) -> DataFrame:
    """The dimension after ``upto`` runs; each version is checkpointed, as a
    job writes each version, so the next merge reads it instead of its lineage."""
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dim = scd2.initial_load(D.contact_snapshot(spark, sf, 1), CONTACT_SPEC, SCD_TS[0]).checkpoint(eager=True)
    for n in range(2, upto + 1):
        # a merge result is a union (history + kept + new): coalesce (narrow) so the
        # partition count does not grow with every chained run
        dim = (scd2.merge(dim, D.contact_snapshot(spark, sf, n), CONTACT_SPEC, SCD_TS[n - 1])
               .coalesce(parts).checkpoint(eager=True))
    return dim


_STORED: dict = {}


def _stored(spark, sf, name: str, build):
    """A gold table as later queries find it: built once per session and
    input folder and checkpointed (the job writes it as a version).  Queries
    that *read* a dimension use this; the merge/build queries build fresh."""
    # built values depend on the session time zone (text <-> timestamp casts)
    key = (id(spark), spark.sparkContext.applicationId, sf, name, spark.conf.get("spark.sql.session.timeZone"))
    df = _STORED.get(key)
    if df is None:
        df = build()
        _STORED[key] = df
    return df


def _stored_dim(spark, sf, upto: int) -> DataFrame:
    return _stored(spark, sf, f"dim{upto}", lambda: _dims(spark, sf, upto))


def _d_hash(cols: list[str]) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in cols) + "))"


def _d_dim(upto: int) -> str:
    """Independent oracle of ``upto`` merges: all snapshots with their run,
    keep a key's row when its hash differs from its previous appearance."""
    snaps = " UNION ALL ".join(
        f"SELECT *, {n} AS n, TIMESTAMP '{SCD_TS[n - 1]}' AS ts FROM ({D.duck_snapshot(n)})" for n in range(1, upto + 1))
    h = _d_hash(CONTACT_SPEC.tracked)
    return f"""
  allsnap AS (SELECT *, {h} AS hash_value FROM ({snaps})),
  kept AS (SELECT * FROM allsnap
           QUALIFY lag(hash_value) OVER (PARTITION BY contactid ORDER BY n) IS DISTINCT FROM hash_value),
  dim AS (SELECT contactid, emailaddress1, mobilephone, firstname, surname, address1_city, hash_value,
            row_number() OVER (ORDER BY n, contactid) AS contact_sk,
            ts AS valid_from, lead(ts) OVER (PARTITION BY contactid ORDER BY n) AS valid_to_ts, n FROM kept)
"""


def _d_dim_out(upto: int) -> str:
    return f"""WITH {_d_dim(upto)}
SELECT contactid, emailaddress1, mobilephone, firstname, surname, address1_city, contact_sk, hash_value,
  strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from_s, strftime(valid_to_ts, '%Y-%m-%d %H:%M:%S') AS valid_to_s,
  valid_to_ts IS NULL AS is_current FROM dim"""


def q_scd2_initial(spark, sf):
    return _dim_out(_dims(spark, sf, 1), CONTACT_SPEC)


def q_scd2_merge(spark, sf):
    return _dim_out(_dims(spark, sf, 2), CONTACT_SPEC)


def q_scd2_merge_3(spark, sf):
    return _dim_out(_dims(spark, sf, 3), CONTACT_SPEC)


def q_scd2_classify(spark, sf):
    return scd2.classify(_stored_dim(spark, sf, 2), D.contact_snapshot(spark, sf, 3), CONTACT_SPEC) \
        .withColumnRenamed("_class", "change_class")


D_CLASSIFY = f"""{_d_dim(2)},
  cur AS (SELECT contactid, hash_value FROM dim WHERE valid_to_ts IS NULL),
  s3 AS (SELECT contactid, {_d_hash(CONTACT_SPEC.tracked)} AS hash_value FROM ({D.duck_snapshot(3)})),
  cls AS (SELECT coalesce(cur.contactid, s3.contactid) AS contactid,
    CASE WHEN cur.hash_value IS NULL THEN 'new' WHEN s3.hash_value IS NULL THEN 'missing'
         WHEN cur.hash_value = s3.hash_value THEN 'same' ELSE 'changed' END AS change_class
    FROM cur FULL OUTER JOIN s3 ON cur.contactid = s3.contactid)
"""
O_SCD2_CLASSIFY = f"WITH {D_CLASSIFY} SELECT contactid, change_class FROM cls"


def q_scd2_counts(spark, sf):
    return scd2.counts(scd2.classify(_stored_dim(spark, sf, 2), D.contact_snapshot(spark, sf, 3), CONTACT_SPEC))


O_SCD2_COUNTS = f"""WITH {D_CLASSIFY}
SELECT CAST(count_if(change_class = 'new') AS BIGINT) AS scd_inserts,
  CAST(count_if(change_class = 'changed') AS BIGINT) AS scd_updates,
  CAST(count_if(change_class = 'same') AS BIGINT) AS scd_no_changes,
  CAST(count_if(change_class = 'missing') AS BIGINT) AS scd_missing FROM cls"""


def q_scd2_as_of(spark, sf):
    return scd2.as_of(_stored_dim(spark, sf, 3), CONTACT_SPEC, "2024-02-15 00:00:00") \
        .select("contact_sk", "contactid", "emailaddress1", "surname")


O_SCD2_AS_OF = f"""WITH {_d_dim(3)}
SELECT contact_sk, contactid, emailaddress1, surname FROM dim
WHERE valid_from <= TIMESTAMP '2024-02-15 00:00:00'
  AND TIMESTAMP '2024-02-15 00:00:00' < coalesce(valid_to_ts, TIMESTAMP '9999-12-31 23:59:59')"""


def q_scd2_transitions(spark, sf):
    t = scd2.transitions(_stored_dim(spark, sf, 3), CONTACT_SPEC, "emailaddress1")
    return t.select("contactid", _fmt("changed_at").alias("changed_at_s"), "old_value", "new_value")


O_SCD2_TRANSITIONS = f"""WITH {_d_dim(3)},
  t AS (SELECT contactid, valid_from, lag(emailaddress1) OVER (PARTITION BY contactid ORDER BY valid_from) AS old_value,
          emailaddress1 AS new_value, row_number() OVER (PARTITION BY contactid ORDER BY valid_from) AS v FROM dim)
SELECT contactid, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS changed_at_s, old_value, new_value FROM t
WHERE v > 1 AND old_value IS DISTINCT FROM new_value"""


def q_scd2_period_counts(spark, sf):
    return scd2.change_counts(_stored_dim(spark, sf, 3), CONTACT_SPEC, "2024-01-15 00:00:00",
                              "2024-04-15 00:00:00", "month")


O_SCD2_PERIOD_COUNTS = f"""WITH {_d_dim(3)}
SELECT strftime(valid_from, '%Y-%m') AS period, count(*) AS new_versions, count(DISTINCT contactid) AS changed_keys
FROM dim WHERE valid_from >= TIMESTAMP '2024-01-15 00:00:00' AND valid_from < TIMESTAMP '2024-04-15 00:00:00'
GROUP BY 1"""


def _faulty(dim: DataFrame) -> DataFrame:
    """Planted faults: current versions with an upper-case surname get a second,
    earlier-starting current copy (two current rows, overlap); versions
    without a phone get valid_to = valid_from (empty range)."""
    extra = (dim.filter(F.col("is_current") & (F.col("surname") == F.upper("surname")))
             .withColumn("contact_sk", F.col("contact_sk") + 1000000)
             .withColumn("valid_from", F.col("valid_from") - F.expr("INTERVAL 1 DAY")))
    bad = dim.withColumn("valid_to", F.when(F.col("mobilephone").isNull(), F.col("valid_from"))
                         .otherwise(F.col("valid_to")))
    return bad.unionByName(extra)


def q_scd2_checks(spark, sf):
    return scd2.check_counts(_faulty(_stored_dim(spark, sf, 3)), CONTACT_SPEC)


O_SCD2_CHECKS = f"""WITH {_d_dim(3)},
  d0 AS (SELECT contactid, contact_sk, surname, mobilephone, valid_from,
           coalesce(valid_to_ts, TIMESTAMP '9999-12-31 23:59:59') AS valid_to, valid_to_ts IS NULL AS is_current FROM dim),
  d AS (SELECT contactid, contact_sk, valid_from,
          CASE WHEN mobilephone IS NULL THEN valid_from ELSE valid_to END AS valid_to, is_current FROM d0
        UNION ALL
        SELECT contactid, contact_sk + 1000000, valid_from - INTERVAL 1 DAY, valid_to, is_current FROM d0
        WHERE is_current AND surname = upper(surname)),
  one AS (SELECT contactid FROM d GROUP BY contactid HAVING count_if(is_current) <> 1),
  ov AS (SELECT * FROM (SELECT valid_from, max(valid_to) OVER (PARTITION BY contactid ORDER BY valid_from, contact_sk
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM d) WHERE pm > valid_from)
SELECT 'keys_not_one_current' AS "check", (SELECT count(*) FROM one) AS violations
UNION ALL SELECT 'overlapping_versions', (SELECT count(*) FROM ov)
UNION ALL SELECT 'invalid_date_ranges', (SELECT count(*) FROM d WHERE valid_from >= valid_to)"""


def q_surrogate_keys(spark, sf):
    c = D.table(spark, sf, "customer").select("c_custkey", "c_name")
    return assign_dense(c, ["c_name"], "customer_sk", 1000)


O_SURROGATE_KEYS = """SELECT c_custkey, c_name, 1000 + row_number() OVER (ORDER BY c_name) AS customer_sk FROM customer"""

HIST_SPEC = scd2.ScdSpec("contactid", ["emailaddress1", "mobilephone", "firstname", "surname"], [], "contact_sk")


def _history(spark, sf) -> DataFrame:
    ev, rules = _spark_contact_eval(spark, sf)
    valid = cleaning.apply_ops(R.strip_helpers(ev.filter("_is_valid"), rules),
                               seed_rule("contact_bronze_silver_dq")["transformations"])
    per_ts = dedup.keep_one(valid, ["contactid", "modifiedon"], "versionnumber", "desc", [])
    return scd2.from_changes(per_ts, HIST_SPEC, "modifiedon")


def q_scd2_from_changes(spark, sf):
    return _dim_out(_history(spark, sf), HIST_SPEC)


D_HISTORY = f"""{D_CONTACT_EVAL},
  cl AS (SELECT contactid, lower(trim(emailaddress1)) AS emailaddress1, trim(mobilephone) AS mobilephone,
           trim(firstname) AS firstname, trim(surname) AS surname, modifiedon FROM e WHERE is_valid
         QUALIFY row_number() OVER (PARTITION BY contactid, modifiedon ORDER BY versionnumber DESC) = 1),
  hh AS (SELECT *, {_d_hash(HIST_SPEC.tracked)} AS hash_value FROM cl),
  kept AS (SELECT * FROM hh QUALIFY lag(hash_value) OVER (PARTITION BY contactid ORDER BY modifiedon)
             IS DISTINCT FROM hash_value),
  hist AS (SELECT contactid, emailaddress1, mobilephone, firstname, surname, hash_value, modifiedon AS valid_from,
             lead(modifiedon) OVER (PARTITION BY contactid ORDER BY modifiedon) AS valid_to_ts,
             row_number() OVER (ORDER BY modifiedon, contactid) AS contact_sk FROM kept)
"""
O_SCD2_FROM_CHANGES = f"""WITH {D_HISTORY}
SELECT contactid, emailaddress1, mobilephone, firstname, surname, contact_sk, hash_value,
  strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from_s, strftime(valid_to_ts, '%Y-%m-%d %H:%M:%S') AS valid_to_s,
  valid_to_ts IS NULL AS is_current FROM hist"""


LOG_SPEC = scd2.ScdSpec("k", ["status"], [], "sk")


def _order_log(spark, sf) -> DataFrame:
    """Every order as a version of its customer; the orders divisible by three belong to one hot key."""
    o = D.table(spark, sf, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("k"),
        F.col("o_orderkey").cast("long").alias("sk"), F.col("o_orderdate").cast("date").alias("valid_from"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 90).cast("int")).alias("valid_to"),
        F.col("o_orderpriority").alias("status"))


D_ORDER_LOG = """log AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS k,
    CAST(o_orderkey AS BIGINT) AS sk, CAST(o_orderdate AS DATE) AS valid_from,
    CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS DATE) AS valid_to, o_orderpriority AS status FROM orders)"""


def q_scd2_overlap_hot(spark, sf):
    return scd2.check_overlap(_order_log(spark, sf), LOG_SPEC)


O_SCD2_OVERLAP_HOT = f"""WITH {D_ORDER_LOG}
SELECT k, sk, valid_from, valid_to, prev_max_valid_to FROM (SELECT *, max(valid_to) OVER (PARTITION BY k ORDER BY valid_from, sk
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_valid_to FROM log) WHERE prev_max_valid_to > valid_from"""


def q_scd2_transitions_hot(spark, sf):
    return scd2.transitions(_order_log(spark, sf), LOG_SPEC, "status")


O_SCD2_TRANSITIONS_HOT = f"""WITH {D_ORDER_LOG}
SELECT k, changed_at, old_value, new_value FROM (SELECT k, valid_from AS changed_at, lag(status) OVER w AS old_value, status AS new_value,
  row_number() OVER w AS v FROM log WINDOW w AS (PARTITION BY k ORDER BY valid_from, sk)) WHERE v > 1 AND old_value IS DISTINCT FROM new_value"""


# ============================================================================ stored tables: jobs that write and read back


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q_copy_append_retry(spark, sf):
    """A simple_copy in append mode, run twice under one run id (a retry) and once under another."""
    target = _folder(spark, "copy")
    rule = {"columns": ["o_orderkey", "o_custkey", "o_orderstatus"], "write_mode": "append"}
    entry = ConfigEntry("copy_orders", "orders", "orders_copy", "silver", "simple_copy", rule)
    for run_id in ("r1", "r1", "r2"):
        done = jobs.run_config(spark, [entry], lambda n: D.table(spark, sf, n), lambda n: target, jobs.Run(run_id, RUN.run_ts))
        if done[0]["status"] != "succeeded":
            raise RuntimeError(done[0]["error"])
    return io.read(spark, target).groupBy(*rule["columns"]).agg(F.count(F.lit(1)).alias("copies"))


O_COPY_APPEND_RETRY = """SELECT o_orderkey, o_custkey, o_orderstatus, 2 * count(*) AS copies FROM orders GROUP BY ALL"""


def q_layout_zorder(spark, sf):
    """A copy published in interleaved order of customer and date, read back (tests measure what filters read)."""
    target = _folder(spark, "orders_z")
    rule = {"columns": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"], "cluster_by": ["o_custkey", "o_orderdate"]}
    entry = ConfigEntry("copy_orders_z", "orders", "orders_z", "silver", "simple_copy", rule)
    done = jobs.run_config(spark, [entry], lambda n: D.table(spark, sf, n), lambda n: target, RUN)
    if done[0]["status"] != "succeeded":
        raise RuntimeError(done[0]["error"])
    return io.read_current(spark, target)


O_LAYOUT_ZORDER = """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders"""


def q_scd2_close_all_reopen(spark, sf):
    """Snapshot 1, an empty snapshot that closes every row, then snapshot 2: all of its keys open anew."""
    target = _folder(spark, "dim")
    rule = {"business_key": "contactid", "tracked_columns": CONTACT_SPEC.tracked, "additional_columns": CONTACT_SPEC.additional,
            "metadata_columns": {"surrogate_key": "contact_sk"}, "on_missing": "close"}
    snaps = [D.contact_snapshot(spark, sf, 1), D.contact_snapshot(spark, sf, 1).limit(0), D.contact_snapshot(spark, sf, 2)]
    for n, snap in enumerate(snaps):
        jobs.run_scd2(spark, snap, rule, "contact", target, None, jobs.Run(f"r{n}", datetime.datetime.fromisoformat(SCD_TS[n])))
    return _dim_out(io.read_dimension(spark, target), CONTACT_SPEC)


_REOPEN_COLS = "contactid, emailaddress1, mobilephone, firstname, surname, address1_city"
O_SCD2_CLOSE_ALL_REOPEN = f"""WITH a AS (SELECT {_REOPEN_COLS}, {_d_hash(CONTACT_SPEC.tracked)} AS hash_value,
    row_number() OVER (ORDER BY contactid) AS contact_sk FROM ({D.duck_snapshot(1)})),
  b AS (SELECT {_REOPEN_COLS}, {_d_hash(CONTACT_SPEC.tracked)} AS hash_value,
    (SELECT count(*) FROM a) + row_number() OVER (ORDER BY contactid) AS contact_sk FROM ({D.duck_snapshot(2)}))
SELECT *, '{SCD_TS[0]}' AS valid_from_s, '{SCD_TS[1]}' AS valid_to_s, false AS is_current FROM a
UNION ALL SELECT *, '{SCD_TS[2]}', NULL, true FROM b"""


def q_purge_roundtrip(spark, sf):
    """Three parts with names of digits, a purge that keeps 10 days, then a rerun of the second part's job."""
    target = _folder(spark, "events")
    ev = D.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    for k in range(3):
        io.append(ev.where(F.col("user_id") % 3 == k), target, part=f"00{k}", run_date=RUN.run_ts)
    io.purge(spark, target, "ts", datetime.datetime(2024, 1, 31), 10)
    io.append(ev.where(F.col("user_id") % 3 == 1), target, part="001", run_date=RUN.run_ts)
    return io.read(spark, target).select("event_id", "user_id", "event_type")


O_PURGE_ROUNDTRIP = """SELECT event_id, user_id, event_type FROM events WHERE user_id % 3 = 1 OR ts >= TIMESTAMP '2024-01-21 00:00:00'"""


def q_config_run_whitelist(spark, sf):
    """A configured run of the account check with whitelist and dq_rules: its silver table."""
    target = _folder(spark, "account")
    more = [("r1", "city_blocked", "account", None, "custom", '{"expression": "address1_city <> \'City3\'"}', "error", "quarantine", True),
            ("r2", "old", "account", "telephone1", "not_null", "{}", "error", "quarantine", False)]
    dq_rules = spark.createDataFrame(more, "rule_id string, rule_name string, table_name string, field_name string, rule_type string, "
                                           "rule_definition string, severity string, error_action string, active boolean")
    rule = seed_rule("account_bronze_silver_dq")
    entry = ConfigEntry("account_dq", "bronze.account", "silver.account", "silver", "dq_check", rule)
    done = jobs.run_config(spark, [entry], lambda n: D.bronze_account(spark, sf), lambda n: target, RUN,
                           whitelist=whitelist_frame(spark), dq_rules=dq_rules)
    if done[0]["status"] != "succeeded":
        raise RuntimeError(done[0]["error"])
    return io.read_current(spark, target).select("accountid", "hs_partner_level", "address1_city")


O_CONFIG_RUN_WHITELIST = f"""WITH {D_ACCOUNT_EVAL}
SELECT accountid, hs_partner_level, address1_city FROM v WHERE name_ok AND address1_city <> 'City3'
  AND (hs_partner_level_ok OR coalesce(hs_partner_level = 'None', false)) AND (emailaddress1_ok OR coalesce(emailaddress1 = 'kontakt@firma', false))"""


# ============================================================================ operators that had no query of their own


def q_date_order(spark, sf):
    course = D.bronze_course(spark, sf)
    return course.select("hs_courseid", validators.is_before("hs_startdate", "hs_enddate").alias("in_order"))


O_DATE_ORDER = f"""SELECT hs_courseid, coalesce(hs_startdate < hs_enddate, false) AS in_order FROM ({D.duck(D.BRONZE_COURSE_SQL)})"""


def q_sql_validators(spark, sf):
    validators.register_sql(spark)
    return spark.sql("SELECT versionnumber, validate_email(emailaddress1) AS email_ok, validate_phone_de(mobilephone) AS phone_ok, "
                     "validate_not_null(firstname) AS firstname_ok FROM {contact}", contact=D.bronze_contact(spark, sf))


O_SQL_VALIDATORS = f"""SELECT versionnumber, {_d_email('emailaddress1')} AS email_ok, {_d_phone('mobilephone')} AS phone_ok,
  {_d_nb('firstname')} AS firstname_ok FROM ({D.duck(D.BRONZE_CONTACT_SQL)})"""


def q_dedup_by_attribute(spark, sf):
    """The newest row of each e-mail address, whoever's it is."""
    rows = D.bronze_contact(spark, sf).where("emailaddress1 IS NOT NULL").select("emailaddress1", "contactid", "modifiedon", "versionnumber")
    return dedup.keep_one(rows, ["emailaddress1"], "modifiedon", "desc", ["versionnumber"])


O_DEDUP_BY_ATTRIBUTE = f"""SELECT emailaddress1, contactid, modifiedon, versionnumber FROM ({D.duck(D.BRONZE_CONTACT_SQL)})
WHERE emailaddress1 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY emailaddress1 ORDER BY modifiedon DESC, versionnumber DESC) = 1"""


def q_quarantine_review(spark, sf):
    """Review decisions by event: purchases are ignored, every seventh record is fixed; the rest stays."""
    q = _qrows(spark, sf).select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("resolution_notes", "string"), ("resolved_by", "string"), ("resolved_at", "timestamp_ntz"))])
    ids = q.select("quarantine_id", "error_type", "created_at", (F.col("quarantine_id").cast("long") % 7 == 0).alias("seventh"))
    decisions = ids.where((F.col("error_type") == "err_purchase") | F.col("seventh")).select(
        "quarantine_id", F.when(F.col("seventh"), "fixed").otherwise("ignored").alias("status"), F.lit("by rule").alias("resolution_notes"),
        F.lit("steward").alias("resolved_by"), F.col("created_at").cast("timestamp_ntz").alias("resolved_at"))
    return quarantine.resolve(q, decisions).groupBy("error_type", "status", "resolved_by").agg(
        F.count(F.lit(1)).alias("records"), F.count("resolved_at").alias("dated"))


O_QUARANTINE_REVIEW = f"""WITH q AS ({D.duck(D.QUARANTINE_FROM_EVENTS_SQL)}),
  r AS (SELECT error_type, CAST(quarantine_id AS BIGINT) % 7 = 0 AS seventh, error_type = 'err_purchase' AS bought, status, created_at FROM q)
SELECT error_type, CASE WHEN seventh THEN 'fixed' WHEN bought THEN 'ignored' ELSE status END AS status,
  CASE WHEN seventh OR bought THEN 'steward' END AS resolved_by, count(*) AS records,
  count(CASE WHEN seventh OR bought THEN created_at END) AS dated
FROM r GROUP BY ALL"""


def q_scd2_current(spark, sf):
    return scd2.current(_stored_dim(spark, sf, 3), CONTACT_SPEC).select("contactid", "emailaddress1", "surname", "contact_sk")


O_SCD2_CURRENT = f"""WITH {_d_dim(3)}
SELECT contactid, emailaddress1, surname, contact_sk FROM dim WHERE valid_to_ts IS NULL"""

ACCOUNT_SPEC = scd2.ScdSpec("accountid", ["name", "hs_partner_level", "emailaddress1"], ["address1_city"], "account_sk")
ACCOUNT_SNAPSHOT_SQL = """SELECT accountid, name, CASE WHEN CAST(accountid AS BIGINT) % 4 = 0 THEN 'Gold' ELSE hs_partner_level END AS hs_partner_level,
  emailaddress1, 'moved' AS address1_city FROM {account} WHERE CAST(accountid AS BIGINT) % 9 <> 0"""


def q_scd2_account(spark, sf):
    """Account history: all suppliers, then the snapshot in which a quarter turns Gold and a ninth is missing."""
    checkpoint_dir(spark)
    account = D.bronze_account(spark, sf)
    dim = scd2.initial_load(account.where("CAST(accountid AS BIGINT) % 5 <> 0"), ACCOUNT_SPEC, SCD_TS[0]).checkpoint(eager=True)
    return _dim_out(scd2.merge(dim, spark.sql(ACCOUNT_SNAPSHOT_SQL, account=account), ACCOUNT_SPEC, SCD_TS[1]), ACCOUNT_SPEC)


_ACCOUNT_COLS = "accountid, name, hs_partner_level, emailaddress1, address1_city"
O_SCD2_ACCOUNT = f"""WITH account AS ({D.duck(D.BRONZE_ACCOUNT_SQL)}),
  snaps AS (SELECT {_ACCOUNT_COLS}, 1 AS n, '{SCD_TS[0]}' AS ts FROM account WHERE CAST(accountid AS BIGINT) % 5 <> 0
    UNION ALL SELECT {_ACCOUNT_COLS}, 2, '{SCD_TS[1]}' FROM ({ACCOUNT_SNAPSHOT_SQL.format(account='account')})),
  hashed AS (SELECT *, {_d_hash(ACCOUNT_SPEC.tracked)} AS hash_value FROM snaps),
  kept AS (SELECT * FROM hashed QUALIFY lag(hash_value) OVER (PARTITION BY accountid ORDER BY n) IS DISTINCT FROM hash_value)
SELECT {_ACCOUNT_COLS}, row_number() OVER (ORDER BY n, accountid) AS account_sk, hash_value, ts AS valid_from_s,
  lead(ts) OVER (PARTITION BY accountid ORDER BY n) AS valid_to_s, lead(ts) OVER (PARTITION BY accountid ORDER BY n) IS NULL AS is_current FROM kept"""


def q_dq_run_metrics(spark, sf):
    """The metrics row that a written bronze -> silver run leaves, and what its tables hold."""
    silver, metrics, q = (_folder(spark, n) for n in ("silver", "metrics", "quarantine"))
    rule = {"validations": CONTACT_RULES, "transformations": [],
            "deduplication": {"enabled": True, "key_fields": ["contactid"], "order_by": "modifiedon", "tie_breakers": ["versionnumber"]}}
    jobs.run_dq(spark, D.bronze_contact(spark, sf), rule, "contact", silver, q, metrics, RUN)
    rows = io.read(spark, metrics).select("stage", "pipeline_name", "records_read", "records_written", "records_failed", "error_rate", "dq_score_avg")
    held = {"silver_rows": io.read_current(spark, silver), "quarantine_rows": io.read(spark, q)}
    return rows.select("*", *[t.agg(F.count(F.lit(1))).scalar().alias(n) for n, t in held.items()])


O_DQ_RUN_METRICS = f"""WITH {D_CONTACT_EVAL},
  n AS (SELECT count(*) AS r, count(*) FILTER (WHERE NOT is_valid) AS f, count(DISTINCT contactid) FILTER (WHERE is_valid) AS w FROM e)
SELECT 'bronze_to_silver' AS stage, 'bronze_to_silver_contact' AS pipeline_name, r AS records_read, w AS records_written, f AS records_failed,
  f::DOUBLE / r AS error_rate, 1.0::DOUBLE - f::DOUBLE / r AS dq_score_avg, w AS silver_rows, f AS quarantine_rows FROM n"""


# ============================================================================ H: gold

def q_fact_lookup(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    hist = _stored(spark, sf, "history", lambda: _history(spark, sf).checkpoint(eager=True))
    return gold.as_of_lookup(o, hist, "o_custkey", "contactid", "o_orderdate", "contact_sk")


O_FACT_LOOKUP = f"""WITH {D_HISTORY}
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice, coalesce(h.contact_sk, -1) AS contact_sk
FROM orders o LEFT JOIN hist h ON CAST(o.o_custkey AS VARCHAR) = h.contactid AND o.o_orderdate >= h.valid_from
  AND o.o_orderdate < coalesce(h.valid_to_ts, TIMESTAMP '9999-12-31 23:59:59')"""


SESSION_SPEC = scd2.ScdSpec("sessionid", ["sessionstateid"], [], "session_sk")


def _sessions(spark, sf) -> DataFrame:
    return scd2.from_changes(D.session_changes(spark, sf), SESSION_SPEC, "changed_at")


def q_scd2_session(spark, sf):
    return _dim_out(_sessions(spark, sf), SESSION_SPEC)


D_SESSION = f"""sh AS (SELECT *, {_d_hash(SESSION_SPEC.tracked)} AS hash_value FROM ({D.duck(D.SESSION_CHANGES_SQL)})),
  skept AS (SELECT * FROM sh QUALIFY lag(hash_value) OVER (PARTITION BY sessionid ORDER BY changed_at) IS DISTINCT FROM hash_value),
  sess AS (SELECT sessionid, sessionstateid, hash_value, changed_at AS valid_from,
             lead(changed_at) OVER (PARTITION BY sessionid ORDER BY changed_at) AS valid_to_ts,
             row_number() OVER (ORDER BY changed_at, sessionid) AS session_sk FROM skept)
"""
O_SCD2_SESSION = f"""WITH {D_SESSION}
SELECT sessionid, sessionstateid, session_sk, hash_value, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from_s,
  strftime(valid_to_ts, '%Y-%m-%d %H:%M:%S') AS valid_to_s, valid_to_ts IS NULL AS is_current FROM sess"""


def q_fact_bookings(spark, sf):
    contacts = _stored(spark, sf, "history", lambda: _history(spark, sf).checkpoint(eager=True))
    return gold.fact_keys(D.bookings(spark, sf), [
        gold.Lookup(contacts, "contactid", "contactid", "booked_at", "contact_sk"),
        gold.Lookup(_sessions(spark, sf), "sessionid", "sessionid", "booked_at", "session_sk")], {"booking_date_sk": "booked_at"})


O_FACT_BOOKINGS = f"""WITH {D_HISTORY}, {D_SESSION}
SELECT b.*, coalesce(h.contact_sk, -1) AS contact_sk, coalesce(s.session_sk, -1) AS session_sk,
  coalesce(CAST(strftime(booked_at, '%Y%m%d') AS INTEGER), -1) AS booking_date_sk
FROM ({D.duck(D.BOOKINGS_SQL)}) b
LEFT JOIN hist h ON b.contactid = h.contactid AND booked_at >= h.valid_from AND booked_at < coalesce(h.valid_to_ts, TIMESTAMP '9999-12-31 23:59:59')
LEFT JOIN sess s ON b.sessionid = s.sessionid AND booked_at >= s.valid_from AND booked_at < coalesce(s.valid_to_ts, TIMESTAMP '9999-12-31 23:59:59')"""


def q_supplier_activity(spark, sf):
    s = D.table(spark, sf, "supplier")
    li = D.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    o = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    out = gold.activity(s, li, o, "s_suppkey", "l_suppkey", "l_orderkey", "o_orderstatus", "F", ["s_name"])
    return out.withColumnRenamed("total", "total_sessions").withColumnRenamed("done", "completed_sessions")


O_SUPPLIER_ACTIVITY = """SELECT s.s_suppkey, s.s_name, count(DISTINCT l.l_orderkey) AS total_sessions,
  count(DISTINCT CASE WHEN o.o_orderstatus = 'F' THEN l.l_orderkey END) AS completed_sessions
FROM supplier s LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY s.s_suppkey, s.s_name"""

AGG_RULE = {"group_by": ["o_orderstatus"], "measures": [
    {"name": "n_orders", "fn": "count"},
    {"name": "n_customers", "fn": "count_distinct", "expr": "o_custkey"},
    {"name": "revenue_cents", "fn": "sum", "expr": "CAST(round(o_totalprice * 100) AS BIGINT)"},
    {"name": "avg_cents", "fn": "avg", "expr": "CAST(round(o_totalprice * 100) AS BIGINT)"},
    {"name": "first_order", "fn": "min", "expr": "o_orderdate"},
    {"name": "last_order", "fn": "max", "expr": "o_orderdate"},
    {"name": "urgent_orders", "fn": "count", "expr": "o_orderkey", "where": "o_orderpriority = '1-URGENT'"}]}


def q_agg_rule(spark, sf):
    return gold.aggregate_rule(D.table(spark, sf, "orders"), AGG_RULE)


O_AGG_RULE = """SELECT o_orderstatus, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents,
  avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS avg_cents, min(o_orderdate) AS first_order,
  max(o_orderdate) AS last_order, count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS urgent_orders
FROM orders GROUP BY o_orderstatus"""


def q_date_dim(spark, sf):
    b = D.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return gold.calendar(b)


O_DATE_DIM = """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
  d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM d"""


def q_yoy_orders(spark, sf):
    return gold.monthly_yoy(D.table(spark, sf, "orders"), "o_orderdate")


O_YOY_ORDERS = """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1)
SELECT a.month, a.n, b.n AS n_prev_year, a.n - b.n AS yoy_change
FROM m a LEFT JOIN m b ON b.month = CAST(a.month - INTERVAL 12 MONTH AS DATE)"""


def q_fact_course(spark, sf):
    """The course config end to end: validate, clean, dedup, then the
    simple_copy of its nine columns."""
    rule = seed_rule("hs_course_bronze_silver_dq")
    f = jobs.dq_frames(D.bronze_course(spark, sf), rule, "hs_course", RUN, tie_breakers=["hs_courseid"])
    return f.silver.select(*seed_rule("hs_course_silver_gold_fact")["columns"])


O_FACT_COURSE = f"""WITH {D_COURSE_EVAL}
SELECT hs_courseid, trim(hs_name) AS hs_name, hs_startdate, hs_enddate, hs_coursestatus, hs_maxparticipants,
  hs_currentparticipants, createdon, modifiedon FROM v
WHERE hs_name_ok AND hs_startdate_ok AND hs_enddate_ok AND date_logic_check_ok AND hs_coursestatus_ok"""


# ============================================================================ O, N: compare, JSON

def q_diff_snapshots(spark, sf):
    return compare.diff(D.contact_snapshot(spark, sf, 2), D.contact_snapshot(spark, sf, 3), ["contactid"])


O_DIFF_SNAPSHOTS = f"""WITH a AS ({D.duck_snapshot(2)}), b AS ({D.duck_snapshot(3)})
SELECT coalesce(a.contactid, b.contactid) AS contactid,
  CASE WHEN b.contactid IS NULL THEN 'only_in_a' WHEN a.contactid IS NULL THEN 'only_in_b' ELSE 'changed' END AS side
FROM a FULL OUTER JOIN b ON a.contactid = b.contactid
WHERE a.contactid IS NULL OR b.contactid IS NULL OR a.firstname IS DISTINCT FROM b.firstname
  OR a.surname IS DISTINCT FROM b.surname OR a.emailaddress1 IS DISTINCT FROM b.emailaddress1
  OR a.mobilephone IS DISTINCT FROM b.mobilephone OR a.address1_city IS DISTINCT FROM b.address1_city"""


def q_json_extract(spark, sf):
    e = D.table(spark, sf, "events")
    return e.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))


O_JSON_EXTRACT = """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""


# ============================================================================ G: monitoring

def _metrics(spark, sf):
    return D._run(spark, sf, D.METRICS_FROM_EVENTS_SQL, ["events"])


def _runs(spark, sf):
    return D._run(spark, sf, D.RUNS_FROM_EVENTS_SQL, ["events"])


def _qrows(spark, sf):
    return D._run(spark, sf, D.QUARANTINE_FROM_EVENTS_SQL, ["events"])


D_M = f"m AS ({D.duck(D.METRICS_FROM_EVENTS_SQL)})"
D_R = f"r AS ({D.duck(D.RUNS_FROM_EVENTS_SQL)})"
D_Q = f"q AS ({D.duck(D.QUARANTINE_FROM_EVENTS_SQL)})"


def q_metrics_recent(spark, sf):
    v = monitor.metrics_recent(_metrics(spark, sf), TODAY)
    return v.withColumn("avg_error_rate", F.round("avg_error_rate", 6)) \
        .withColumn("avg_duration_sec", F.round("avg_duration_sec", 6))


O_METRICS_RECENT = f"""WITH {D_M}
SELECT CAST(start_time AS DATE) AS run_date, stage, source_table, CAST(sum(records_read) AS BIGINT) AS total_records_read,
  CAST(sum(records_written) AS BIGINT) AS total_records_written, CAST(sum(records_failed) AS BIGINT) AS total_records_failed,
  round(avg(error_rate), 6) AS avg_error_rate, round(avg(duration_sec), 6) AS avg_duration_sec, count(*) AS run_count
FROM m WHERE start_time >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY ALL"""


def q_quarantine_summary(spark, sf):
    return monitor.quarantine_summary(_qrows(spark, sf), TODAY)


O_QUARANTINE_SUMMARY = f"""WITH {D_Q}
SELECT source_table, error_type, status, count(*) AS error_count, min(created_at) AS first_occurrence,
  max(created_at) AS last_occurrence FROM q WHERE created_at >= DATE '{TODAY}' - INTERVAL 30 DAYS GROUP BY ALL"""


def q_success_rate(spark, sf):
    return monitor.success_rate(_runs(spark, sf), TODAY)


O_SUCCESS_RATE = f"""WITH {D_R}
SELECT pipeline_name, CAST(start_time AS DATE) AS run_date, count(*) AS total_runs,
  CAST(count_if(run_status = 'succeeded') AS BIGINT) AS successful_runs,
  CAST(count_if(run_status = 'failed') AS BIGINT) AS failed_runs,
  CAST(round(count_if(run_status = 'succeeded') * 100.0 / count(*), 2) AS DOUBLE) AS success_rate_pct
FROM r WHERE start_time >= DATE '{TODAY}' - INTERVAL 30 DAYS GROUP BY ALL"""


def q_funnel(spark, sf):
    return monitor.funnel(_metrics(spark, sf), TODAY).withColumn("error_rate_pct", F.round("error_rate_pct", 6))


O_FUNNEL = f"""WITH {D_M}
SELECT source_table, stage, CAST(sum(records_read) AS BIGINT) AS input_records,
  CAST(sum(records_written) AS BIGINT) AS output_records, CAST(sum(records_failed) AS BIGINT) AS failed_records,
  round(round(avg(error_rate) * 100, 2), 6) AS error_rate_pct,
  CASE stage WHEN 'bronze_to_silver' THEN 1 WHEN 'silver_to_gold' THEN 2 END AS stage_order
FROM m WHERE CAST(start_time AS DATE) = DATE '{TODAY}' GROUP BY ALL"""


def q_top_errors(spark, sf):
    return monitor.top_errors(_qrows(spark, sf), TODAY)


O_TOP_ERRORS = f"""WITH {D_Q}
SELECT source_table, error_type, count(*) AS error_count, max(created_at) AS last_seen FROM q
WHERE status = 'new' AND created_at >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY ALL
ORDER BY error_count DESC, source_table, error_type LIMIT 10"""


def q_scd_activity(spark, sf):
    return monitor.scd_activity(_metrics(spark, sf), TODAY)


O_SCD_ACTIVITY = f"""WITH {D_M}
SELECT CAST(start_time AS DATE) AS activity_date, source_table, CAST(sum(scd_inserts) AS BIGINT) AS new_records,
  CAST(sum(scd_updates) AS BIGINT) AS changed_records, CAST(sum(scd_no_changes) AS BIGINT) AS unchanged_records,
  CAST(sum(scd_inserts + scd_updates) AS BIGINT) AS total_changes
FROM m WHERE stage = 'silver_to_gold' AND start_time >= DATE '{TODAY}' - INTERVAL 30 DAYS GROUP BY ALL"""


def q_stage_durations(spark, sf):
    v = monitor.stage_durations(_metrics(spark, sf))
    return v.select("source_table", *[F.round(c, 6).alias(c) for c in ("bronze_to_silver", "silver_to_gold")])


O_STAGE_DURATIONS = f"""WITH {D_M}
SELECT source_table, round(avg(CASE WHEN stage = 'bronze_to_silver' THEN duration_sec END), 6) AS bronze_to_silver,
  round(avg(CASE WHEN stage = 'silver_to_gold' THEN duration_sec END), 6) AS silver_to_gold FROM m GROUP BY ALL"""


def q_health_alerts(spark, sf):
    a = monitor.health(_metrics(spark, sf), _runs(spark, sf), _qrows(spark, sf), 0.10, TODAY)
    return a.withColumn("value", F.round("value", 6)).withColumn("threshold", F.round("threshold", 6))


O_HEALTH_ALERTS = f"""WITH {D_M}, {D_R}, {D_Q},
  daily AS (SELECT source_table, CAST(created_at AS DATE) AS d, count(*) AS n FROM q GROUP BY ALL),
  sp AS (SELECT *, avg(n) OVER (PARTITION BY source_table ORDER BY d
           RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS avg7 FROM daily)
SELECT 'high_error_rate' AS alert_type, source_table AS subject, CAST(start_time AS DATE) AS alert_date,
  round(error_rate, 6) AS value, CAST(0.1 AS DOUBLE) AS threshold, run_id FROM m
  WHERE CAST(start_time AS DATE) = DATE '{TODAY}' AND error_rate > 0.1
UNION ALL SELECT 'long_run', source_table, CAST(start_time AS DATE), round(duration_sec, 6), CAST(7200 AS DOUBLE), run_id FROM m
  WHERE CAST(start_time AS DATE) = DATE '{TODAY}' AND duration_sec > 7200
UNION ALL SELECT 'run_failed', pipeline_name, CAST(start_time AS DATE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), run_id FROM r
  WHERE CAST(start_time AS DATE) = DATE '{TODAY}' AND run_status = 'failed'
UNION ALL SELECT 'quarantine_spike', source_table, d, CAST(n AS DOUBLE), round(avg7 * 3.0, 6), NULL FROM sp
  WHERE d = DATE '{TODAY}' AND n > 3.0 * avg7"""


# ============================================================================ more reports

# Retry policy per error type (type, retryable, max retries).
RETRY_POLICY = [("email_invalid", False, None), ("network_timeout", True, 3), ("null_constraint", False, None)]


def q_retry_eligibility(spark, sf):
    policy = spark.createDataFrame(RETRY_POLICY, "error_type string, retryable boolean, max_retries int")
    q = quarantine.retry_eligibility(_spark_quarantine(spark, sf), policy)
    return q.groupBy("error_type", "retryable", "max_retries").agg(F.count(F.lit(1)).alias("records"))


O_RETRY_ELIGIBILITY = f"""WITH {D_QUARANTINE},
  p AS (SELECT * FROM (VALUES ('email_invalid', false, NULL), ('network_timeout', true, 3),
                              ('null_constraint', false, NULL)) t(error_type, retryable, max_retries))
SELECT q.error_type, coalesce(p.retryable, false) AS retryable, CAST(p.max_retries AS INTEGER) AS max_retries,
  count(*) AS records FROM q LEFT JOIN p ON q.error_type = p.error_type GROUP BY ALL"""


def q_quarantine_trend(spark, sf):
    return quarantine.trend(_qrows(spark, sf), TODAY, 7)


O_QUARANTINE_TREND = f"""WITH {D_Q}
SELECT CAST(created_at AS DATE) AS error_date, error_type, count(*) AS error_count FROM q
WHERE created_at >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY ALL"""


def q_quarantine_email_errors(spark, sf):
    q = quarantine.select_errors(_spark_quarantine(spark, sf), "email_invalid", RUN.run_ts, "new")
    return q.select(F.get_json_object("raw_record", "$.contactid").alias("contactid"),
                    F.get_json_object("raw_record", "$.emailaddress1").alias("emailaddress1"), "error_message")


O_QUARANTINE_EMAIL_ERRORS = f"""WITH {D_QUARANTINE}
SELECT contactid, emailaddress1, error_message FROM q WHERE error_type = 'email_invalid' AND status = 'new'"""


def q_error_report(spark, sf):
    r = monitor.error_report(_metrics(spark, sf), TODAY)
    return r.withColumn("avg_error_rate", F.round("avg_error_rate", 6)).withColumn("avg_duration",
                                                                                  F.round("avg_duration", 6))


O_ERROR_REPORT = f"""WITH {D_M}
SELECT CAST(start_time AS DATE) AS run_date, stage, source_table, CAST(sum(records_read) AS BIGINT) AS total_records,
  CAST(sum(records_failed) AS BIGINT) AS total_errors, round(avg(error_rate), 6) AS avg_error_rate,
  round(avg(duration_sec), 6) AS avg_duration FROM m WHERE start_time >= DATE '{TODAY}' GROUP BY ALL"""


def q_stage_averages(spark, sf):
    r = monitor.stage_averages(_metrics(spark, sf), TODAY)
    return r.withColumn("avg_error_rate", F.round("avg_error_rate", 6)).withColumn("avg_duration",
                                                                                  F.round("avg_duration", 6))


O_STAGE_AVERAGES = f"""WITH {D_M}
SELECT stage, source_table, round(avg(error_rate), 6) AS avg_error_rate, round(avg(duration_sec), 6) AS avg_duration,
  CAST(sum(records_written) AS BIGINT) AS total_records FROM m
WHERE start_time >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY ALL"""


def q_new_errors(spark, sf):
    return monitor.new_errors(_qrows(spark, sf))


O_NEW_ERRORS = f"""WITH {D_Q}
SELECT source_table, error_type, count(*) AS error_count, max(created_at) AS last_occurrence FROM q
WHERE status = 'new' GROUP BY ALL"""


def q_error_rate_pct(spark, sf):
    return monitor.error_rate_pct(_metrics(spark, sf)).withColumn("avg_error_rate_pct",
                                                                  F.round("avg_error_rate_pct", 6))


O_ERROR_RATE_PCT = f"""WITH {D_M}
SELECT source_table, round(avg(error_rate) * 100, 6) AS avg_error_rate_pct FROM m GROUP BY ALL"""


def q_table_overview(spark, sf):
    return monitor.table_overview(_metrics(spark, sf), TODAY)


O_TABLE_OVERVIEW = f"""WITH {D_M}
SELECT CAST(start_time AS DATE) AS run_date, source_table AS table_name, stage,
  CAST(sum(records_read) AS BIGINT) AS total_in, CAST(sum(records_written) AS BIGINT) AS total_out,
  CAST(sum(records_failed) AS BIGINT) AS total_failed, round(avg(duration_sec), 2) AS avg_duration_sec
FROM m WHERE start_time >= DATE '{TODAY}' - INTERVAL 7 DAYS GROUP BY ALL"""


def q_run_summary(spark, sf):
    s = monitor.summary(_metrics(spark, sf))
    return s.withColumn("error_rate", F.round("error_rate", 9)).withColumn("records_per_sec",
                                                                          F.round("records_per_sec", 6))


O_RUN_SUMMARY = f"""WITH {D_M}
SELECT run_id, pipeline_name, records_read, records_written, records_failed, duration_sec,
  round(CASE WHEN records_read > 0 THEN records_failed / records_read ELSE 0.0 END, 9) AS error_rate,
  round(CASE WHEN duration_sec > 0 THEN records_read / duration_sec END, 6) AS records_per_sec FROM m"""


def q_course_participation(spark, sf):
    return gold.participation(D.bronze_course(spark, sf), ["hs_coursestatus"], "hs_currentparticipants",
                              "hs_maxparticipants")


O_COURSE_PARTICIPATION = f"""WITH c AS ({D.duck(D.BRONZE_COURSE_SQL)})
SELECT hs_coursestatus, count(*) AS courses, CAST(sum(hs_currentparticipants) AS BIGINT) AS participants,
  CAST(sum(hs_maxparticipants) AS BIGINT) AS capacity,
  CASE WHEN sum(hs_maxparticipants) > 0
       THEN CAST(round(sum(hs_currentparticipants) * 100.0 / sum(hs_maxparticipants), 2) AS DOUBLE) END AS fill_rate_pct
FROM c GROUP BY ALL"""


def q_enriched_customer(spark, sf):
    n = D.table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = D.table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    c = D.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return gold.enrich(gold.enrich(c, n, "c_nationkey"), r, "n_regionkey") \
        .select("c_custkey", "c_name", "n_name", "r_name")


O_ENRICHED_CUSTOMER = """SELECT c.c_custkey, c.c_name, n.n_name, r.r_name FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""


def q_scd2_totals(spark, sf):
    return scd2.totals(_stored_dim(spark, sf, 3), CONTACT_SPEC)


O_SCD2_TOTALS = f"""WITH {_d_dim(3)}
SELECT count(*) AS total_rows, CAST(count_if(valid_to_ts IS NULL) AS BIGINT) AS current_rows,
  CAST(count_if(valid_to_ts IS NOT NULL) AS BIGINT) AS historical_rows FROM dim"""


def q_scd2_latest(spark, sf):
    top = scd2.latest(_stored_dim(spark, sf, 3), CONTACT_SPEC, 5)
    return top.select("contactid", "emailaddress1", _fmt("valid_from").alias("valid_from_s"))


O_SCD2_LATEST = f"""WITH {_d_dim(3)}
SELECT contactid, emailaddress1, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from_s FROM dim
WHERE valid_to_ts IS NULL ORDER BY valid_from DESC, contactid LIMIT 5"""


def q_scd2_latest_closed(spark, sf):
    top = scd2.latest(_stored_dim(spark, sf, 3), CONTACT_SPEC, 5, closed=True)
    return top.select("contactid", "emailaddress1", _fmt("valid_to").alias("valid_to_s"))


O_SCD2_LATEST_CLOSED = f"""WITH {_d_dim(3)}
SELECT contactid, emailaddress1, strftime(valid_to_ts, '%Y-%m-%d %H:%M:%S') AS valid_to_s FROM dim
WHERE valid_to_ts IS NOT NULL ORDER BY valid_to_ts DESC, contactid LIMIT 5"""


def q_scd2_quarter_counts(spark, sf):
    return scd2.change_counts(_stored_dim(spark, sf, 3), CONTACT_SPEC, "2024-01-01 00:00:00",
                              "2025-01-01 00:00:00", "quarter")


O_SCD2_QUARTER_COUNTS = f"""WITH {_d_dim(3)}
SELECT CAST(year(valid_from) AS VARCHAR) || '-Q' || CAST(quarter(valid_from) AS VARCHAR) AS period,
  count(*) AS new_versions, count(DISTINCT contactid) AS changed_keys FROM dim
WHERE valid_from >= TIMESTAMP '2024-01-01 00:00:00' AND valid_from < TIMESTAMP '2025-01-01 00:00:00' GROUP BY 1"""


# ============================================================================ registry

QUERIES = {
    "dq_verdicts": (q_dq_verdicts, O_DQ_VERDICTS),
    "dq_breakdown": (q_dq_breakdown, O_DQ_BREAKDOWN),
    "dq_score": (q_dq_score, O_DQ_SCORE),
    "dq_rule_failures": (q_dq_rule_failures, O_DQ_RULE_FAILURES),
    "dq_course_rules": (q_dq_course_rules, O_DQ_COURSE_RULES),
    "dq_customer_rules": (q_dq_customer_rules, O_DQ_CUSTOMER_RULES),
    "dq_account_rules": (q_dq_account_rules, O_DQ_ACCOUNT_RULES),
    "dq_whitelist": (q_dq_whitelist, O_DQ_WHITELIST),
    "dq_whitelist_large": (q_dq_whitelist_large, O_DQ_WHITELIST_LARGE),
    "dq_whitelist_report": (q_dq_whitelist_report, O_DQ_WHITELIST_REPORT),
    "dq_actions": (q_dq_actions, O_DQ_ACTIONS),
    "clean_ops": (q_clean_ops, O_CLEAN_OPS),
    "clean_ops_extra": (q_clean_ops_extra, O_CLEAN_OPS_EXTRA),
    "phone_normalize": (q_phone_normalize, O_PHONE_NORMALIZE),
    "silver_contact": (q_silver_contact, O_SILVER_CONTACT),
    "dedup_latest": (q_dedup_latest, O_DEDUP_LATEST),
    "dedup_first": (q_dedup_first, O_DEDUP_FIRST),
    "dedup_agg": (q_dedup_agg, O_DEDUP_AGG),
    "quarantine_records": (q_quarantine_records, O_QUARANTINE_RECORDS),
    "quarantine_by_type": (q_quarantine_by_type, O_QUARANTINE_BY_TYPE),
    "quarantine_by_message": (q_quarantine_by_message, O_QUARANTINE_BY_MESSAGE),
    "quarantine_repair": (q_quarantine_repair, O_QUARANTINE_REPAIR),
    "quarantine_repair_all": (q_quarantine_repair_all, O_QUARANTINE_REPAIR_ALL),
    "row_hash": (q_row_hash, O_ROW_HASH),
    "scd2_initial": (q_scd2_initial, _d_dim_out(1)),
    "scd2_merge": (q_scd2_merge, _d_dim_out(2)),
    "scd2_merge_3": (q_scd2_merge_3, _d_dim_out(3)),
    "scd2_classify": (q_scd2_classify, O_SCD2_CLASSIFY),
    "scd2_counts": (q_scd2_counts, O_SCD2_COUNTS),
    "scd2_as_of": (q_scd2_as_of, O_SCD2_AS_OF),
    "scd2_transitions": (q_scd2_transitions, O_SCD2_TRANSITIONS),
    "scd2_period_counts": (q_scd2_period_counts, O_SCD2_PERIOD_COUNTS),
    "scd2_checks": (q_scd2_checks, O_SCD2_CHECKS),
    "scd2_from_changes": (q_scd2_from_changes, O_SCD2_FROM_CHANGES),
    "scd2_overlap_hot": (q_scd2_overlap_hot, O_SCD2_OVERLAP_HOT),
    "scd2_transitions_hot": (q_scd2_transitions_hot, O_SCD2_TRANSITIONS_HOT),
    "surrogate_keys": (q_surrogate_keys, O_SURROGATE_KEYS),
    "fact_lookup": (q_fact_lookup, O_FACT_LOOKUP),
    "date_order": (q_date_order, O_DATE_ORDER),
    "sql_validators": (q_sql_validators, O_SQL_VALIDATORS),
    "dedup_by_attribute": (q_dedup_by_attribute, O_DEDUP_BY_ATTRIBUTE),
    "quarantine_review": (q_quarantine_review, O_QUARANTINE_REVIEW),
    "scd2_current": (q_scd2_current, O_SCD2_CURRENT),
    "scd2_account": (q_scd2_account, O_SCD2_ACCOUNT),
    "dq_run_metrics": (q_dq_run_metrics, O_DQ_RUN_METRICS),
    "layout_zorder": (q_layout_zorder, O_LAYOUT_ZORDER),
    "copy_append_retry": (q_copy_append_retry, O_COPY_APPEND_RETRY),
    "scd2_close_all_reopen": (q_scd2_close_all_reopen, O_SCD2_CLOSE_ALL_REOPEN),
    "purge_roundtrip": (q_purge_roundtrip, O_PURGE_ROUNDTRIP),
    "config_run_whitelist": (q_config_run_whitelist, O_CONFIG_RUN_WHITELIST),
    "fact_bookings": (q_fact_bookings, O_FACT_BOOKINGS),
    "scd2_session": (q_scd2_session, O_SCD2_SESSION),
    "supplier_activity": (q_supplier_activity, O_SUPPLIER_ACTIVITY),
    "agg_rule": (q_agg_rule, O_AGG_RULE),
    "date_dim": (q_date_dim, O_DATE_DIM),
    "yoy_orders": (q_yoy_orders, O_YOY_ORDERS),
    "fact_course": (q_fact_course, O_FACT_COURSE),
    "diff_snapshots": (q_diff_snapshots, O_DIFF_SNAPSHOTS),
    "json_extract": (q_json_extract, O_JSON_EXTRACT),
    "metrics_recent": (q_metrics_recent, O_METRICS_RECENT),
    "quarantine_summary": (q_quarantine_summary, O_QUARANTINE_SUMMARY),
    "success_rate": (q_success_rate, O_SUCCESS_RATE),
    "funnel": (q_funnel, O_FUNNEL),
    "top_errors": (q_top_errors, O_TOP_ERRORS),
    "scd_activity": (q_scd_activity, O_SCD_ACTIVITY),
    "stage_durations": (q_stage_durations, O_STAGE_DURATIONS),
    "health_alerts": (q_health_alerts, O_HEALTH_ALERTS),
    "retry_eligibility": (q_retry_eligibility, O_RETRY_ELIGIBILITY),
    "quarantine_trend": (q_quarantine_trend, O_QUARANTINE_TREND),
    "quarantine_email_errors": (q_quarantine_email_errors, O_QUARANTINE_EMAIL_ERRORS),
    "error_report": (q_error_report, O_ERROR_REPORT),
    "stage_averages": (q_stage_averages, O_STAGE_AVERAGES),
    "new_errors": (q_new_errors, O_NEW_ERRORS),
    "error_rate_pct": (q_error_rate_pct, O_ERROR_RATE_PCT),
    "table_overview": (q_table_overview, O_TABLE_OVERVIEW),
    "run_summary": (q_run_summary, O_RUN_SUMMARY),
    "course_participation": (q_course_participation, O_COURSE_PARTICIPATION),
    "enriched_customer": (q_enriched_customer, O_ENRICHED_CUSTOMER),
    "scd2_totals": (q_scd2_totals, O_SCD2_TOTALS),
    "scd2_latest": (q_scd2_latest, O_SCD2_LATEST),
    "scd2_latest_closed": (q_scd2_latest_closed, O_SCD2_LATEST_CLOSED),
    "scd2_quarter_counts": (q_scd2_quarter_counts, O_SCD2_QUARTER_COUNTS),
}
