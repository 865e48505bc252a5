"""Bronze-style inputs derived from the driver's test tables.

The test tables hold no contacts, accounts or courses, so these are derived
from ``orders``/``customer``/``supplier``/``lineitem`` by SQL that reads the
same in Spark SQL and DuckDB: the text is shared, Spark binds DataFrames to
the ``{name}`` placeholders, the oracle binds view names.  Faults are planted
by key arithmetic (no rows are dropped or sampled), so each input grows with
its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One bronze contact row per order: the customer is the contact, each order a
# later or earlier version of that record (dedup keeps the newest valid one).
# Residues of o_orderkey % 97 plant the FIXTURES edge values.
BRONZE_CONTACT_SQL = """
SELECT
  CAST(o.o_custkey AS STRING) AS contactid,
  CASE o.o_orderkey % 97 WHEN 12 THEN NULL WHEN 13 THEN '   ' WHEN 14 THEN '  ' || b.fn || '  '
       WHEN 15 THEN chr(9) WHEN 16 THEN chr(160) ELSE b.fn END AS firstname,
  CASE o.o_orderkey % 97 WHEN 17 THEN '' WHEN 18 THEN NULL ELSE b.sn END AS surname,
  CASE o.o_orderkey % 97 WHEN 0 THEN 'max@@falsch' WHEN 1 THEN ' ' || b.em WHEN 2 THEN NULL
       WHEN 3 THEN upper(b.em) WHEN 4 THEN b.em || chr(10) WHEN 5 THEN 'a@b.d' ELSE b.em END AS emailaddress1,
  CASE o.o_orderkey % 97 WHEN 6 THEN '017012345' WHEN 7 THEN '0170 123-456(78)' WHEN 8 THEN NULL
       WHEN 9 THEN '' WHEN 10 THEN '+49' || substr(b.ph, 2) WHEN 11 THEN '004917012345678'
       WHEN 19 THEN '0170 123 456' ELSE b.ph END AS mobilephone,
  b.city AS address1_city,
  lpad(CAST(b.c_custkey % 100000 AS STRING), 5, '0') AS address1_postalcode,
  DATE '1960-01-01' + CAST(b.c_custkey % 15000 AS INT) AS birthdate,
  CAST(b.c_custkey % 3 AS INT) AS gendercode,
  o.o_orderdate AS createdon,
  o.o_orderdate AS modifiedon,
  CAST(o.o_orderkey % 2 AS INT) AS statecode,
  CAST(o.o_orderkey % 2 + 1 AS INT) AS statuscode,
  o.o_orderkey AS versionnumber
FROM {orders} o
JOIN (
  SELECT c_custkey,
         'Vorname' || CAST(c_custkey % 97 AS STRING) AS fn,
         lower(c_mktsegment) AS sn,
         'user' || CAST(c_custkey AS STRING) || '@example.de' AS em,
         '0170' || lpad(CAST(c_custkey AS STRING), 7, '0') AS ph,
         'City' || CAST(c_nationkey AS STRING) AS city
  FROM {customer}
) b ON o.o_custkey = b.c_custkey
"""

# Snapshot n (1, 2, 3) of the silver contact table: the customers with orders
# in period n (back to back; the first and the last are open, so every order is read), attributes from aggregates over
# those orders.  Customers without orders in a period are missing from that
# snapshot and may come back; first-time customers are new; the e-mail domain
# follows the period's highest order status, the surname's case the number of
# urgent orders, the phone is withheld for frequent buyers.  The city (from the
# order count) is untracked and must not create a version.
SNAPSHOT_PERIODS = [("1900-01-01 00:00:00", "1997-01-01 00:00:00"),
                    ("1997-01-01 00:00:00", "1999-01-01 00:00:00"),
                    ("1999-01-01 00:00:00", "2200-01-01 00:00:00")]
CONTACT_SNAPSHOT_SQL = """
SELECT CAST(c.c_custkey AS STRING) AS contactid,
  'Vorname' || CAST(c.c_custkey % 97 AS STRING) AS firstname,
  CASE WHEN a.n_urgent >= 2 THEN upper(c.c_mktsegment) ELSE lower(c.c_mktsegment) END AS surname,
  'user' || CAST(c.c_custkey AS STRING) || CASE WHEN a.top_status = 'F' THEN '@example.de' ELSE '@neu.de' END
    AS emailaddress1,
  CASE WHEN a.n_orders >= 5 THEN NULL ELSE '0170' || lpad(CAST(c.c_custkey AS STRING), 7, '0') END AS mobilephone,
  'City' || CAST(a.n_orders AS STRING) AS address1_city
FROM {customer} c
JOIN (
  SELECT o_custkey, count(*) AS n_orders, count_if(o_orderpriority = '1-URGENT') AS n_urgent,
         max(o_orderstatus) AS top_status
  FROM {orders}
  WHERE o_orderdate >= TIMESTAMP '__FROM__' AND o_orderdate < TIMESTAMP '__TO__'
  GROUP BY o_custkey
) a ON c.c_custkey = a.o_custkey
"""


def _snapshot_sql(n: int) -> str:
    lo, hi = SNAPSHOT_PERIODS[int(n) - 1]
    return CONTACT_SNAPSHOT_SQL.replace("__FROM__", lo).replace("__TO__", hi)


# A course per order: dates from the order and its latest shipment, status
# from the order status ('P' maps outside the allowed list), a participant
# count from the number of lines.  Orders without lines have no end date.
BRONZE_COURSE_SQL = """
SELECT
  CAST(o.o_orderkey AS STRING) AS hs_courseid,
  CASE WHEN o.o_orderkey % 53 = 0 THEN '  ' ELSE '  Kurs ' || o.o_orderpriority || ' ' END AS hs_name,
  o.o_orderdate AS hs_startdate,
  l.last_ship AS hs_enddate,
  CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Active' ELSE 'Pending' END AS hs_coursestatus,
  CAST(30 AS INT) AS hs_maxparticipants,
  CAST(coalesce(l.n_lines, 0) AS INT) AS hs_currentparticipants,
  o.o_orderdate AS createdon,
  o.o_orderdate AS modifiedon
FROM {orders} o
LEFT JOIN (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_lines
  FROM {lineitem} GROUP BY l_orderkey
) l ON o.o_orderkey = l.l_orderkey
"""

# An account per supplier; the partner level follows the balance, blank names
# and placeholder e-mails are planted by key.
BRONZE_ACCOUNT_SQL = """
SELECT
  CAST(s_suppkey AS STRING) AS accountid,
  CASE WHEN s_suppkey % 17 = 0 THEN ' ' ELSE s_name END AS name,
  CASE WHEN s_acctbal < 0 THEN 'None'
       WHEN s_acctbal < 2500 THEN 'Bronze' WHEN s_acctbal < 5000 THEN 'Silver'
       WHEN s_acctbal < 7500 THEN 'Gold' ELSE 'Platinum' END AS hs_partner_level,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN 'kontakt@firma'
       ELSE 'info' || CAST(s_suppkey AS STRING) || '@firma.de' END AS emailaddress1,
  '030' || lpad(CAST(s_suppkey AS STRING), 8, '0') AS telephone1,
  'City' || CAST(s_nationkey AS STRING) AS address1_city,
  lpad(CAST(s_suppkey % 100000 AS STRING), 5, '0') AS address1_postalcode,
  'https://firma' || CAST(s_suppkey AS STRING) || '.de' AS websiteurl,
  TIMESTAMP '2020-01-01 00:00:00' AS createdon,
  TIMESTAMP '2024-01-01 00:00:00' AS modifiedon
FROM {supplier}
"""

# The states of a session over time: a part is the session, its shipments are the changes.
SESSION_CHANGES_SQL = """
SELECT CAST(l_partkey AS STRING) AS sessionid, l_shipdate AS changed_at,
  max(CASE l_returnflag WHEN 'A' THEN 'cancelled' WHEN 'R' THEN 'planned' ELSE 'completed' END) AS sessionstateid
FROM {lineitem} GROUP BY l_partkey, l_shipdate
"""

# A booking per order line.  One contact holds a third of them; contacts and sessions are missing by key.
BOOKINGS_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS booking_id,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN '1' ELSE CAST(o_custkey AS STRING) END AS contactid,
  CASE WHEN l_orderkey % 13 = 5 THEN NULL ELSE CAST(l_partkey AS STRING) END AS sessionid,
  CASE WHEN l_orderkey % 17 = 3 THEN NULL ELSE l_shipdate END AS booked_at,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS total_cents,
  l_linestatus AS booking_status
FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey
"""

# Monitoring rows derived from events: each event is one job run of a
# (stage, table) pair; its value drives volumes and duration, error events
# carry failures.  Used to exercise the monitoring views and health rules.
METRICS_FROM_EVENTS_SQL = """
SELECT
  CAST(event_id AS STRING) AS metric_id,
  'run_' || CAST(event_id - event_id % 10 AS STRING) AS run_id,
  stage || '_table_' || CAST(user_id % 5 AS STRING) AS pipeline_name,
  stage,
  'table_' || CAST(user_id % 5 AS STRING) AS source_table,
  'target_' || CAST(user_id % 5 AS STRING) AS target_table,
  rr AS records_read,
  rr - CAST(event_id % 7 AS BIGINT) - ff AS records_written,
  ff AS records_failed,
  value * 37 AS duration_sec,
  CASE WHEN rr > 0 THEN ff / rr ELSE CAST(0 AS DOUBLE) END AS error_rate,
  CASE WHEN rr > 0 THEN 1 - ff / rr ELSE CAST(1 AS DOUBLE) END AS dq_score_avg,
  CASE WHEN stage = 'silver_to_gold' THEN CAST(event_id % 13 AS BIGINT) END AS scd_inserts,
  CASE WHEN stage = 'silver_to_gold' THEN CAST(event_id % 5 AS BIGINT) END AS scd_updates,
  CASE WHEN stage = 'silver_to_gold' THEN rr - CAST(event_id % 13 AS BIGINT) - CAST(event_id % 5 AS BIGINT) END
    AS scd_no_changes,
  ts AS start_time,
  ts AS end_time,
  ts AS created_at
FROM (
  SELECT event_id, user_id, ts, value,
         CASE WHEN user_id % 2 = 0 THEN 'bronze_to_silver' ELSE 'silver_to_gold' END AS stage,
         CAST(round(value * 100) AS BIGINT) AS rr,
         CASE WHEN event_type = 'error' THEN CAST(event_id % 50 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS ff
  FROM {events}
) e
"""

RUNS_FROM_EVENTS_SQL = """
SELECT
  'run_' || CAST(event_id AS STRING) AS run_id,
  'pipeline_' || CAST(user_id % 4 AS STRING) AS pipeline_name,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' WHEN 'view' THEN 'cancelled'
       ELSE 'succeeded' END AS run_status,
  ts AS start_time
FROM {events}
"""

QUARANTINE_FROM_EVENTS_SQL = """
SELECT
  CAST(event_id AS STRING) AS quarantine_id,
  'table_' || CAST(user_id % 5 AS STRING) AS source_table,
  'err_' || event_type AS error_type,
  CASE event_id % 4 WHEN 1 THEN 'reviewed' WHEN 2 THEN 'fixed' ELSE 'new' END AS status,
  ts AS created_at
FROM {events}
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str, names: list[str]) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def bronze_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, BRONZE_CONTACT_SQL, ["orders", "customer"])


def contact_snapshot(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return _run(spark, sf_dir, _snapshot_sql(n), ["customer", "orders"])


def bronze_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, BRONZE_COURSE_SQL, ["orders", "lineitem"])


def bronze_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, BRONZE_ACCOUNT_SQL, ["supplier"])


def session_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, SESSION_CHANGES_SQL, ["lineitem"])


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, BOOKINGS_SQL, ["lineitem", "orders"])


def duck(sql: str, **subst: str) -> str:
    """The same SQL for DuckDB, placeholders bound to the registered views."""
    names = {n: n for n in TABLES}
    names.update(subst)
    return sql.format(**names)


def duck_snapshot(n: int) -> str:
    return duck(_snapshot_sql(n))
