"""Declared schemas: the seven service tables and the rule-config JSON shapes.

Every writer goes through ``conform`` so that rows always land with the
declared column order and types (inferring a schema from Python dicts fails on
all-null columns, and append-by-name narrows types silently).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampType())


def _schema(*fields: tuple) -> T.StructType:
    """Fields as (name, type, required)."""
    return T.StructType([T.StructField(n, t, not req) for n, t, req in fields])


PIPELINE_METRICS = _schema(
    ("metric_id", S, True), ("run_id", S, True), ("pipeline_name", S, False),
    ("stage", S, True), ("source_table", S, True), ("target_table", S, True),
    ("records_read", L, False), ("records_written", L, False), ("records_failed", L, False),
    ("duration_sec", D, False), ("error_rate", D, False), ("dq_score_avg", D, False),
    ("scd_inserts", L, False), ("scd_updates", L, False), ("scd_no_changes", L, False),
    ("start_time", TS, False), ("end_time", TS, False), ("created_at", TS, True),
)

QUARANTINE_RECORDS = _schema(
    ("quarantine_id", S, True), ("source_table", S, True), ("pipeline_run_id", S, True),
    ("error_type", S, True), ("error_message", S, False), ("error_field", S, False),
    ("raw_record", S, True), ("status", S, False), ("resolution_notes", S, False),
    ("resolved_by", S, False), ("resolved_at", TS, False), ("created_at", TS, True),
)

DQ_RULES = _schema(
    ("rule_id", S, True), ("rule_name", S, True), ("table_name", S, True),
    ("field_name", S, False), ("rule_type", S, True), ("rule_definition", S, True),
    ("severity", S, False), ("error_action", S, False), ("active", B, False),
    ("created_at", TS, True), ("updated_at", TS, False), ("created_by", S, False),
)

PIPELINE_RUN_HISTORY = _schema(
    ("run_id", S, True), ("pipeline_name", S, True), ("run_status", S, True),
    ("run_type", S, False), ("start_time", TS, True), ("end_time", TS, False),
    ("duration_sec", D, False), ("total_records_processed", L, False),
    ("total_records_failed", L, False), ("tables_processed", I, False),
    ("error_message", S, False), ("error_stack_trace", S, False), ("triggered_by", S, False),
    ("environment", S, False), ("workspace", S, False), ("created_at", TS, True),
)

TABLE_LINEAGE = _schema(
    ("lineage_id", S, True), ("source_table", S, True), ("target_table", S, True),
    ("transformation_type", S, False), ("run_id", S, False),
    ("records_transferred", L, False), ("created_at", TS, True),
)

TRANSFORMATION_CONFIG = _schema(
    ("config_id", S, True), ("source_table", S, True), ("target_table", S, True),
    ("target_layer", S, True), ("rule_type", S, True), ("rule_definition", S, True),
    ("priority", I, False), ("active", B, False), ("batch_size", I, False),
    ("depends_on", S, False), ("created_at", TS, True), ("updated_at", TS, False),
    ("created_by", S, False), ("description", S, False),
)

DQ_WHITELIST = _schema(
    ("whitelist_id", S, True), ("table_name", S, True), ("field_name", S, False),
    ("rule_type", S, True), ("pattern", S, True), ("reason", S, False),
    ("active", B, False), ("expires_at", TS, False), ("created_at", TS, True),
    ("created_by", S, False),
)

SERVICE_TABLES: dict[str, T.StructType] = {
    "pipeline_metrics": PIPELINE_METRICS,
    "quarantine_records": QUARANTINE_RECORDS,
    "dq_rules": DQ_RULES,
    "pipeline_run_history": PIPELINE_RUN_HISTORY,
    "table_lineage": TABLE_LINEAGE,
    "transformation_config": TRANSFORMATION_CONFIG,
    "dq_whitelist": DQ_WHITELIST,
}

# The value domains of the service tables.
STAGES = ("bronze_to_silver", "silver_to_gold")
RUN_STATUSES = ("running", "succeeded", "failed", "cancelled")
RUN_TYPES = ("scheduled", "manual", "retry")
QUARANTINE_STATUSES = ("new", "reviewed", "fixed", "ignored")
SEVERITIES = ("error", "warning", "info")
ERROR_ACTIONS = ("quarantine", "reject", "flag")
DQ_RULE_TYPES = ("regex", "not_null", "range", "enum", "custom")
LINEAGE_TYPES = ("dq_check", "scd2", "aggregate", "join")
CONFIG_RULE_TYPES = ("dq_check", "scd2", "aggregate", "simple_copy")

# Rule JSON shapes, parsed with from_json on the driver's config rows or on a
# whole config table.
_VALIDATION = T.StructType([
    T.StructField("field", S), T.StructField("type", S), T.StructField("pattern", S),
    T.StructField("allowed_values", T.ArrayType(S)), T.StructField("values", T.ArrayType(S)),
    T.StructField("expression", S), T.StructField("name", S), T.StructField("required", B),
    T.StructField("min", D), T.StructField("max", D),
    T.StructField("severity", S), T.StructField("error_action", S), T.StructField("error_message", S),
])
DQ_CHECK_RULE = T.StructType([
    T.StructField("validations", T.ArrayType(_VALIDATION)),
    T.StructField("validation", _VALIDATION),
    T.StructField("transformations", T.ArrayType(T.StructType([
        T.StructField("field", S), T.StructField("operations", T.ArrayType(S))]))),
    T.StructField("deduplication", T.StructType([
        T.StructField("enabled", B), T.StructField("key_fields", T.ArrayType(S)),
        T.StructField("order_by", S), T.StructField("order", S),
        T.StructField("tie_breakers", T.ArrayType(S))])),
])
SCD2_RULE = T.StructType([
    T.StructField("business_key", S), T.StructField("tracked_columns", T.ArrayType(S)),
    T.StructField("additional_columns", T.ArrayType(S)), T.StructField("surrogate_key", S),
    T.StructField("metadata_columns", T.StructType([
        T.StructField(n, S) for n in ("surrogate_key", "valid_from", "valid_to", "is_current", "hash_value")])),
])
SIMPLE_COPY_RULE = T.StructType([
    T.StructField("business_key", S), T.StructField("columns", T.ArrayType(S)),
    T.StructField("write_mode", S),
])
AGGREGATE_RULE = T.StructType([
    T.StructField("group_by", T.ArrayType(S)),
    T.StructField("measures", T.ArrayType(T.StructType([
        T.StructField("name", S), T.StructField("fn", S), T.StructField("expr", S),
        T.StructField("where", S)]))),
])
RULE_SCHEMAS = {"dq_check": DQ_CHECK_RULE, "scd2": SCD2_RULE,
                "simple_copy": SIMPLE_COPY_RULE, "aggregate": AGGREGATE_RULE}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to the declared types;
    columns missing from ``df`` become typed nulls."""
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def missing_required(df: DataFrame, schema: T.StructType) -> list[str]:
    """Names of required (NOT NULL) columns that are absent from ``df``."""
    return [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
