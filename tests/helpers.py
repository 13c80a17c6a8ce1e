"""Small builders for raw and clean tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewarden.schemas import RAW_COLUMNS, text_schema


def raw(spark, table, *rows):
    """Rows as dicts; absent columns are null."""
    data = [tuple(row.get(c) for c in RAW_COLUMNS[table]) for row in rows]
    return spark.createDataFrame(data, text_schema(table))


def one_column(spark, values):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.StringType())])
    return spark.createDataFrame(list(enumerate(values)), schema)


def applied(spark, rule, values):
    """Strip, apply a column rule and return the results in input order."""
    from tracewarden.functions.text import stripped

    df = stripped(one_column(spark, values), ["v"]).select("i", rule(F.col("v")).alias("o"))
    return [row["o"] for row in sorted(df.collect(), key=lambda r: r["i"])]


def at(text):
    return datetime.fromisoformat(text) if text else None


def typed(spark, types, rows):
    schema = T.StructType([T.StructField(n, k) for n, k in types.items()])
    return spark.createDataFrame([tuple(row.get(n) for n in types) for row in rows], schema)


S, B, D, TS = T.StringType(), T.BooleanType(), T.DoubleType(), T.TimestampNTZType()
IDENTITY = {n: S for n in (
    "full_name", "role", "user_id", "department", "location", "status")} | {
    "hire_date": TS, "termination_date": TS} | {n: S for n in (
        "username", "hostname", "device_id", "manager_username")} | {
    "device_id_conflict": B, "device_user_count": T.LongType()}
IAM = {"event_id": S, "timestamp": TS, "user_id": S, "username": S, "department": S, "event_type": S,
       "auth_method": S, "source_ip": S, "ip_status": S, "hostname": S, "device_id": S,
       "session_id": S, "mfa_passed": B, "failure_reason": S, "risk_score": D, "risk_level": S,
       "geo_location": S}
ENDPOINT = {"alert_id": S, "detected_timestamp": TS, "hostname": S, "hostname_join_key": S,
            "user_id": S, "alert_name": S, "description": S, "process_name": S, "file_path": S,
            "severity": S, "status": S, "unresolved_alert_flag": B, "impossible_resolution_flag": B}
FIREWALL = {"log_id": S, "timestamp": TS, "hostname": S, "hostname_join_key": S, "session_id": S,
            "src_ip": S, "dst_ip": S, "src_port": T.IntegerType(), "dst_port": T.IntegerType(),
            "protocol": S, "action": S, "bytes_sent": T.LongType(), "bytes_received": T.LongType(),
            "threat_flag": B, "rule_name": S, "geo_country": S}


def identity(spark, *rows):
    return typed(spark, IDENTITY, rows)


def iam(spark, *rows):
    return typed(spark, IAM, rows)


def endpoint(spark, *rows):
    return typed(spark, ENDPOINT, rows)


def firewall(spark, *rows):
    return typed(spark, FIREWALL, rows)
