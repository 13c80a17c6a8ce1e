"""The four cleaners: exact-duplicate removal, field rules and quality flags.

Each ``*_stage`` keeps the number of raw copies per row, so the summaries need one pass;
``clean_*`` are the published tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions import identifiers as ids
from ..functions import network as net
from ..functions import timestamps as times
from ..functions.text import as_flag, stripped
from ..schemas import CLEAN_COLUMNS, ENDPOINT_ISSUE_FLAGS, RAW_COLUMNS
from ..sources.raw import expected_only
from .dedupe import COPIES, UNPARSED, distinct_part, distinct_with_copies, flag_duplicate_keys


def device_users(df: DataFrame) -> DataFrame:
    """Distinct users per non-null device."""
    return (
        df.where(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(F.countDistinct("user_id").alias("device_user_count"))
    )


# Texts that stand for no date in the identity master
NO_DATE = ("not available", "na", "n/a", "none", "null", "")


def unparsed(*fields: tuple[Column, Column, tuple[str, ...]]) -> Column:
    """How many (text, time, tokens) hold a text that is no token of absence and yet gave no time."""
    return sum(as_flag(~F.lower(text).isin(*tokens) & time.isNull()).cast("bigint") for text, time, tokens in fields).alias(UNPARSED)


def identity_stage(raw: DataFrame) -> DataFrame:
    rows = stripped(distinct_with_copies(expected_only(raw, "identity")), RAW_COLUMNS["identity"][2:])
    c = F.col
    cleaned = rows.select(
        "full_name", "role",
        ids.identity_user_id(c("user_id")).alias("user_id"),
        cat.identity_category(c("department"), cat.IDENTITY_DEPARTMENTS).alias("department"),
        cat.identity_category(c("location"), cat.IDENTITY_LOCATIONS).alias("location"),
        cat.identity_category(c("status"), cat.IDENTITY_STATUSES).alias("status"),
        times.identity_timestamp(c("hire_date")).alias("hire_date"),
        times.identity_timestamp(c("termination_date")).alias("termination_date"),
        ids.identity_username(c("username")).alias("username"),
        ids.identity_hostname(c("hostname")).alias("hostname"),
        ids.identity_device_id(c("device_id")).alias("device_id"),
        ids.identity_username(c("manager_username")).alias("manager_username"),
        unparsed(*[(c(n), times.identity_timestamp(c(n)), NO_DATE) for n in ("hire_date", "termination_date")]),
        COPIES,
    )
    counted = cleaned.join(device_users(cleaned), "device_id", "left")
    count = F.coalesce(c("device_user_count"), F.lit(0))
    return counted.withColumns(
        {"device_user_count": count, "device_id_conflict": c("device_id").isNotNull() & (count > 1)}
    ).select(*CLEAN_COLUMNS["identity"], UNPARSED, COPIES)


def iam_stage(raw: DataFrame) -> DataFrame:
    return _iam_fields(distinct_with_copies(expected_only(raw, "iam")))


def _iam_fields(distinct: DataFrame) -> DataFrame:
    rows = stripped(distinct, RAW_COLUMNS["iam"])
    c = F.col
    return rows.select(
        "event_id",
        times.mixed_timestamp(c("timestamp")).alias("timestamp"),
        ids.iam_user_id(c("user_id")).alias("user_id"),
        F.lower(ids.iam_text(c("username"))).alias("username"),
        cat.iam_category(c("department"), cat.IAM_DEPARTMENTS).alias("department"),
        cat.iam_category(c("event_type"), cat.IAM_EVENT_TYPES).alias("event_type"),
        cat.iam_category(c("auth_method")).alias("auth_method"),
        net.source_ip(c("source_ip")).alias("source_ip"),
        net.ip_status(c("source_ip")).alias("ip_status"),
        ids.iam_hostname(c("hostname")).alias("hostname"),
        ids.iam_device_id(c("device_id")).alias("device_id"),
        cat.iam_category(c("session_id")).alias("session_id"),
        cat.iam_mfa_passed(c("mfa_passed")).alias("mfa_passed"),
        cat.iam_category(c("failure_reason"), cat.IAM_FAILURE_REASONS).alias("failure_reason"),
        net.iam_score(c("risk_score")).alias("risk_score"),
        cat.iam_risk_level(c("risk_score")).alias("risk_level"),
        cat.iam_geo(c("geo_location")).alias("geo_location"),
        unparsed((c("timestamp"), times.mixed_timestamp(c("timestamp")), ("",))),
        COPIES,
    )


def _endpoint_fields(rows: DataFrame) -> DataFrame:
    """Field rules plus the "raw value was missing" facts the flags need."""
    c = F.col
    labels = ("endpoint_product", "alert_name", "description", "file_path", "process_name",
              "sha256", "assigned_to")
    raw_missing = ("detected_timestamp", "resolved_timestamp", "severity", "status",
                   "device_criticality", "sha256")
    maps = {"severity": cat.ENDPOINT_SEVERITIES, "status": cat.ENDPOINT_STATUSES,
            "device_criticality": cat.ENDPOINT_CRITICALITIES}
    return rows.select(
        "alert_id",
        *[times.endpoint_timestamp(c(n)).alias(n)
          for n in ("detected_timestamp", "resolved_timestamp")],
        ids.endpoint_hostname(c("hostname")).alias("hostname"),
        ids.endpoint_host_key(c("hostname")).alias("hostname_join_key"),
        ids.endpoint_user_id(c("user_id")).alias("user_id"),
        *[ids.endpoint_label(c(n)).alias(n) for n in labels],
        *[cat.endpoint_category(c(n), mapping).alias(n) for n, mapping in maps.items()],
        *[ids.endpoint_text(c(n)).isNull().alias(f"_no_{n}") for n in raw_missing],
        as_flag(cat.sha256_valid(c("sha256"))).alias("sha256_valid_flag"),
        c("key_repeats").alias("duplicate_alert_id_flag"),
        c("key_conflicts").alias("duplicate_alert_id_different_content_flag"),
        COPIES,
    )


def endpoint_stage(raw: DataFrame) -> DataFrame:
    rows = distinct_with_copies(expected_only(raw, "endpoint"))
    return _flagged_alerts(flag_duplicate_keys(rows, "alert_id"))


def _flagged_alerts(flagged_ids: DataFrame) -> DataFrame:
    fields = _endpoint_fields(stripped(flagged_ids, RAW_COLUMNS["endpoint"][1:]))
    c = F.col
    detected, resolved, status = c("detected_timestamp"), c("resolved_timestamp"), c("status")
    unresolved = as_flag(status.isin(*cat.UNRESOLVED_STATUSES))
    finished = as_flag(status.isin("Resolved", "Closed"))
    flags = {
        "missing_user_id_flag": c("user_id").isNull(),
        "missing_hostname_flag": c("hostname").isNull(),
        "missing_detected_timestamp_flag": c("_no_detected_timestamp") & detected.isNull(),
        "invalid_detected_timestamp_flag": ~c("_no_detected_timestamp") & detected.isNull(),
        "missing_resolved_timestamp_flag": c("_no_resolved_timestamp") & resolved.isNull(),
        "invalid_resolved_timestamp_flag": ~c("_no_resolved_timestamp") & resolved.isNull(),
        "impossible_resolution_flag": as_flag(resolved < detected),
        "unresolved_alert_flag": unresolved,
        "resolved_without_timestamp_flag": finished & resolved.isNull(),
        "unresolved_with_resolution_timestamp_flag": unresolved & resolved.isNotNull(),
        "unmapped_severity_flag": c("severity").isNull() & ~c("_no_severity"),
        "unmapped_status_flag": status.isNull() & ~c("_no_status"),
        "unmapped_criticality_flag": c("device_criticality").isNull() & ~c("_no_device_criticality"),
        "sha256_missing_flag": c("_no_sha256"),
        "invalid_sha256_flag": ~c("sha256_valid_flag") & ~c("_no_sha256"),
    }
    flagged = fields.withColumns(flags)
    issues = sum((c(name).cast("int") for name in ENDPOINT_ISSUE_FLAGS), F.lit(0))
    return flagged.withColumns({
        "sha256_validation_status": F.when(c("sha256_missing_flag"), "missing_sha256")
        .when(c("sha256_valid_flag"), "valid_sha256").otherwise("malformed_sha256"),
        "data_quality_issue_count": issues,
        "data_quality_status": F.when(issues == 0, "Pass").otherwise("Review"),
    }).select(*CLEAN_COLUMNS["endpoint"], COPIES)


def firewall_stage(raw: DataFrame) -> DataFrame:
    """All columns take part in duplicate removal, unexpected ones included."""
    return _firewall_fields(distinct_with_copies(raw), [n for n in raw.columns if n not in RAW_COLUMNS["firewall"]])


def _firewall_fields(distinct: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    rows = stripped(distinct, RAW_COLUMNS["firewall"][1:])
    c = F.col
    numbers = {"src_port": net.port, "dst_port": net.port,
               "bytes_sent": net.byte_count, "bytes_received": net.byte_count}
    addresses = ("src_ip", "dst_ip")
    fields = rows.select(
        "log_id",
        times.firewall_timestamp(c("timestamp")).alias("timestamp"),
        ids.firewall_hostname(c("hostname")).alias("hostname"),
        *addresses,
        *[net.ip_valid(c(n)).alias(f"{n}_valid") for n in addresses],
        *[c(n).alias(f"_raw_{n}") for n in numbers],
        *[(net.finite(c(n)) if rule is net.port else rule(c(n))).alias(n) for n, rule in numbers.items()],
        cat.firewall_category(c("protocol"), cat.FIREWALL_PROTOCOLS, "OTHER").alias("protocol"),
        cat.firewall_category(c("action"), cat.FIREWALL_ACTIONS, "OTHER").alias("action"),
        ids.firewall_session_id(c("session_id")).alias("session_id"),
        cat.firewall_threat_flag(c("threat_flag")).alias("threat_flag"),
        F.upper(c("rule_name")).alias("rule_name"),
        cat.firewall_category(c("geo_country"), cat.FIREWALL_COUNTRIES).alias("geo_country"),
        ids.firewall_host_key(c("hostname")).alias("hostname_join_key"),
        *extra,
        COPIES,
    )
    # a port's number is asked several times, so it is read from its text in the stage before
    ports = {n: net.whole_port(c(n)) for n, rule in numbers.items() if rule is net.port}
    return fields.withColumns(ports).withColumns({
        **{n: F.when(c(f"{n}_valid"), c(n)) for n in addresses},
        **{f"{n}_status": net.field_status(c(f"_raw_{n}"), c(n)) for n in numbers},
    }).select(*CLEAN_COLUMNS["firewall"], *extra, COPIES)


STAGES = {
    "identity": identity_stage, "iam": iam_stage,
    "endpoint": endpoint_stage, "firewall": firewall_stage,
}


_FIELDS = {"iam": _iam_fields, "endpoint": _flagged_alerts, "firewall": _firewall_fields}
# the raw columns that a clean column follows from, where they are not just the one of its name
_FOLLOWS = {
    "risk_level": ("risk_score",), "ip_status": ("source_ip",), "hostname_join_key": ("hostname",),
    "unresolved_alert_flag": ("status",), "impossible_resolution_flag": ("detected_timestamp", "resolved_timestamp"),
}


def clean_part(table: str, raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Some columns of ``clean(table, raw)``, one row for each row of it, for readers of few columns.

    Only the raw columns asked for are shuffled, the others as a digest that tells rows apart, and
    only those are cleaned. Columns that follow from other rows (identity, duplicate flags) or from all
    columns have no part.
    """
    every = RAW_COLUMNS[table]
    kept = sorted({n for c in columns for n in _FOLLOWS.get(c, (c,))})
    if table not in _FIELDS or not set(kept) <= set(every) or not set(columns) <= set(CLEAN_COLUMNS[table]):
        raise ValueError(f"no part of {table} has {list(columns)}")
    rows = distinct_part(raw if table == "firewall" else expected_only(raw, table), kept)
    blank = {n: F.lit(None).cast("string") for n in every if n not in kept}
    if table == "endpoint":
        blank.update({n: F.lit(None).cast("boolean") for n in ("key_repeats", "key_conflicts")})
    return _FIELDS[table](rows.withColumns(blank)).select(*columns)


def clean(table: str, raw: DataFrame) -> DataFrame:
    return STAGES[table](raw).drop(COPIES, UNPARSED)
