"""Column contracts of the raw and published tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the exports and of the published tables are the contract
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "identity": (
        "full_name", "role", "user_id", "department", "location", "status", "hire_date",
        "termination_date", "username", "hostname", "device_id", "manager_username",
    ),
    "iam": (
        "event_id", "timestamp", "user_id", "username", "department", "event_type",
        "auth_method", "source_ip", "hostname", "device_id", "session_id", "mfa_passed",
        "failure_reason", "risk_score", "geo_location",
    ),
    "endpoint": (
        "alert_id", "detected_timestamp", "resolved_timestamp", "hostname", "user_id",
        "endpoint_product", "alert_name", "severity", "status", "description", "file_path",
        "process_name", "sha256", "assigned_to", "device_criticality",
    ),
    "firewall": (
        "log_id", "timestamp", "hostname", "src_ip", "dst_ip", "src_port", "dst_port",
        "protocol", "action", "bytes_sent", "bytes_received", "session_id", "threat_flag",
        "rule_name", "geo_country",
    ),
}

CLEAN_COLUMNS: dict[str, tuple[str, ...]] = {
    "identity": RAW_COLUMNS["identity"] + ("device_id_conflict", "device_user_count"),
    "iam": (
        "event_id", "timestamp", "user_id", "username", "department", "event_type",
        "auth_method", "source_ip", "ip_status", "hostname", "device_id", "session_id",
        "mfa_passed", "failure_reason", "risk_score", "risk_level", "geo_location",
    ),
    "endpoint": (
        "alert_id", "detected_timestamp", "resolved_timestamp", "hostname",
        "hostname_join_key", "user_id", "endpoint_product", "alert_name", "severity",
        "status", "description", "file_path", "process_name", "sha256", "assigned_to",
        "device_criticality", "duplicate_alert_id_flag",
        "duplicate_alert_id_different_content_flag", "missing_user_id_flag",
        "missing_hostname_flag", "missing_detected_timestamp_flag",
        "invalid_detected_timestamp_flag", "missing_resolved_timestamp_flag",
        "invalid_resolved_timestamp_flag", "impossible_resolution_flag",
        "unresolved_alert_flag", "resolved_without_timestamp_flag",
        "unresolved_with_resolution_timestamp_flag", "unmapped_severity_flag",
        "unmapped_status_flag", "unmapped_criticality_flag", "sha256_valid_flag",
        "sha256_missing_flag", "invalid_sha256_flag", "sha256_validation_status",
        "data_quality_issue_count", "data_quality_status",
    ),
    "firewall": RAW_COLUMNS["firewall"] + (
        "hostname_join_key", "src_ip_valid", "dst_ip_valid", "src_port_status",
        "dst_port_status", "bytes_sent_status", "bytes_received_status",
    ),
}

# The flags that add up to data_quality_issue_count.
ENDPOINT_ISSUE_FLAGS = (
    "duplicate_alert_id_flag", "missing_user_id_flag", "missing_hostname_flag",
    "invalid_detected_timestamp_flag", "invalid_resolved_timestamp_flag",
    "impossible_resolution_flag", "resolved_without_timestamp_flag",
    "unresolved_with_resolution_timestamp_flag", "unmapped_severity_flag",
    "unmapped_status_flag", "unmapped_criticality_flag", "invalid_sha256_flag",
)

RISK_COLUMNS = (
    "user_id", "username", "department", "role", "status", "hostname_count", "device_count",
    "iam_events", "iam_failed_auth", "iam_mfa_failures", "iam_high_risk_events",
    "iam_avg_risk_score", "iam_max_risk_score", "iam_hostname_count", "iam_session_count",
    "endpoint_alerts", "endpoint_critical_alerts", "endpoint_high_alerts",
    "endpoint_unresolved_critical", "endpoint_malware_alerts", "endpoint_credential_alerts",
    "endpoint_lateral_movement", "endpoint_powershell", "endpoint_tampering", "endpoint_usb",
    "endpoint_impossible_resolution", "endpoint_hostname_count", "termination_date",
    "post_termination_iam_events", "post_termination_endpoint_events",
    "post_termination_activity", "post_termination_activity_flag", "authentication_risk",
    "iam_risk", "endpoint_severity_risk", "threat_behavior_risk", "contextual_risk",
    "cross_signal_bonus", "risk_score", "risk_level", "risk_band", "risk_drivers",
)

DETECTION_COLUMNS = (
    "user_id", "threat_type", "severity", "confidence", "evidence", "first_observed",
    "last_observed", "related_hostname", "related_alert_count", "recommended_action",
)

QUEUE_COLUMNS = (
    "priority_rank", "user_id", "full_name", "department", "role", "status", "location",
    "hostname", "device_id", "risk_score", "risk_level", "investigation_priority_score",
    "investigation_priority", "threat_detection_count", "distinct_threat_types",
    "threat_types", "critical_detections", "high_detections", "medium_detections",
    "highest_severity", "highest_confidence", "device_id_conflict", "device_user_count",
    "investigation_reason", "recommended_action",
)

# Every dataset one pipeline run must leave behind.
PUBLISHED = (
    "identity_clean", "iam_clean", "endpoint_clean", "firewall_clean",
    "relationship_quality_report", "session_relationship_report",
    "session_hostname_consistency_report", "shared_session_evidence",
    "ambiguous_hostnames", "ambiguous_devices", "user_risk_scores",
    "risk_band_distribution", "top_100_risk_users", "threat_detections",
    "threat_type_summary", "threat_severity_summary", "investigation_queue",
    "investigation_queue_summary",
)


def text_schema(table: str) -> T.StructType:
    """Raw tables are read as text: no inference, no silent conversion."""
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])
