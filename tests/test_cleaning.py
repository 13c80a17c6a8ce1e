"""Cleaners, duplicate evidence, flags and reports on small raw tables."""

from helpers import raw

from tracewarden.operators import dedupe, quality
from tracewarden.operators.cleaning import clean, endpoint_stage, firewall_stage, identity_stage
from tracewarden.schemas import CLEAN_COLUMNS, ENDPOINT_ISSUE_FLAGS


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_identity_device_conflict(spark):
    df = clean("identity", raw(
        spark, "identity", {"user_id": "1", "device_id": "dev-1"}, {"user_id": "2", "device_id": "DEV1"},
        {"user_id": "3", "device_id": "none"}, {"user_id": "3", "device_id": "none"}))
    assert df.columns == list(CLEAN_COLUMNS["identity"])
    rows = by(df, "user_id")
    assert len(rows) == 3 and rows["EMP1"]["device_id_conflict"] and rows["EMP1"]["device_user_count"] == 2
    assert not rows["EMP3"]["device_id_conflict"] and rows["EMP3"]["device_user_count"] == 0


def test_endpoint_duplicate_evidence(spark):
    table = raw(
        spark, "endpoint",
        {"alert_id": "A", "status": "open"}, {"alert_id": "A", "status": "open"},
        {"alert_id": "B", "status": "open"}, {"alert_id": "B", "status": "new"},
        {"alert_id": "C", "status": "open"}, {"alert_id": "C", "status": "open"},
        {"alert_id": "C", "status": "new"}, {"alert_id": None, "status": "x1"},
        {"alert_id": None, "status": "x2"}, {"alert_id": "D"})
    flags = {(r["alert_id"], r["status"]): (r["duplicate_alert_id_flag"],
                                            r["duplicate_alert_id_different_content_flag"])
             for r in clean("endpoint", table).collect()}
    assert flags[("A", "Open")] == (False, False)
    assert flags[("B", "Open")] == flags[("B", "New")] == (True, True)
    assert flags[("C", "Open")] == flags[("C", "New")] == (True, True)
    assert flags[(None, None)] == (True, True)
    assert flags[("D", None)] == (False, False)
    summary = dedupe.duplicate_key_summary(table, "alert_id").first()
    assert (summary["rows_in_duplicate_groups"], summary["extra_duplicate_rows"],
            summary["distinct_keys"]) == (9, 5, 4)


def test_endpoint_flags(spark):
    df = clean("endpoint", raw(
        spark, "endpoint",
        {"alert_id": "1", "detected_timestamp": "2024-01-02", "resolved_timestamp": "2024-01-01",
         "status": "resolved", "severity": "zzz", "sha256": "abc", "user_id": "7", "hostname": "h"},
        {"alert_id": "2", "detected_timestamp": "bad", "resolved_timestamp": "n/a", "status": "fp",
         "severity": "N/A", "device_criticality": "vip"}))
    one, two = (by(df, "alert_id")[k] for k in "12")
    assert one["impossible_resolution_flag"] and one["unmapped_severity_flag"] and one["invalid_sha256_flag"]
    assert one["data_quality_issue_count"] == 3 and one["data_quality_status"] == "Review"
    assert two["invalid_detected_timestamp_flag"] and two["missing_resolved_timestamp_flag"]
    assert two["resolved_without_timestamp_flag"] and not two["unmapped_severity_flag"]
    assert two["sha256_validation_status"] == "missing_sha256"
    assert two["data_quality_issue_count"] == sum(two[f] for f in ENDPOINT_ISSUE_FLAGS) == 5
    quality.require_domains(df)


def test_firewall_statuses_and_extra_column(spark):
    from pyspark.sql import functions as F

    table = raw(spark, "firewall", {"log_id": "1", "src_port": "80.0", "bytes_sent": "x", "src_ip": "1.2.3"},
                {"log_id": "1", "src_port": "80.0", "bytes_sent": "x", "src_ip": "1.2.3"})
    df = firewall_stage(table.withColumn("extra", F.lit("e")))
    row = df.collect()
    assert len(row) == 1 and row[0]["_copies"] == 2 and row[0]["extra"] == "e"
    assert row[0]["src_port_status"] == "valid" and row[0]["bytes_sent_status"] == "invalid"
    assert row[0]["bytes_received_status"] == "missing"
    assert row[0]["src_ip"] is None and row[0]["src_ip_valid"] is False and row[0]["dst_ip_valid"] is None


def test_profile_and_summary(spark):
    stage = identity_stage(raw(
        spark, "identity", {"user_id": "1", "hire_date": "2024-01-02", "termination_date": "2024-01-01"},
        {"user_id": "1", "hire_date": "2024-01-02", "termination_date": "2024-01-01"},
        {"user_id": "1", "username": "a"}, {"user_id": None}))
    metrics = {r["metric"]: r["value"] for r in quality.identity_summary(stage).collect()}
    assert metrics["raw_rows"] == 4 and metrics["exact_duplicate_rows"] == 1 and metrics["clean_rows"] == 3
    assert metrics["duplicate_user_id_rows"] == 2 and metrics["termination_before_hire"] == 1
    profile = by(quality.column_profile(stage, ["user_id", "username"]), "column")
    assert tuple(profile["user_id"])[1:] == (3, 1, 33.33, 1)
    assert tuple(profile["username"])[1:] == (3, 2, 66.67, 1)
    sketch = by(quality.column_profile(stage, ["user_id"], approximate=True), "column")
    assert sketch["user_id"]["unique_values"] == 1


def test_first_per_key_is_total(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("a", 1, "y"), (None, 5, "z")], "k string, n int, v string")
    got = {(r["k"], r["n"], r["v"]) for r in dedupe.first_per_key(df, "k").collect()}
    assert got == {("a", 1, None), (None, 5, "z")}


def test_endpoint_stage_same_for_any_partitioning(spark):
    rows = [{"alert_id": str(i % 7), "status": "open", "description": f"d{i % 11}"} for i in range(60)]
    table = raw(spark, "endpoint", *rows)
    once = sorted(map(str, endpoint_stage(table.repartition(1)).collect()))
    again = sorted(map(str, endpoint_stage(table.repartition(8)).collect()))
    assert once == again
