"""Readers of a few columns get the rows of the whole clean table without shuffling whole rows."""

import os

import pytest
from helpers import firewall, raw
from pyspark.sql import functions as F

from tracewarden.operators import cleaning, dedupe, investigate
from tracewarden.plans import feed, queries

PARTS = {
    "iam": feed.FACTS["iam"], "endpoint": feed.FACTS["endpoint"],
    "firewall": ("hostname_join_key", "hostname", "bytes_sent", "bytes_received", "timestamp"),
}


def counted(df):
    return sorted(map(str, df.collect()))


def test_rest_of_a_row_is_told_apart(spark):
    rows = [("k", "a", "bc"), ("k", "ab", "c"), ("k", None, "a"), ("k", "a", None), ("k", "", None), ("k", None, ""),
            ("k", "-", None), ("k", None, "-"), (None, None, None), (None, None, None), ("k", "a", "bc"), ("k", "1:a", ""), ("k", "", "1:a")]
    df = spark.createDataFrame(rows, "key string, x string, y string")
    for kept in (["key"], ["key", "x"], ["y"], ["key", "x", "y"]):
        assert counted(dedupe.distinct_part(df, kept)) == counted(dedupe.distinct_with_copies(df).select(*kept, dedupe.COPIES))


def test_columns_that_are_no_text_stay_whole(spark):
    df = spark.createDataFrame([("k", 1.5, "a"), ("k", 2.5, "a"), ("k", 2.5, "a")], "key string, n double, x string")
    assert counted(dedupe.distinct_part(df, ["key"])) == counted(dedupe.distinct_with_copies(df).select("key", dedupe.COPIES))


def rows_of(table):
    shown = {
        "iam": [dict(event_id=" E1", timestamp="2024-01-02 03:04:05", user_id="emp-10001", event_type="login", hostname="WS-1",
                     session_id="sid1", mfa_passed="no", risk_score="95/100", geo_location="in"), dict(user_id="EMP7"), dict()],
        "endpoint": [dict(alert_id="A", detected_timestamp="2024-01-03", resolved_timestamp="2024-01-02", status="Resolved",
                          hostname="lpt_1.corp.local", user_id="EMP1", alert_name="Trojan  x", severity="p1", sha256="q"),
                     dict(alert_id="A", status="new", description="usb"), dict()],
        "firewall": [dict(log_id="F", timestamp="02/01/2024 10:11", hostname="lpt_1.corp.local", bytes_sent="1.5 KB", bytes_received="-5",
                          rule_name="r"), dict(hostname="WS-1", bytes_sent="7"), dict()],
    }[table]
    # each row twice, once more with another value in a column that no part reads
    other = {"iam": "geo_location", "endpoint": "assigned_to", "firewall": "rule_name"}[table]
    return [*shown, *shown, *[{**r, other: "else"} for r in shown]]


@pytest.mark.parametrize("table", PARTS)
def test_a_part_has_the_rows_of_the_clean_table(spark, table):
    df = raw(spark, table, *rows_of(table))
    part = cleaning.clean_part(table, df, PARTS[table])
    assert part.count() == 6
    assert counted(part) == counted(cleaning.clean(table, df).select(*PARTS[table]))


@pytest.mark.parametrize("table, column", [("endpoint", "duplicate_alert_id_flag"), ("endpoint", "data_quality_issue_count"),
                                           ("identity", "user_id"), ("firewall", "src_port_status"), ("iam", "nothing")])
def test_what_follows_from_other_rows_or_columns_has_no_part(spark, table, column):
    with pytest.raises(ValueError):
        cleaning.clean_part(table, raw(spark, table), (column,))


@pytest.fixture
def tables(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"{tmp_path}/kept")
    columns = {
        "customer": ["id as c_custkey", "concat('Customer#', lpad(cast(id as string), 9, '0')) as c_name", "'BUILDING' as c_mktsegment"],
        "orders": ["id as o_orderkey", "id % 40 as o_custkey", "'F' as o_orderstatus", "'1-URGENT' as o_orderpriority"],
        "events": ["id as event_id", "id % 40 as user_id", "timestamp_ntz'2024-01-05 10:00:00' as ts", "1.5D as value", "'click' as event_type"],
        "lineitem": ["id as l_orderkey", "cast(1 + id % 7 as int) as l_linenumber", "900.5D as l_extendedprice"],
    }
    for name, chosen in columns.items():
        spark.range(120).selectExpr(*chosen).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", [
    "traffic_volume", "session_hostname_consistency_report", "malware_lateral_detections", "investigation_report"])
def test_queries_of_few_columns_write_no_whole_tables(spark, tables, name):
    alone = counted(queries.QUERIES[name](spark, tables))
    written = {at for _, found, _ in os.walk(f"{tables}/kept") for at in found if at.endswith("_stage")}
    assert written <= {"identity_stage"}
    # the same once the whole clean tables are there to be read
    full = feed.Feed(spark, tables)
    for table in ("iam", "endpoint", "firewall"):
        full.stage(table)
    for key in [k for k in feed._WRITTEN if k[1].startswith(tables) and not k[2].endswith("_stage")]:
        del feed._WRITTEN[key]
    assert counted(queries.QUERIES[name](spark, tables)) == alone


def test_traffic_shuffles_no_column_it_does_not_read(spark):
    part = cleaning.clean_part("firewall", raw(spark, "firewall", *rows_of("firewall")), PARTS["firewall"])
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "rule_name" not in grouped and "session_id" not in grouped
    assert part.where(F.col("hostname").isNotNull()).count() == 4


def test_firewall_rows_meet_users_by_their_spelling(spark):
    logs = firewall(
        spark, dict(log_id="1", hostname="a.corp.local", hostname_join_key="a"), dict(log_id="2", hostname="a", hostname_join_key="a"),
        dict(log_id="2", hostname="a", hostname_join_key="a"), dict(log_id="3", hostname="b.x"),
        dict(log_id="4", hostname="B.X", hostname_join_key="c"), dict(log_id="5", hostname_join_key="D"), dict(log_id="6"))
    wanted = spark.createDataFrame(
        [("U", "a"), ("U", "a.corp.local"), ("V", "a.corp.local"), ("W", "b.x"), ("X", "d"), ("X", "c"), ("Y", "zz")],
        "user_id string, host_key string")
    events = investigate.firewall_events(wanted, logs)
    assert sorted((r["user_id"], r["log_id"]) for r in events.collect()) == [
        ("U", "1"), ("U", "2"), ("U", "2"), ("V", "1"), ("W", "3"), ("W", "4"), ("X", "4"), ("X", "5")]
    # only spellings get two names, never the rows with their other columns
    plan = events._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for at, line in enumerate(plan):
        if "Generate inline" in line:
            assert any("Aggregate" in below for below in plan[at + 1:at + 4])
