"""Risk caps and bands, queue priorities, linkage strength, evidence summaries."""

from datetime import timedelta

import pytest
from helpers import at, endpoint, firewall, iam, identity
from pyspark.sql import functions as F

from tracewarden.operators import investigate, linkage, queue, risk, summary

T0 = at("2024-01-05 10:00:00")


def test_bands(spark):
    scores = [24.0, 24.5, 49.0, 49.5, 74.0, 74.5]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    assert [r[0] for r in df.select(risk.risk_band(F.col("s"))).collect()] == [
        "Low", "Medium", "Medium", "High", "High", "Critical"]


COUNTS = ("iam_failed_auth iam_mfa_failures iam_high_risk_events endpoint_critical_alerts endpoint_high_alerts "
          "endpoint_unresolved_critical endpoint_malware_alerts endpoint_credential_alerts "
          "endpoint_lateral_movement endpoint_powershell endpoint_tampering endpoint_usb "
          "post_termination_activity").split()


def test_component_caps(spark):
    df = spark.createDataFrame([(100,) * len(COUNTS), (0,) * len(COUNTS)], ", ".join(f"{c} long" for c in COUNTS))
    full, none = risk.with_components(df).collect()
    names = ("authentication_risk", "iam_risk", "endpoint_severity_risk", "threat_behavior_risk",
             "contextual_risk", "cross_signal_bonus")
    assert [full[n] for n in names] == [20, 20, 20, 30, 15, 10]
    assert sum(none[n] for n in names) == 0


def test_score_invariants_and_drivers(spark):
    ident = identity(spark, {"user_id": "A", "status": "Active", "hostname": "h"}, {"user_id": "B"})
    events = iam(spark, {"user_id": "A", "event_id": "1", "event_type": "LOGIN_FAILURE", "risk_score": 80.0},
                 {"user_id": "A", "event_id": "2", "failure_reason": "X", "mfa_passed": False})
    rows = {r["user_id"]: r for r in risk.score_users(ident, events, endpoint(spark)).collect()}
    a, b = rows["A"], rows["B"]
    assert a["risk_score"] == 2 + 1.5 + 2 and a["iam_avg_risk_score"] == 80.0
    assert a["risk_drivers"] == "2 failed authentication events; 1 high-risk IAM events"
    assert b["risk_score"] == 0 and b["iam_events"] == 0 and b["risk_drivers"] == "No high-priority risk drivers"
    bands = {r["risk_band"]: (r["user_count"], r["percentage"])
             for r in risk.band_distribution(risk.score_users(ident, events, endpoint(spark))).collect()}
    assert bands == {"Low": (2, 100.0), "Medium": (0, 0.0), "High": (0, 0.0), "Critical": (0, 0.0)}


def _threat(user, kind, severity, confidence="High"):
    return (user, kind, severity, confidence)


def test_priority(spark):
    threats = spark.createDataFrame(
        [_threat("A", "x", "Critical"), _threat("B", "x", "Medium"), _threat("C", "x", "Critical"),
         _threat("C", "x", "Critical"), _threat("D", "x", "High", "Low"), _threat(None, "x", "High"),
         _threat("E", "x", "Odd", "Odd"), _threat("Z", "x", "High")],
        "user_id string, threat_type string, severity string, confidence string")
    scores = spark.createDataFrame(
        [("A", 79.5), ("B", 39.0), ("C", 10.0), ("D", 60.0), ("E", None), ("Q", 99.0)],
        "user_id string, risk_score double").withColumns(
        {n: F.lit(n) for n in ("department", "role", "status", "risk_level")})
    built = queue.build_queue(threats, scores, identity(spark, {"user_id": "A", "hostname": "h"}))
    rows = {r["user_id"]: r for r in built.collect()}
    assert set(rows) == {"A", "B", "C", "D", "E"}
    assert rows["A"]["investigation_priority_score"] == 84.5 and rows["A"]["investigation_priority"] == "Critical"
    assert rows["B"]["investigation_priority"] == "Low" and rows["C"]["investigation_priority_score"] == 20
    assert rows["D"]["investigation_reason"] == "high user risk score (60.0); 1 high-severity detection(s)"
    assert rows["E"]["investigation_reason"] == "1 threat detection(s)" and rows["E"]["highest_severity"] == "Low"
    assert [r["user_id"] for r in sorted(rows.values(), key=lambda r: r["priority_rank"])] == ["A", "D", "B", "C", "E"]
    assert queue.corroboration(threats).where("user_id IS NULL").count() == 1
    assert [tuple(r) for r in queue.queue_summary(built).collect()] == [("Critical", 1), ("High", 1), ("Low", 3)]


@pytest.mark.parametrize("rate, label", [(90.0, "Strong"), (89.99, "Moderate"), (75.0, "Moderate"), (74.9, "Weak")])
def test_strength(spark, rate, label):
    assert spark.range(1).select(linkage.strength(F.lit(rate))).first()[0] == label


def test_linkage_report(spark):
    ident = identity(spark, {"user_id": "A", "hostname": "H1", "device_id": "D"}, {"user_id": "B", "hostname": "H1"})
    events = iam(spark, {"user_id": "A", "hostname": "h1.corp.local"}, {"user_id": "A", "hostname": "zz"}, {"user_id": None})
    report = {(r["source"], r["relationship"]): r for r in linkage.relationship_report(
        ident, events, endpoint(spark), firewall(spark)).collect()}
    users = report[("IAM", "user_id -> identity")]
    assert (users["rows"], users["matched"], users["missing"], users["unmatched"]) == (3, 2, 1, 0)
    pairs = report[("IAM", "user_id + hostname -> identity")]
    assert (pairs["usable_pairs"], pairs["consistent_pairs"], pairs["consistency_rate_pct"]) == (2, 1, 50.0)
    empty = report[("Firewall", "hostname -> identity")]
    assert empty["match_rate_pct"] == 0 and empty["relationship_status"] == "Weak"
    assert len(report) == 8
    hosts = linkage.ambiguous_keys(linkage.identity_keys(ident), "hostname_join_key").collect()
    assert [tuple(r) for r in hosts] == [("h1", 2)]


def test_session_evidence(spark):
    sec = timedelta(seconds=1)
    events = iam(spark, {"session_id": "S1", "timestamp": T0, "hostname": "H"}, {"session_id": "S2", "timestamp": T0},
                 {"session_id": "S3", "hostname": "a"}, {"session_id": "ONLY"})
    logs = firewall(spark, {"session_id": "s1", "timestamp": T0 + 3600 * sec, "hostname": "h.corp.local"},
                    {"session_id": "S2", "timestamp": T0 + 3601 * sec}, {"session_id": "S3", "timestamp": T0, "hostname": "b"})
    rows = {r["session_id"]: r for r in linkage.shared_session_evidence(events, logs).collect()}
    assert rows["S1"]["within_60_minutes"] and rows["S1"]["hostname_overlap"]
    assert not rows["S2"]["within_60_minutes"] and rows["S2"]["min_time_difference_seconds"] == 3601
    assert not rows["S3"]["timestamp_evidence"] and set(rows) == {"S1", "S2", "S3"}
    total = linkage.session_evidence_summary(linkage.shared_session_evidence(events, logs)).first()
    assert tuple(total) == (3, 1, 1, 1, 1, "Rejected")


def test_timeline_and_firewall_fallback(spark):
    ident = identity(spark, {"user_id": "A", "hostname": "H1"}, {"user_id": "B"})
    alerts = endpoint(spark, {"user_id": "B", "alert_id": "1", "hostname": "h2.corp.local", "detected_timestamp": T0})
    logs = firewall(
        spark, {"log_id": "1", "hostname": "h1", "hostname_join_key": "h1", "timestamp": T0, "bytes_sent": 10_000_000},
        {"log_id": "2", "hostname": "h1.corp.local", "hostname_join_key": "h1", "timestamp": T0, "bytes_sent": 10_000_001},
        {"log_id": "3", "hostname": "h2.corp.local", "hostname_join_key": "h2", "timestamp": T0, "threat_flag": True})
    hosts = investigate.host_keys(investigate.related_hosts(ident, iam(spark), alerts))
    part = investigate.firewall_events(hosts, logs)
    assert {(r["user_id"], r["log_id"]) for r in part.collect()} == {("A", "1"), ("A", "2"), ("B", "3")}
    line = investigate.evidence_timeline(
        investigate.iam_events(iam(spark)), investigate.endpoint_events(alerts), part)
    levels = {(r["user_id"], r["position"]): (r["source"], r["severity"]) for r in line.collect()}
    assert levels == {("A", 1): ("Firewall Logs", "MEDIUM"), ("A", 2): ("Firewall Logs", "HIGH"),
                      ("B", 1): ("Endpoint Alert (EDR)", "MEDIUM"), ("B", 2): ("Firewall Logs", "CRITICAL")}


def test_critical_accounts_fallback(spark):
    cols = "user_id string, risk_score double, risk_level string, department string, risk_drivers string"
    low = spark.createDataFrame([("A", 1.0, "Low", "d", "x"), ("B", 2.0, "Low", "d", "x")], cols)
    assert [r["user_id"] for r in investigate.critical_accounts(low).collect()] == ["B", "A"]
    crit = spark.createDataFrame([("A", 1.0, "Low", "d", "x"), ("B", 99.0, "Critical", "d", "x")], cols)
    assert [r["user_id"] for r in investigate.critical_accounts(crit).collect()] == ["B"]
    assert summary.overall(crit).first()["critical_users"] == 1


def test_mentions(spark):
    ident = identity(spark, {"user_id": "EMP10", "full_name": "Ann O'Neil", "username": "ann.o"},
                     {"user_id": "EMP11", "full_name": "Bo", "username": "bobb"})
    texts = spark.createDataFrame([(1, "emp - 10 and USR-9, usr 9"), (2, "ask ann o'neil!"), (3, "annO'Neil bobby"),
                                   (4, "BOBB EMP10, Ann O'Neil EMP1234567")], "k int, text string")
    got = {(r["k"], r["user_id"], r["found"], r["how"])
           for r in investigate.user_mentions(texts, ["k"], ident, ident).collect()}
    assert got == {(1, "EMP10", True, "id"), (1, "USR-9", False, "id"), (1, "USR9", False, "id"),
                   (2, "EMP10", True, "name"), (4, "EMP11", True, "name"), (4, "EMP10", True, "id"),
                   # ids of any length are read, a deviation that README states
                   (4, "EMP1234567", False, "id")}


def test_busy_users_keep_all_their_evidence(spark):
    """A user with 300 earlier events whose only late one is a firewall row of a late host."""
    sec = timedelta(seconds=1)
    ident = identity(spark, {"user_id": "A", "status": "Terminated", "termination_date": T0 + 400 * sec}, {"user_id": "B"})
    events = iam(spark, *[{"user_id": "A", "event_id": f"{i:03}", "timestamp": T0 + i * sec, "hostname": "early",
                           "mfa_passed": i != 299} for i in range(300)],
                 {"user_id": "A", "event_id": "x", "timestamp": T0 + 350 * sec, "hostname": "late"})
    logs = firewall(spark, *[{"log_id": f"{i:03}", "hostname": "early.corp.local", "hostname_join_key": "early",
                              "timestamp": T0 + i * sec, "bytes_sent": 1} for i in range(150)],
                    {"log_id": "z", "hostname": "late", "hostname_join_key": "late", "timestamp": T0 + 500 * sec, "bytes_received": 7})
    alerts = endpoint(spark)
    found = investigate.related_hosts(ident, events, alerts)
    assert {tuple(r) for r in found.collect()} == {("A", "early"), ("A", "late")}
    traffic = investigate.user_traffic(investigate.host_keys(found), logs)
    assert [(r["user_id"], r["match"], r["total_bytes"], r["log_entries"], r["latest"]) for r in traffic.collect()] == [
        ("A", 1, 157, 151, T0 + 500 * sec)]
    latest = investigate.latest_activity(events, alerts, traffic)
    risk = spark.createDataFrame([], "user_id string, username string, department string, role string, status string, risk_score double, "
                                 "risk_band string, risk_level string, risk_drivers string, post_termination_activity_flag boolean, "
                                 + ", ".join(f"{n} double" for n in investigate._BREAKDOWN.values())
                                 + ", " + ", ".join(f"{n} bigint" for n in investigate._METRICS))
    heads = {r["user_id"]: r["post_termination"] for r in investigate.report_headers(ident, risk, latest).collect()}
    assert heads == {"A": True, "B": False}
    assert [r["event_id"] for r in investigate.mfa_evidence(investigate.iam_events(events)).collect()] == ["299"]
    line = investigate.evidence_timeline(
        investigate.iam_events(events), investigate.endpoint_events(alerts), investigate.firewall_events(investigate.host_keys(found), logs))
    places = [(r["position"], r["details"]) for r in line.collect()]
    assert sorted(p for p, _ in places) == list(range(1, 453)) and "late" in max(places)[1]
    bundle = investigate.evidence_bundle({"iam": investigate.iam_events(events), "timeline": line}, ident)
    assert {(r["domain"], r["count"]) for r in bundle.groupBy("domain").count().collect()} == {("iam", 301), ("timeline", 452)}
    one = bundle.where("domain = 'iam' AND place LIKE '%|299|%'").selectExpr("variant_get(payload, '$.mfa_passed', 'boolean') AS m").first()
    assert one["m"] is False


def test_first_rows_of_a_hot_key(spark):
    """A key with a third of all rows: the ranking task of the second level sees n rows of each salt."""
    rows = spark.range(0, 30_000, 1, 64).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("user_id"), (F.col("id") * 7919 % 30_011).alias("t"))
    got = investigate._earliest(rows, "user_id", [F.asc("t")], 5)
    want = rows.groupBy("user_id").agg(F.slice(F.array_sort(F.collect_list("t")), 1, 5).alias("t"))
    assert {r["user_id"]: r["t"] for r in want.collect()} == {
        r["user_id"]: r["t"] for r in got.groupBy("user_id").agg(F.array_sort(F.collect_list("t")).alias("t")).collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "_salt" in plan
    hot = investigate._earliest(rows.where("user_id = 'hot'"), "user_id", [F.asc("t")], 5)
    hot.collect()
    # rows that reach the second level: at most n for each salt
    few = rows.where("user_id = 'hot'").withColumn("_salt", F.pmod(F.xxhash64("user_id", "t"), F.lit(investigate.SALTS)))
    assert few.select("_salt").distinct().count() == investigate.SALTS


def test_names_among_many_words(spark):
    """Names of one to five words, odd separators, against a plain search; no shuffle but of filtered runs."""
    import re

    people = ["Ann O'Neil", "Bo-Lin", "José de la Cruz Vega", "Zoë", "Ann", "x_y 9", "Maria  Two-Spaces", "Åsa Öst"]
    ident = identity(spark, *[{"user_id": f"EMP{i}", "full_name": n} for i, n in enumerate(people)])
    lines = ["ann o'neil met ANN O'NEIL.", "bo-lin, bo lin", "josé de la cruz vega!", "zoë zoës zoë", "", None, "!!! ...", "x_y 9x x_y 9",
             "maria  two-spaces maria two-spaces", "the åsa öst-side åsa", "ann " * 3000 + "åsa öst"]
    texts = spark.createDataFrame(list(enumerate(lines)), "k int, text string")
    got = {(r["k"], r["user_id"]) for r in investigate.name_mentions(texts, ["k"], ident).collect()}
    want = {(k, f"EMP{i}") for k, t in enumerate(lines) for i, n in enumerate(people) if t and len(n) >= 4
            and re.search(rf"(?<!\w){re.escape(n.lower())}(?!\w)", t.lower())}
    assert got == want and len(want) >= 7
    assert investigate.name_mentions(texts, ["k"], identity(spark)).collect() == []


def test_positions_of_busy_users_in_one_shuffle(spark, monkeypatch):
    """Keys over the limit are numbered hour by hour, the others at once; equal times are told apart by the rest of the order."""
    rows = spark.range(0, 6_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 7919 % 5_003 * 60).cast("timestamp_ntz").alias("timestamp"), F.col("id").alias("tie"))
    order = [F.asc("timestamp"), F.asc("tie")]
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["timestamp"], r["tie"])):
        want[r["user_id"], want.setdefault(r["user_id"], 0) + 1] = r["tie"]
        want[r["user_id"]] += 1
    want = {k: v for k, v in want.items() if isinstance(k, tuple)}
    for limit in (1 << 20, 500):
        monkeypatch.setattr(investigate, "BUSY_ROWS", limit)
        got = investigate.numbered_within(rows, "user_id", "timestamp", order, "position")
        assert got.columns == ["user_id", "timestamp", "tie", "position"] and dict(got.dtypes)["position"] == "bigint"
        assert {(r["user_id"], r["position"]): r["tie"] for r in got.collect()} == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" not in plan and "LogicalRDD" not in plan
    none = investigate.numbered_within(rows.where("tie < 0"), "user_id", "timestamp", order, "position")
    assert none.collect() == []


def test_first_firewall_rows_in_two_shuffles(spark):
    """The cut per host and the join share one shuffle; the cut per user is the other. Short keys win over full names."""
    sec = timedelta(seconds=1)
    logs = firewall(spark, *[{"log_id": f"{i:03}", "hostname": f"h{i % 3}.corp.local", "hostname_join_key": f"h{i % 3}",
                              "timestamp": T0 + (i * 37 % 90) * sec} for i in range(90)])
    wanted = spark.createDataFrame([("A", "h0"), ("A", "h1"), ("B", "h2.corp.local"), ("C", "h0.corp.local"), ("C", "h1"), ("D", "x")],
                                   "user_id string, host_key string")
    part = investigate.firewall_events(wanted, logs, 4)
    got = {}
    for r in sorted(part.collect(), key=lambda r: (r["user_id"], r["event_no"])):
        got.setdefault(r["user_id"], []).append(r["log_id"])
    at = sorted(range(90), key=lambda i: i * 37 % 90)
    first = lambda *hosts: [f"{i:03}" for i in at if i % 3 in hosts][:4]
    assert got == {"A": first(0, 1), "B": first(2), "C": first(1)}
    part = investigate.firewall_events(wanted, logs, 4)  # a plan that has not run yet
    shuffles = [line for line in part._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) <= 3


def test_a_name_of_many_users_is_dealt_into_parts(spark, monkeypatch):
    """Each text that mentions a shared name lists all its users once, whatever the size of a part."""
    ident = identity(spark, *[{"user_id": f"EMP{i}", "full_name": "Alex Morgan", "username": "alex morgan" if i % 2 else f"alex{i}"}
                              for i in range(60)], {"user_id": "EMP77", "full_name": "Bo Lin"})
    texts = spark.createDataFrame([(k, "ask alex morgan, Alex Morgan" + (" or bo lin" if k % 2 else " EMP3")) for k in range(10)], "k int, text string")
    want = {(k, f"EMP{i}", True, "id" if i == 3 and k % 2 == 0 else "name") for k in range(10) for i in range(60)} | {
        (k, "EMP77", True, "name") for k in range(1, 10, 2)}
    for users in (256, 7, 1):
        monkeypatch.setattr(investigate, "NAME_USERS", users)
        got = investigate.user_mentions(texts, ["k"], ident, ident).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    plan = investigate.name_mentions(texts, ["k"], ident)._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan
