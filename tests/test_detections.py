"""Boundary cases of the threat rules, ids and ranking."""

import random
import time
from datetime import timedelta

from helpers import at, endpoint, iam, identity
from pyspark.sql import functions as F

from tracewarden.operators import detections as det
from tracewarden.operators.ranking import number_rows
from tracewarden.operators.signals import user_signals

T0 = at("2024-01-05 10:00:00")
H24 = timedelta(hours=24)
SEC = timedelta(seconds=1)


def users(df):
    return {r["user_id"]: r for r in df.collect()}


def test_post_termination_is_strict(spark):
    ident = identity(spark, *[{"user_id": u, "termination_date": T0} for u in ("A", "B", "C")],
                     {"user_id": "A", "termination_date": T0 - H24})
    events = iam(spark, {"user_id": "A", "event_id": "1", "timestamp": T0},
                 {"user_id": "B", "event_id": "2", "timestamp": T0 + SEC, "hostname": "WS_1"},
                 {"user_id": "C", "event_id": "3", "timestamp": None})
    alerts = endpoint(spark, {"user_id": "B", "alert_id": "9", "detected_timestamp": T0 + H24, "hostname": "h"})
    got = users(det.post_termination_activity(ident, user_signals(events, alerts)))
    assert set(got) == {"B"}
    assert got["B"]["evidence"].startswith("1 IAM and 1 endpoint events") and got["B"]["confidence"] == "High"
    assert got["B"]["related_hostname"] == "WS_1" and got["B"]["related_alert_count"] == 2


def _credential(spark, alert_at, failures=3, mfa=2):
    events = [{"user_id": "U", "event_id": str(i), "timestamp": T0 + i * SEC, "hostname": f"H_{i}",
               "event_type": "LOGIN_FAILURE" if i < failures else "LOGIN_SUCCESS", "mfa_passed": i >= mfa}
              for i in range(4)]
    alerts = endpoint(spark, {"user_id": "U", "alert_id": "a", "alert_name": "Credential dumping",
                              "detected_timestamp": alert_at})
    return det.credential_compromise(user_signals(iam(spark, *events), alerts)).collect()


def test_credential_window(spark):
    hit = _credential(spark, T0 + H24)
    assert len(hit) == 1 and hit[0]["first_observed"] == T0 and hit[0]["last_observed"] == T0 + H24
    assert hit[0]["related_hostname"] == "h-0" and hit[0]["related_alert_count"] == 1
    assert _credential(spark, T0 - SEC) == []
    assert _credential(spark, T0 + H24 + 5 * SEC) == []
    assert _credential(spark, T0 + H24, failures=2) == []
    assert _credential(spark, T0 + H24, mfa=1) == []


def test_malware_lateral(spark):
    def alert(user, name, when, host=None):
        return {"user_id": user, "alert_id": f"{user}{name}{when}", "alert_name": name,
                "detected_timestamp": when, "hostname": host}

    alerts = endpoint(
        spark, alert("SELF", "malware lateral", T0, "h1"), alert("NULLS", "malware", T0),
        alert("NULLS", "lateral", T0), alert("EDGE", "malware", T0, "h"),
        alert("EDGE", "lateral", T0 + H24, "h"), alert("LATE", "malware", T0, "h"),
        alert("LATE", "lateral", T0 + H24 + SEC, "h"), alert("BOTH", "malware", T0, "a"),
        alert("BOTH", "lateral", T0 + SEC, "b"), alert("BOTH", "lateral", T0 + 60 * SEC, "a_"[:1]))
    got = users(det.malware_lateral_movement(user_signals(iam(spark), alerts)))
    assert set(got) == {"SELF", "NULLS", "EDGE", "BOTH"}
    assert got["SELF"]["severity"] == "Critical" and got["SELF"]["related_hostname"] == "h1"
    assert got["NULLS"]["confidence"] == "Medium" and got["NULLS"]["related_hostname"] is None
    assert got["BOTH"]["last_observed"] == T0 + 60 * SEC and got["BOTH"]["related_hostname"] == "a"


def test_administrative_abuse_indicators(spark):
    events = iam(spark, {"user_id": "U", "event_id": "1", "timestamp": T0, "risk_score": 70.0, "hostname": "W"},
                 {"user_id": "V", "event_id": "2", "timestamp": T0, "risk_score": 69.9})
    alerts = endpoint(
        spark, {"user_id": "U", "alert_id": "1", "detected_timestamp": T0 - H24, "hostname": "w.corp.local",
                "alert_name": "Tamper", "process_name": "powershell.exe"},
        {"user_id": "V", "alert_id": "2", "detected_timestamp": T0, "alert_name": "tamper"})
    got = users(det.administrative_abuse(user_signals(events, alerts)))
    assert set(got) == {"U"} and "PowerShell and security-tampering" in got["U"]["evidence"]
    assert got["U"]["confidence"] == "High" and got["U"]["first_observed"] == T0 - H24
    compat = users(det.administrative_abuse(user_signals(events, alerts), compat=True))
    assert compat["U"]["confidence"] == "Medium"


def test_mismatch_counts_both_sources(spark):
    ident = identity(spark, {"user_id": "U", "hostname": "own"})
    events = iam(spark, {"user_id": "U", "event_id": "1", "hostname": "x"}, {"user_id": "U", "event_id": "2", "hostname": "own"},
                 {"user_id": "U", "event_id": "4", "hostname": "own"}, {"user_id": "V", "event_id": "3", "hostname": "y"})
    alerts = endpoint(spark, {"user_id": "U", "alert_id": "1", "hostname": "X.corp.local", "detected_timestamp": T0})
    rows = det.identity_hostname_mismatch(ident, user_signals(events, alerts)).collect()
    assert [(r["user_id"], r["related_hostname"], r["related_alert_count"], r["first_observed"]) for r in rows] == [
        ("U", "x", 2, T0)]


def test_numbering_is_global_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    rows = number_rows(df, [F.desc("g"), F.asc("v")], "n").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 5001))
    assert [(-r["g"], r["v"]) for r in rows] == sorted((-r["g"], r["v"]) for r in rows)


def test_ids_follow_rule_user_host(spark):
    ident = identity(spark, {"user_id": "U", "hostname": "own", "termination_date": T0 - H24})
    events = iam(spark, *[{"user_id": "U", "event_id": str(i), "hostname": f"h{i % 2}", "timestamp": T0}
                          for i in range(4)])
    found = det.with_threat_ids(det.detect(ident, user_signals(events, endpoint(spark))))
    assert sorted((r["threat_id"], r["threat_type"], r["related_hostname"]) for r in found.collect()) == [
        ("THR00001", "Post-Termination Activity", "h0"),
        ("THR00002", "Identity / Hostname Mismatch", "h0"),
        ("THR00003", "Identity / Hostname Mismatch", "h1")]


def test_credential_rule_against_brute_force(spark):
    """Random events; user U0 holds a third of them."""
    rng = random.Random(3)
    pick = lambda i: "U0" if i % 3 == 0 else f"U{rng.randrange(1, 5)}"
    moment = lambda: T0 + timedelta(seconds=rng.randrange(0, 12 * 86400, 1800))
    events = [{"user_id": pick(i), "event_id": str(i), "timestamp": moment() if rng.random() > 0.05 else None,
               "event_type": rng.choice(["LOGIN_FAILURE", "LOGIN_SUCCESS"]), "hostname": rng.choice(["A", "B", None]),
               "mfa_passed": rng.choice([True, False, None])} for i in range(240)]
    alerts = [{"user_id": pick(i), "alert_id": str(i), "detected_timestamp": moment(), "hostname": "e",
               "alert_name": rng.choice(["Keylogger", "Port scan"])} for i in range(60)]
    want = {}
    for anchor in sorted((e for e in events if e["timestamp"]), key=lambda e: e["timestamp"]):
        user, start = anchor["user_id"], anchor["timestamp"]
        if user in want:
            continue
        near = [e for e in events if e["user_id"] == user and e["timestamp"] and start <= e["timestamp"] <= start + H24]
        hits = [a for a in alerts if a["user_id"] == user and a["alert_name"] == "Keylogger"
                and start <= a["detected_timestamp"] <= start + H24]
        failed = sum(e["event_type"] == "LOGIN_FAILURE" for e in near)
        mfa = sum(e["mfa_passed"] is False for e in near)
        if failed >= 3 and mfa >= 2 and hits:
            last = max([e["timestamp"] for e in near] + [a["detected_timestamp"] for a in hits])
            named = sorted((e["timestamp"], e["hostname"].lower()) for e in near if e["hostname"])
            want[user] = (start, last, len(hits), named[0][1] if named else "e", f"{failed} failed", f", {mfa} MFA")
    got = users(det.credential_compromise(user_signals(iam(spark, *events), endpoint(spark, *alerts))))
    assert set(got) == set(want) and "U0" in want and len(want) > 2
    for user, (start, last, count, host, failed, mfa) in want.items():
        row = got[user]
        assert (row["first_observed"], row["last_observed"], row["related_alert_count"],
                row["related_hostname"]) == (start, last, count, host)
        assert row["evidence"].startswith(failed) and mfa in row["evidence"]


def test_credential_rule_is_linear(spark):
    """200,000 distinct seconds of one user: each event asks two running totals, not its whole window."""
    n = 200_000
    ids = spark.range(n)
    moment = (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
    flags = [F.lit(False).alias(f) for f in ("high_risk_flag", "malware_flag", "lateral_flag", "powershell_flag", "usb_flag", "tampering_flag")]
    events = ids.select(
        F.lit("U").alias("user_key"), (F.col("id") != n - 1).alias("is_iam"), F.unix_micros(moment.cast("timestamp")).alias("us"),
        F.lit("h").alias("hostname"), F.lit("h").alias("hostname_key"), F.lit("h").alias("hostname_key_compat"),
        F.lit("a").alias("alert_id"), (F.col("id") % 3 == 0).alias("failed_auth_flag"), (F.col("id") % 5 == 0).alias("mfa_failure_flag"),
        (F.col("id") == n - 1).alias("credential_flag"), *flags)
    began = time.monotonic()
    row = det.credential_compromise(events).collect()[0]
    assert time.monotonic() - began < 60
    start = n - 1 - 86_400
    assert row["first_observed"] == T0 + start * SEC and row["last_observed"] == T0 + (n - 1) * SEC
    failed = sum(i % 3 == 0 for i in range(start, n - 1))
    assert row["evidence"].startswith(f"{failed} failed") and row["related_alert_count"] == 1


def test_rules_read_the_signals_only(spark, tmp_path):
    """No rule goes back to the logs: one narrow table, each scan with its columns pruned."""
    user_signals(iam(spark), endpoint(spark)).write.parquet(f"{tmp_path}/signals")
    events = spark.read.parquet(f"{tmp_path}/signals")
    plan = det.detect(identity(spark), events)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("Relation [") <= 9
