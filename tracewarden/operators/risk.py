"""User risk: 0 to 100 from six capped, explainable components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import risk_key
from ..functions.text import as_flag
from ..schemas import RISK_COLUMNS
from .quality import two_decimals
from .signals import alert_flags, event_moments, iam_flags, identity_users, post_termination, termination_dates

BANDS = ("Low", "Medium", "High", "Critical")


def _flag_sum(flag: Column) -> Column:
    return F.sum(flag.cast("bigint"))


def iam_rollup(iam: DataFrame) -> DataFrame:
    flags = iam_flags()
    return (
        iam.withColumn("user_key", risk_key(F.col("user_id"))).where("user_key IS NOT NULL")
        .groupBy("user_key").agg(
            F.count("event_id").alias("iam_events"),
            _flag_sum(flags["failed_auth_flag"]).alias("iam_failed_auth"),
            _flag_sum(flags["mfa_failure_flag"]).alias("iam_mfa_failures"),
            _flag_sum(flags["high_risk_flag"]).alias("iam_high_risk_events"),
            F.avg("risk_score").alias("iam_avg_risk_score"),
            F.max("risk_score").alias("iam_max_risk_score"),
            F.countDistinct("hostname").alias("iam_hostname_count"),
            F.countDistinct("session_id").alias("iam_session_count"),
        )
    )


def endpoint_rollup(endpoint: DataFrame) -> DataFrame:
    severity = F.lower(F.coalesce(F.col("severity"), F.lit("")))
    critical = severity == "critical"
    c = F.col
    sums = {
        "endpoint_critical_alerts": critical,
        "endpoint_high_alerts": severity == "high",
        "endpoint_unresolved_critical": critical & as_flag(c("unresolved_alert_flag")),
        "endpoint_malware_alerts": c("malware_flag"),
        "endpoint_credential_alerts": c("credential_flag"),
        "endpoint_lateral_movement": c("lateral_flag"),
        "endpoint_powershell": c("powershell_flag"),
        "endpoint_tampering": c("tampering_flag"),
        "endpoint_usb": c("usb_flag"),
        "endpoint_impossible_resolution": as_flag(c("impossible_resolution_flag")),
    }
    return (
        alert_flags(endpoint).withColumn("user_key", risk_key(c("user_id")))
        .where("user_key IS NOT NULL").groupBy("user_key").agg(
            F.count("alert_id").alias("endpoint_alerts"),
            *[_flag_sum(flag).alias(name) for name, flag in sums.items()],
            F.countDistinct("hostname").alias("endpoint_hostname_count"),
        )
    )


def user_activity(identity: DataFrame, iam: DataFrame, endpoint: DataFrame) -> DataFrame:
    """One row per identity user with all counts; absent activity counts as zero."""
    after = post_termination(event_moments(iam, endpoint, risk_key), termination_dates(identity, risk_key)).select(
        "user_key",
        F.col("iam_events").alias("post_termination_iam_events"),
        F.col("endpoint_events").alias("post_termination_endpoint_events"),
    )
    joined = (
        identity_users(identity, risk_key)
        .join(iam_rollup(iam), "user_key", "left")
        .join(endpoint_rollup(endpoint), "user_key", "left")
        .join(after, "user_key", "left")
        .fillna(0)
    )
    total = F.col("post_termination_iam_events") + F.col("post_termination_endpoint_events")
    return joined.withColumns({
        "post_termination_activity": total, "post_termination_activity_flag": total > 0,
    })


def capped(count: str, weight: float, cap: float) -> Column:
    return F.least(F.col(count) * F.lit(float(weight)), F.lit(float(cap)))


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, float(points)).otherwise(0.0)


def with_components(activity: DataFrame) -> DataFrame:
    """The six components, each capped; every input is already zero-filled."""
    c = F.col
    failed, mfa, high = c("iam_failed_auth"), c("iam_mfa_failures"), c("iam_high_risk_events")
    malware = c("endpoint_malware_alerts") > 0
    cap = lambda value, top: F.least(value, F.lit(float(top)))
    parts = activity.withColumns({
        "authentication_risk": cap(
            capped("iam_failed_auth", 1, 10) + capped("iam_mfa_failures", 1.5, 10), 20),
        "iam_risk": cap(
            capped("iam_high_risk_events", 2, 15) + _points((failed >= 5) & (high >= 3), 5), 20),
        "endpoint_severity_risk": cap(
            capped("endpoint_critical_alerts", 5, 15) + capped("endpoint_high_alerts", 2, 5), 20),
        "threat_behavior_risk": cap(
            capped("endpoint_malware_alerts", 6, 12) + capped("endpoint_credential_alerts", 6, 8)
            + capped("endpoint_lateral_movement", 6, 8) + capped("endpoint_powershell", 3, 4)
            + capped("endpoint_tampering", 4, 5) + capped("endpoint_usb", 1, 2), 30),
        "contextual_risk": cap(
            capped("post_termination_activity", 3, 10)
            + capped("endpoint_unresolved_critical", 2, 5), 15),
    })
    return parts.withColumn("cross_signal_bonus", cap(
        _points((c("authentication_risk") >= 8) & (c("threat_behavior_risk") >= 6), 5)
        + _points(malware & (c("endpoint_credential_alerts") > 0), 5)
        + _points(malware & (c("endpoint_lateral_movement") > 0), 5)
        + _points((mfa >= 3) & (high >= 3), 3), 10))


def risk_band(score: Column) -> Column:
    """Bands are closed on the right."""
    return (F.when(score <= 24, "Low").when(score <= 49, "Medium")
            .when(score <= 74, "High").otherwise("Critical"))


def risk_drivers() -> Column:
    """Ordered evidence phrases."""
    c = F.col

    def number(name: str) -> Column:
        return c(name).cast("bigint").cast("string")

    def phrase(name: str, text: str) -> Column:
        return F.when(c(name) > 0, F.concat(number(name), F.lit(f" {text}")))

    elevated = F.concat(
        F.lit("elevated authentication risk ("), number("iam_failed_auth"), F.lit(" failed auth, "),
        number("iam_mfa_failures"), F.lit(" MFA failures)"),
    )
    text = F.concat_ws(
        "; ",
        F.when(c("authentication_risk") >= 8, elevated)
        .otherwise(phrase("iam_failed_auth", "failed authentication events")),
        phrase("iam_high_risk_events", "high-risk IAM events"),
        phrase("endpoint_malware_alerts", "malware alerts"),
        phrase("endpoint_credential_alerts", "credential-access alerts"),
        phrase("endpoint_lateral_movement", "lateral-movement alerts"),
        phrase("endpoint_powershell", "PowerShell alerts"),
        phrase("endpoint_tampering", "security-tampering alerts"),
        phrase("endpoint_critical_alerts", "critical endpoint alerts"),
        phrase("post_termination_activity", "events after identity termination"),
        phrase("endpoint_unresolved_critical", "unresolved critical alerts"),
    )
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("No high-priority risk drivers"))


def score_users(identity: DataFrame, iam: DataFrame, endpoint: DataFrame) -> DataFrame:
    c = F.col
    scored = with_components(user_activity(identity, iam, endpoint))
    total = (c("authentication_risk") + c("iam_risk") + c("endpoint_severity_risk")
             + c("threat_behavior_risk") + c("contextual_risk") + c("cross_signal_bonus"))
    scored = scored.withColumn("risk_score", F.least(total, F.lit(100.0)))
    return scored.withColumns({
        "user_id": c("user_key"),
        "iam_avg_risk_score": two_decimals(c("iam_avg_risk_score")),
        "iam_max_risk_score": two_decimals(c("iam_max_risk_score")),
        "risk_band": risk_band(c("risk_score")),
        "risk_level": risk_band(c("risk_score")),
        "risk_drivers": risk_drivers(),
    }).select(*RISK_COLUMNS)


def band_distribution(risk: DataFrame) -> DataFrame:
    """Users per band, empty bands included: one pass of four conditional counts."""
    counts = [F.count(F.when(F.col("risk_band") == band, 1)).alias(band) for band in BANDS]
    pairs = ", ".join(f"'{band}', `{band}`" for band in BANDS)
    return (
        risk.agg(F.count(F.lit(1)).alias("n"), *counts)
        .selectExpr("n", f"stack({len(BANDS)}, {pairs}) AS (risk_band, user_count)")
        .select("risk_band", "user_count",
                two_decimals(F.col("user_count") / F.nullif(F.col("n"), F.lit(0)) * 100)
                .alias("percentage"))
    )


def top_users(risk: DataFrame, n: int = 100) -> DataFrame:
    order = [F.desc("risk_score"), F.desc("endpoint_critical_alerts"), F.asc("user_id")]
    return risk.orderBy(*order).limit(n)
