"""Per-event facts shared by scoring and detection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import link_hostname, link_key
from ..functions.text import as_flag
from ..functions.timestamps import micros

# Text patterns over alert name, description and process name.
ALERT_PATTERNS = {
    "malware_flag": "malware|ransomware|trojan",
    "credential_flag": "credential|keylogger",
    "lateral_flag": "lateral|admin share",
    "powershell_flag": "powershell",
    "usb_flag": "usb",
    "tampering_flag": "disable security|tamper",
}
HIGH_RISK_SCORE = 70
DAY_MICROS = 86_400_000_000


def iam_flags() -> dict[str, Column]:
    event = F.lower(F.coalesce(F.col("event_type"), F.lit("")))
    reason = F.coalesce(F.col("failure_reason"), F.lit(""))
    return {
        "failed_auth_flag": event.rlike("fail|denied|reject") | (reason != ""),
        "mfa_failure_flag": as_flag(~F.col("mfa_passed")),
        "high_risk_flag": as_flag(F.col("risk_score") >= HIGH_RISK_SCORE),
    }


def alert_flags(endpoint: DataFrame) -> DataFrame:
    """Threat categories from the alert's text."""
    parts = [F.coalesce(F.col(n), F.lit("")) for n in ("alert_name", "description", "process_name")]
    text = endpoint.withColumn("_text", F.lower(F.concat_ws(" ", *parts)))
    flags = {name: F.col("_text").rlike(pattern) for name, pattern in ALERT_PATTERNS.items()}
    return text.withColumns(flags).drop("_text")


HOST_KEYS = {False: "hostname_key", True: "hostname_key_compat"}


def user_signals(iam: DataFrame, endpoint: DataFrame) -> DataFrame:
    """The events of both sources with what the rules ask of them, one narrow row per event.

    Texts are matched and keys are formed once, here; all rules read this one table. Flags of the
    other source are false. Rows are not dealt by user: a busy user's rows stay spread.
    """
    def rows(df: DataFrame, is_iam: bool, time: str, alert_id: Column, own: dict[str, Column]) -> DataFrame:
        names = ("failed_auth_flag", "mfa_failure_flag", "high_risk_flag", *ALERT_PATTERNS)
        return df.select(
            link_key(F.col("user_id")).alias("user_key"), F.lit(is_iam).alias("is_iam"),
            micros(F.col(time)).alias("us"), "hostname",
            *[link_hostname(F.col("hostname"), compat).alias(n) for compat, n in HOST_KEYS.items()],
            alert_id.cast("string").alias("alert_id"), *[own.get(n, F.lit(False)).alias(n) for n in names])

    return rows(iam, True, "timestamp", F.lit(None), iam_flags()).unionByName(
        rows(alert_flags(endpoint), False, "detected_timestamp", F.col("alert_id"),
             {n: F.col(n) for n in ALERT_PATTERNS}))


def identity_users(identity: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """One row per user: first non-null descriptive values, latest termination, asset counts.

    "First" is the smallest record by name, host, device and the remaining text columns.
    """
    order = F.struct(*[
        F.coalesce(F.col(n), F.lit("")).alias(n)
        for n in ("full_name", "hostname", "device_id", "role", "department", "status", "username")
    ])

    def first(name: str) -> Column:
        value = F.struct(order.alias("o"), F.col(name).alias("v"))
        return F.min(F.when(F.col(name).isNotNull(), value))["v"].alias(name)

    return (
        identity.withColumn("user_key", key(F.col("user_id")))
        .where("user_key IS NOT NULL").groupBy("user_key").agg(
            *[first(n) for n in ("username", "department", "role", "status")],
            F.countDistinct("hostname").alias("hostname_count"),
            F.countDistinct("device_id").alias("device_count"),
            F.max("termination_date").alias("termination_date"),
        )
    )


def termination_dates(identity: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    return (
        identity.select(key(F.col("user_id")).alias("user_key"), "termination_date")
        .dropna().groupBy("user_key").agg(F.max(micros(F.col("termination_date"))).alias("left_us"))
    )


def event_moments(iam: DataFrame, endpoint: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """User, source, time and host of the events of both sources."""
    def moments(df: DataFrame, time: str, is_iam: bool) -> DataFrame:
        return df.select(key(F.col("user_id")).alias("user_key"), micros(F.col(time)).alias("us"),
                         F.col("hostname"), F.lit(is_iam).alias("is_iam"))

    return moments(iam, "timestamp", True).unionByName(moments(endpoint, "detected_timestamp", False))


def post_termination(events: DataFrame, dates: DataFrame) -> DataFrame:
    """Activity strictly after a user's last termination date, one row per affected user.

    ``events`` has user_key, us, hostname and is_iam, ``dates`` one row per former user. The few
    dates meet the events first, so events of current users are never grouped. What is left is
    collapsed by user, source and day with a map-side combine before it is added up per user, so a
    busy former user is a row per day by then.
    """
    is_iam, host = F.col("is_iam"), F.col("hostname")
    late = (events.where("user_key IS NOT NULL AND us IS NOT NULL")
            .join(dates, "user_key").where("us > left_us"))
    at = F.struct((~is_iam).alias("source_order"), F.col("us"), host.alias("hostname"))
    days = late.withColumn("day", F.floor(F.col("us") / DAY_MICROS)).groupBy("user_key", "is_iam", "day").agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"),
        F.min(F.when(host.isNotNull(), at)).alias("at"))
    return days.groupBy("user_key").agg(
        F.coalesce(F.sum(F.when(is_iam, F.col("n"))), F.lit(0)).alias("iam_events"),
        F.coalesce(F.sum(F.when(~is_iam, F.col("n"))), F.lit(0)).alias("endpoint_events"),
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"),
        F.min("at")["hostname"].alias("hostname"))


def at_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")
