"""The five threat rules and the published detection table.

The rules read the narrow events of ``signals.user_signals``, published once, instead of the logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import link_hostname, link_key
from ..schemas import DETECTION_COLUMNS
from .nearest import closest_pairs
from .ranking import number_rows
from .signals import HOST_KEYS, at_micros, post_termination, termination_dates

HOUR_MICROS = 3_600_000_000


def _detection(
    df: DataFrame, rule: int, threat_type: str, severity: Column | str, confidence: Column | str,
    evidence: Column, first_us: Column, last_us: Column, hostname: Column, count: Column,
    action: Column | str,
) -> DataFrame:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        F.lit(rule).alias("rule"), F.col("user_key").alias("user_id"),
        F.lit(threat_type).alias("threat_type"), as_column(severity).alias("severity"),
        as_column(confidence).alias("confidence"), evidence.alias("evidence"),
        at_micros(first_us).alias("first_observed"), at_micros(last_us).alias("last_observed"),
        hostname.alias("related_hostname"), count.cast("bigint").alias("related_alert_count"),
        as_column(action).alias("recommended_action"),
    )


def post_termination_activity(identity: DataFrame, events: DataFrame) -> DataFrame:
    after = post_termination(events, termination_dates(identity, link_key))
    n_iam, n_end = F.col("iam_events"), F.col("endpoint_events")
    both = (n_iam > 0) & (n_end > 0)
    parts = F.concat_ws(
        " and ",
        F.when(n_iam > 0, F.concat(n_iam.cast("string"), F.lit(" IAM"))),
        F.when(n_end > 0, F.concat(n_end.cast("string"), F.lit(" endpoint"))),
    )
    evidence = F.concat(
        parts, F.lit(" events occurred after the recorded termination date"),
        F.when(both, "; corroborated across IAM and endpoint telemetry").otherwise(""),
    )
    action = F.when(
        both, "Immediately review account status and both IAM and endpoint activity; "
              "revoke unauthorized access if confirmed",
    ).otherwise("Review post-termination telemetry, account status, and access authorization")
    return _detection(
        after, 1, "Post-Termination Activity", "Critical",
        F.when(both, "High").otherwise("Medium"), evidence, F.col("first_us"), F.col("last_us"),
        F.col("hostname"), n_iam + n_end, action,
    )


def credential_compromise(events: DataFrame, window_hours: int = 24, compat: bool = False) -> DataFrame:
    """Failed and MFA-failed sign-ins with a credential alert in the window after an IAM event.

    The user's earliest qualifying event reports. Events are first collapsed to (user, time) and
    cut into window-long slices of a user, so that the window of an anchor is the rest of its own slice
    and the beginning of the next one. Two points of an anchor read running totals: its own time in its slice,
    where the total of the slice less what came before is in the window, and its end in the next
    slice. So the work is linear in the events of a slice, and a busy user is spread over its slices.
    Hosts are fetched for the reporting events only.
    """
    span = window_hours * HOUR_MICROS
    c = F.col
    signs = events.where("user_key IS NOT NULL AND us IS NOT NULL").where("is_iam OR credential_flag").select(
        "user_key", "us", "is_iam", c(HOST_KEYS[compat]).alias("host"),
        (c("is_iam") & c("failed_auth_flag")).cast("int").alias("failed"),
        (c("is_iam") & c("mfa_failure_flag")).cast("int").alias("mfa"), (~c("is_iam")).cast("int").alias("alerts"))
    # a user without any credential alert cannot qualify
    seen = signs.join(signs.where("NOT is_iam").select("user_key").distinct(), "user_key", "left_semi")
    sums = ("failed", "mfa", "alerts")
    moments = seen.groupBy("user_key", "us").agg(
        F.max("is_iam").alias("anchor"), *[F.sum(n).alias(n) for n in sums])
    slice_of = F.floor(c("us") / span)
    zero = F.lit(0).cast("bigint")
    start = F.struct(slice_of.alias("slice"), c("us").alias("at"), F.lit(0).alias("turn"), *sums)
    end = F.struct((slice_of + 1).alias("slice"), (c("us") + span).alias("at"), F.lit(1).alias("turn"), *[zero.alias(n) for n in sums])
    turns = moments.select("user_key", c("us").alias("anchor_us"), "anchor", F.inline(
        F.filter(F.array(start, F.when(c("anchor"), end)), lambda p: p.isNotNull())))
    whole = Window.partitionBy("user_key", "slice")
    running = whole.orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_start = c("turn") == 0
    event_us = F.when(is_start, c("at"))
    points = turns.select(
        "user_key", "anchor_us", "anchor",
        *[F.when(is_start, F.sum(n).over(whole) - F.sum(n).over(running) + c(n)).otherwise(F.sum(n).over(running)).alias(n)
          for n in sums],
        F.when(is_start, F.max(event_us).over(whole)).otherwise(F.max(event_us).over(running)).alias("last_us"))
    first = (
        points.where("anchor").groupBy("user_key", "anchor_us").agg(
            *[F.sum(n).alias(f"{n}_in") for n in sums], F.max("last_us").alias("last_us"))
        .where("failed_in >= 3 AND mfa_in >= 2 AND alerts_in >= 1")
        .groupBy("user_key").agg(F.min(F.struct(
            c("anchor_us").alias("us"), "failed_in", "mfa_in", "alerts_in", "last_us")).alias("hit"))
        .select("user_key", "hit.*")
    )
    named = signs.where("host IS NOT NULL").select("user_key", c("us").alias("seen_us"), "is_iam", "host")
    inside = (named["user_key"] == first["user_key"]) & c("seen_us").between(c("us"), c("us") + span)
    place = F.struct("seen_us", "host")
    first = first.join(named, inside, "left").groupBy(first["user_key"], *first.columns[1:]).agg(
        F.min(F.when(c("is_iam"), place)).alias("iam_host"), F.min(F.when(~c("is_iam"), place)).alias("alert_host")
    ).withColumn("host", F.coalesce("iam_host.host", "alert_host.host"))
    evidence = F.concat(
        c("failed_in").cast("string"), F.lit(" failed authentication events, "),
        c("mfa_in").cast("string"), F.lit(" MFA failures, and "), c("alerts_in").cast("string"),
        F.lit(f" credential-access endpoint alerts within {window_hours} hours"),
    )
    return _detection(
        first, 2, "Potential Credential Compromise", "High", "High", evidence, c("us"),
        c("last_us"), c("host"), c("alerts_in"),
        "Investigate the authentication sequence, MFA failures, and credential-access activity",
    )


def closest_by_host_then_user(
    events: DataFrame, is_left: Column, is_right: Column, right_info: Column | None,
    window_hours: int, host_key: str = "hostname_key",
) -> DataFrame:
    """Per user the closest pair on one host within the window, else the closest pair at all.

    ``host`` is null for a pair that only shares the user.
    """
    usable = events.where("user_key IS NOT NULL")
    limit = window_hours * HOUR_MICROS

    def closest(keys: list[str], df: DataFrame) -> DataFrame:
        return closest_pairs(df, keys, F.col("us"), is_left, is_right, right_info, limit)

    same_host = (
        closest(["user_key", host_key], usable.where(F.col(host_key).isNotNull()))
        .groupBy("user_key").agg(F.min(F.struct(
            "gap_us", "left_us", "right_us", F.col(host_key).alias("host"), "right_info",
        )).alias("on_host"))
    )
    any_host = closest(["user_key"], usable).select("user_key", F.struct(
        "gap_us", "left_us", "right_us", F.lit(None).cast("string").alias("host"), "right_info",
    ).alias("anywhere"))
    # every user with a same-host pair also has a pair at all
    return any_host.join(same_host, "user_key", "left").select(
        "user_key", F.coalesce("on_host", "anywhere").alias("pair")
    ).select("user_key", "pair.*")


def malware_lateral_movement(events: DataFrame, window_hours: int = 24, compat: bool = False) -> DataFrame:
    pairs = closest_by_host_then_user(
        events.where("malware_flag OR lateral_flag"), F.col("malware_flag"), F.col("lateral_flag"), None,
        window_hours, HOST_KEYS[compat],
    )
    c, on_host = F.col, F.col("host").isNotNull()
    within = f"within {window_hours} hours"
    evidence = F.when(on_host, F.concat(
        F.lit("Malware and lateral-movement alerts were observed on the same hostname ("),
        c("host"), F.lit(f") {within}"),
    )).otherwise(
        f"Malware and lateral-movement alerts were observed for the same user {within}, "
        "but same-host corroboration was unavailable"
    )
    action = F.when(
        on_host,
        "Isolate the affected endpoint and investigate lateral-movement indicators immediately",
    ).otherwise("Review endpoint telemetry and validate the affected asset before escalation")
    return _detection(
        pairs, 3, "Malware + Lateral Movement", F.when(on_host, "Critical").otherwise("High"),
        F.when(on_host, "High").otherwise("Medium"), evidence,
        F.least("left_us", "right_us"), F.greatest("left_us", "right_us"), c("host"), F.lit(2), action,
    )


# PowerShell or tampering alerts, which pair with high-risk IAM events
ADMINISTRATIVE = "powershell_flag OR tampering_flag"


def administrative_abuse(events: DataFrame, window_hours: int = 24, compat: bool = False) -> DataFrame:
    info = F.struct("alert_id", "powershell_flag", "tampering_flag")
    is_left, is_right = F.col("high_risk_flag"), F.expr(ADMINISTRATIVE)
    pairs = closest_by_host_then_user(
        events.where(is_left | is_right), is_left, is_right, info,
        window_hours, HOST_KEYS[compat],
    )
    c, on_host = F.col, F.col("host").isNotNull()
    indicators = F.concat_ws(
        " and ", F.when(c("right_info.powershell_flag"), "PowerShell"),
        F.when(c("right_info.tampering_flag"), "security-tampering"),
    )
    place = F.when(on_host, F.concat(
        F.lit("on the same hostname ("), c("host"), F.lit(f") within {window_hours} hours")
    )).otherwise(
        f"for the same user within {window_hours} hours, but same-host corroboration was unavailable"
    )
    evidence = F.concat(
        F.lit("A high-risk IAM event and "), indicators, F.lit(" activity were observed "), place
    )
    action = F.concat(
        F.lit("Review the administrative command/process activity and "),
        F.when(on_host, "associated account actions")
        .otherwise("validate the associated account actions"),
    )
    return _detection(
        pairs, 4, "Suspicious Administrative Activity", "High",
        F.when(on_host, "High").otherwise("Medium"), evidence,
        F.least("left_us", "right_us"), F.greatest("left_us", "right_us"), c("host"), F.lit(2), action,
    )


def identity_hostname_mismatch(identity: DataFrame, events: DataFrame, compat: bool = False) -> DataFrame:
    """(user, host) pairs seen at least twice that the identity master does not list.

    Events are counted per pair before the anti join, so the join sees each pair once.
    """
    pair = ["user_key", "hostname_key"]
    known = identity.select(
        link_key(F.col("user_id")).alias("user_key"),
        link_hostname(F.col("hostname"), compat).alias("hostname_key"),
    ).dropna().distinct()
    counted = (
        events.select("user_key", F.col(HOST_KEYS[compat]).alias("hostname_key"), "us")
        .where("user_key IS NOT NULL AND hostname_key IS NOT NULL")
        .groupBy(*pair).agg(
            F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
        .where("n >= 2")
        .join(known, pair, "left_anti")
    )
    evidence = F.concat(
        F.col("n").cast("string"), F.lit(" telemetry events observed on hostname "),
        F.col("hostname_key"),
        F.lit(", which is not assigned to this user in the identity master"),
    )
    return _detection(
        counted, 5, "Identity / Hostname Mismatch", "Medium", "Medium", evidence,
        F.col("first_us"), F.col("last_us"), F.col("hostname_key"), F.col("n"),
        "Verify asset ownership, account sharing, and recent device changes",
    )


def detect(identity: DataFrame, events: DataFrame, window_hours: int = 24, compat: bool = False) -> DataFrame:
    """All rules over the signals, without ids; ``rule`` is the rule's place in the fixed order."""
    rules = [
        post_termination_activity(identity, events),
        credential_compromise(events, window_hours, compat),
        malware_lateral_movement(events, window_hours, compat),
        administrative_abuse(events, window_hours, compat),
        identity_hostname_mismatch(identity, events, compat),
    ]
    result = rules[0]
    for rule in rules[1:]:
        result = result.unionByName(rule)
    return result


def with_threat_ids(detections: DataFrame) -> DataFrame:
    """THR00001.. by rule, user and host; numbering happens before the final sort."""
    order = [F.asc("rule"), F.asc("user_id"), F.asc_nulls_first("related_hostname")]
    numbered = number_rows(detections, order, "number")
    return numbered.select(
        F.format_string("THR%05d", F.col("number")).alias("threat_id"), *DETECTION_COLUMNS
    )


def sorted_detections(detections: DataFrame) -> DataFrame:
    return detections.orderBy("severity", "confidence", "threat_type", "threat_id")


def type_summary(detections: DataFrame, column: str = "threat_type") -> DataFrame:
    return (
        detections.groupBy(column).agg(F.count(F.lit(1)).alias("detection_count"))
        .orderBy(F.desc("detection_count"), column)
    )


def affected_users(detections: DataFrame) -> DataFrame:
    return detections.agg(
        F.count(F.lit(1)).alias("detections"), F.countDistinct("user_id").alias("affected_users")
    )


