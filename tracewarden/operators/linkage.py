"""How far each cross-source key can be trusted, measured before joining on it.

Telemetry is counted per key (map-side combine) before it meets the identity keys, so a key
that fills a third of a source is one row in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import link_hostname, link_key
from ..functions.timestamps import micros
from .nearest import closest_pairs
from .pair_median import median_gaps
from .quality import two_decimals

REPORT_COLUMNS = (
    "source", "relationship", "relationship_status", "rows", "matched", "missing", "unmatched",
    "match_rate_pct", "usable_pairs", "consistent_pairs", "inconsistent_pairs",
    "consistency_rate_pct",
)
HOUR_SECONDS = 3600
# Session ids are an observed relationship, never a trusted join key.
SESSION_STATUS = "Weak / Rejected"
SESSION_DECISION = "Rejected"


def identity_keys(identity: DataFrame, compat: bool = False) -> DataFrame:
    return identity.select(
        link_key(F.col("user_id")).alias("user_key"),
        link_hostname(F.col("hostname"), compat).alias("hostname_join_key"),
        link_key(F.col("device_id")).alias("device_key"),
    )


def ambiguous_keys(keys: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one user, most users first."""
    return (
        keys.where(F.col(key).isNotNull() & F.col("user_key").isNotNull())
        .groupBy(key).agg(F.countDistinct("user_key").alias("distinct_user_count"))
        .where("distinct_user_count > 1")
        .orderBy(F.desc("distinct_user_count"), key)
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def strength(rate: Column) -> Column:
    return F.when(rate >= 90, "Strong").when(rate >= 75, "Moderate").otherwise("Weak")


def key_coverage(
    name: str, relationship: str, source: DataFrame, key: Column, known: DataFrame
) -> DataFrame:
    """``known``: one column of identity keys. One report row."""
    counted = source.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    reference = known.toDF("key").where("key IS NOT NULL").distinct().withColumn("found", F.lit(True))
    n, has_key = F.col("n"), F.col("key").isNotNull()
    found = has_key & F.coalesce(F.col("found"), F.lit(False))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    totals = counted.join(reference, "key", "left").agg(
        total(F.lit(True)).alias("rows"), total(found).alias("matched"),
        total(~has_key).alias("missing"), total(has_key & ~found).alias("unmatched"),
    )
    rate = _rate(F.col("matched"), F.col("rows") - F.col("missing"))
    return totals.select(
        F.lit(name).alias("source"), F.lit(relationship).alias("relationship"),
        strength(rate).alias("relationship_status"), "rows", "matched", "missing", "unmatched",
        two_decimals(rate).alias("match_rate_pct"),
    )


def pair_consistency(
    name: str, source: DataFrame, identity: DataFrame, compat: bool = False
) -> DataFrame:
    """Does the (user, host) pair of a row exist in the identity master? One report row."""
    counted = source.groupBy(
        link_key(F.col("user_id")).alias("user_key"),
        link_hostname(F.col("hostname"), compat).alias("hostname_join_key"),
    ).agg(F.count(F.lit(1)).alias("n"))
    pair = ["user_key", "hostname_join_key"]
    known = identity_keys(identity, compat).select(*pair).dropna().distinct()
    known = known.withColumn("found", F.lit(True))
    n = F.col("n")
    usable = F.col("user_key").isNotNull() & F.col("hostname_join_key").isNotNull()
    totals = counted.join(known, pair, "left").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(usable, n)), F.lit(0)).alias("usable_pairs"),
        F.coalesce(F.sum(F.when(F.col("found"), n)), F.lit(0)).alias("consistent_pairs"),
    )
    rate = _rate(F.col("consistent_pairs"), F.col("usable_pairs"))
    return totals.select(
        F.lit(name).alias("source"),
        F.lit("user_id + hostname -> identity").alias("relationship"),
        strength(rate).alias("relationship_status"), "rows", "usable_pairs", "consistent_pairs",
        (F.col("usable_pairs") - F.col("consistent_pairs")).alias("inconsistent_pairs"),
        two_decimals(rate).alias("consistency_rate_pct"),
    )


def device_coverage(name: str, source: DataFrame, known: DataFrame) -> DataFrame | None:
    """None for a source without a device column: no artificial zero-match row."""
    if "device_id" not in source.columns:
        return None
    return key_coverage(name, "device_id -> identity", source, link_key(F.col("device_id")), known)


def relationship_report(
    identity: DataFrame, iam: DataFrame, endpoint: DataFrame, firewall: DataFrame,
    compat: bool = False,
) -> DataFrame:
    keys = identity_keys(identity, compat)
    users, hosts = keys.select("user_key"), keys.select("hostname_join_key")

    def user(name: str, source: DataFrame) -> DataFrame:
        return key_coverage(name, "user_id -> identity", source, link_key(F.col("user_id")), users)

    def host(name: str, source: DataFrame) -> DataFrame:
        column = "hostname_join_key" if "hostname_join_key" in source.columns else "hostname"
        key = link_hostname(F.col(column), compat)
        return key_coverage(name, "hostname -> identity", source, key, hosts)

    parts = [
        user("IAM", iam), host("IAM", iam),
        device_coverage("IAM", iam, keys.select("device_key")),
        pair_consistency("IAM", iam, identity, compat),
        user("Endpoint", endpoint), host("Endpoint", endpoint),
        device_coverage("Endpoint", endpoint, keys.select("device_key")),
        pair_consistency("Endpoint", endpoint, identity, compat),
        host("Firewall", firewall),
    ]
    present = [part for part in parts if part is not None]
    report = present[0]
    for part in present[1:]:
        report = report.unionByName(part, allowMissingColumns=True)
    return report.select(*REPORT_COLUMNS)


# --- sessions ---------------------------------------------------------------------------

def session_overlap(iam: DataFrame, firewall: DataFrame) -> DataFrame:
    """Exact session-id overlap of the two sources, one row."""
    def side(df: DataFrame, flag: str) -> DataFrame:
        key = link_key(F.col("session_id")).alias("session_key")
        return df.select(key).where("session_key IS NOT NULL").distinct().withColumn(flag, F.lit(1))

    both = side(iam, "in_iam").join(side(firewall, "in_firewall"), "session_key", "full")
    counts = both.agg(
        F.count("in_iam").alias("iam_unique_sessions"),
        F.count("in_firewall").alias("firewall_unique_sessions"),
        F.count(F.when(F.col("in_iam").isNotNull() & F.col("in_firewall").isNotNull(), 1))
        .alias("shared_session_ids"),
    )
    shared = F.col("shared_session_ids")
    return counts.select(
        F.lit("IAM session_id <-> Firewall session_id").alias("relationship"),
        F.lit(SESSION_STATUS).alias("relationship_status"),
        "iam_unique_sessions", "firewall_unique_sessions", "shared_session_ids",
        (F.col("iam_unique_sessions") - shared).alias("iam_only_sessions"),
        (F.col("firewall_unique_sessions") - shared).alias("firewall_only_sessions"),
        two_decimals(_rate(shared, F.col("iam_unique_sessions"))).alias("session_match_rate_iam_pct"),
        two_decimals(_rate(shared, F.col("firewall_unique_sessions")))
        .alias("session_match_rate_firewall_pct"),
    )


def session_events(iam: DataFrame, firewall: DataFrame, compat: bool = False) -> DataFrame:
    """Both sources as (session, host, time, side) rows."""
    def side(df: DataFrame, is_iam: bool) -> DataFrame:
        return df.select(
            link_key(F.col("session_id")).alias("session_id"),
            link_hostname(F.col("hostname"), compat).alias("host"),
            micros(F.col("timestamp")).alias("us"), F.lit(is_iam).alias("is_iam"),
        ).where("session_id IS NOT NULL")

    return side(iam, True).unionByName(side(firewall, False))


def _shared_only(per_session: DataFrame) -> DataFrame:
    return per_session.where("iam_rows > 0 AND firewall_rows > 0")


def _session_hosts(events: DataFrame) -> DataFrame:
    """Distinct hosts per session with the side(s) that saw them."""
    return (
        events.where("host IS NOT NULL").groupBy("session_id", "host")
        .agg(F.max("is_iam").alias("by_iam"), F.max(~F.col("is_iam")).alias("by_firewall"))
    )


def shared_session_evidence(iam: DataFrame, firewall: DataFrame, compat: bool = False) -> DataFrame:
    """Per shared session: rows on both sides, host overlap and the closest event pair."""
    return evidence_of_events(session_events(iam, firewall, compat))


def evidence_of_events(events: DataFrame) -> DataFrame:
    """``shared_session_evidence`` from the rows of ``session_events``."""
    is_iam = F.col("is_iam")
    sizes = _shared_only(events.groupBy("session_id").agg(
        F.count(F.when(is_iam, 1)).alias("iam_rows"),
        F.count(F.when(~is_iam, 1)).alias("firewall_rows"),
    ))
    overlap = _session_hosts(events).where("by_iam AND by_firewall").select("session_id").distinct()
    closest = closest_pairs(events, ["session_id"], F.col("us"), is_iam, ~is_iam)
    seconds = F.col("gap_us") / 1_000_000
    return (
        sizes.join(overlap.withColumn("hostname_overlap", F.lit(True)), "session_id", "left")
        .join(closest, "session_id", "left")
        .select(
            "session_id", "iam_rows", "firewall_rows",
            F.coalesce(F.col("hostname_overlap"), F.lit(False)).alias("hostname_overlap"),
            F.col("gap_us").isNotNull().alias("timestamp_evidence"),
            seconds.alias("min_time_difference_seconds"),
            F.coalesce(seconds <= HOUR_SECONDS, F.lit(False)).alias("within_60_minutes"),
        )
    )


def session_evidence_summary(evidence: DataFrame) -> DataFrame:
    def rows(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    hosts, times = F.col("hostname_overlap"), F.col("timestamp_evidence")
    return evidence.agg(
        F.count(F.lit(1)).alias("shared_sessions_checked"),
        rows(hosts).alias("hostname_consistent_sessions"),
        # no common host although times could be compared; then neither host nor time evidence
        rows(~hosts & times).alias("hostname_inconsistent_sessions"),
        rows(~hosts & ~times).alias("sessions_without_hostname_evidence"),
        rows(F.col("within_60_minutes")).alias("timestamp_within_60_minutes"),
    ).withColumn("session_join_decision", F.lit(SESSION_DECISION))


def shared_session_diagnostic(iam: DataFrame, firewall: DataFrame, compat: bool = False) -> DataFrame:
    """Per shared session: counts of rows, hosts and times; nearest, median and farthest pair.

    The farthest pair needs only each side's first and last time. Host names are in
    ``shared_session_hosts``, one row each, because a session may touch any number of hosts.
    """
    return diagnostic_of_events(session_events(iam, firewall, compat))


def diagnostic_of_events(events: DataFrame) -> DataFrame:
    """``shared_session_diagnostic`` from the rows of ``session_events``."""
    is_iam, us = F.col("is_iam"), F.col("us")
    sizes = _shared_only(events.groupBy("session_id").agg(
        F.count(F.when(is_iam, 1)).alias("iam_rows"),
        F.count(F.when(~is_iam, 1)).alias("firewall_rows"),
        F.count(F.when(is_iam, us)).alias("iam_timestamp_count"),
        F.count(F.when(~is_iam, us)).alias("firewall_timestamp_count"),
        F.greatest(
            F.max(F.when(is_iam, us)) - F.min(F.when(~is_iam, us)),
            F.max(F.when(~is_iam, us)) - F.min(F.when(is_iam, us)),
        ).alias("farthest_us"),
    ))
    hosts = _session_hosts(events).groupBy("session_id").agg(
        F.count(F.when(F.col("by_iam"), 1)).alias("iam_hosts"),
        F.count(F.when(F.col("by_firewall"), 1)).alias("firewall_hosts"),
        F.count(F.when(F.col("by_iam") & F.col("by_firewall"), 1)).alias("common_hosts"),
    )
    closest = closest_pairs(events, ["session_id"], us, is_iam, ~is_iam)
    median = median_gaps(
        events.join(sizes.select("session_id"), "session_id", "left_semi"), ["session_id"], us,
        is_iam, ~is_iam)
    count = lambda n: F.coalesce(F.col(n), F.lit(0))
    return (
        sizes.join(hosts, "session_id", "left").join(closest, "session_id", "left")
        .join(median, "session_id", "left").select(
            "session_id", "iam_rows", "firewall_rows",
            count("iam_hosts").alias("iam_hostname_count"),
            count("firewall_hosts").alias("firewall_hostname_count"),
            count("common_hosts").alias("common_hostname_count"),
            "iam_timestamp_count", "firewall_timestamp_count",
            (F.col("gap_us") / 1_000_000).alias("min_time_diff_seconds"),
            (F.col("median_us") / 1_000_000).alias("median_time_diff_seconds"),
            F.when(F.col("gap_us").isNotNull(), F.col("farthest_us") / 1_000_000)
            .alias("max_time_diff_seconds"),
            (count("common_hosts") > 0).alias("hostname_match"),
        )
    )


def shared_session_hosts(iam: DataFrame, firewall: DataFrame, compat: bool = False) -> DataFrame:
    """The hosts of every shared session and which side saw them."""
    return hosts_of_events(session_events(iam, firewall, compat))


def hosts_of_events(events: DataFrame) -> DataFrame:
    """``shared_session_hosts`` from the rows of ``session_events``."""
    sizes = _shared_only(events.groupBy("session_id").agg(
        F.count(F.when(F.col("is_iam"), 1)).alias("iam_rows"),
        F.count(F.when(~F.col("is_iam"), 1)).alias("firewall_rows"),
    ))
    return _session_hosts(events).join(sizes.select("session_id"), "session_id", "left_semi")
