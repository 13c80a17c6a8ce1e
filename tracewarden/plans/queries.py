"""Registered queries: name -> callable(spark, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import risk_key
from ..operators import (
    dedupe,
    detections,
    investigate,
    linkage,
    quality,
    queue,
    risk,
    signals,
    summary,
)
from ..operators.cleaning import clean
from ..operators.nearest import closest_pairs
from ..schemas import RAW_COLUMNS
from .feed import Feed, portable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Feed], DataFrame]) -> Callable[[Feed], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: portable(build(Feed(spark, sf_dir)))
    return build


# --- cleaning -------------------------------------------------------------------------

@query
def clean_identity(t: Feed) -> DataFrame:
    return clean("identity", t.raw("identity"))


@query
def clean_iam(t: Feed) -> DataFrame:
    return clean("iam", t.raw("iam"))


@query
def clean_endpoint(t: Feed) -> DataFrame:
    return clean("endpoint", t.raw("endpoint"))


@query
def clean_firewall(t: Feed) -> DataFrame:
    numbers = ("src_port", "dst_port", "bytes_sent", "bytes_received")
    table = clean("firewall", t.raw("firewall"))
    return table.withColumns({n: F.col(n).cast("string") for n in numbers})


# --- duplicates -------------------------------------------------------------------------

def _per_table(t: Feed, build: Callable[[str], DataFrame]) -> DataFrame:
    parts = [build(table).select(F.lit(table).alias("source"), "*") for table in RAW_COLUMNS]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def exact_duplicates(t: Feed) -> DataFrame:
    return _per_table(t, lambda table: dedupe.duplicate_summary(t.raw(table)))


@query
def raw_table_profile(t: Feed) -> DataFrame:
    return _per_table(t, lambda table: quality.raw_profile(t.raw(table)))


_KEYS = {"identity": "user_id", "iam": "event_id", "endpoint": "alert_id", "firewall": "log_id"}


@query
def duplicate_keys(t: Feed) -> DataFrame:
    return _per_table(t, lambda table: dedupe.duplicate_key_summary(t.raw(table), _KEYS[table]))


@query
def conflicting_alert_ids(t: Feed) -> DataFrame:
    rows = dedupe.distinct_with_copies(t.raw("endpoint"))
    return dedupe.key_evidence(rows, "alert_id").where("key_conflicts").select("alert_id")


@query
def first_identity_per_user(t: Feed) -> DataFrame:
    return dedupe.first_per_key(t.identity, "user_id")


@query
def firewall_id_integrity(t: Feed) -> DataFrame:
    return quality.id_integrity(t.firewall, "log_id")


# --- quality reports ----------------------------------------------------------------------

@query
def identity_quality_report(t: Feed) -> DataFrame:
    return quality.column_profile(t.identity)


@query
def iam_quality_report(t: Feed) -> DataFrame:
    return quality.column_profile(t.iam)


@query
def endpoint_quality_report(t: Feed) -> DataFrame:
    return quality.column_profile(t.endpoint)


@query
def firewall_quality_report(t: Feed) -> DataFrame:
    return quality.column_profile(t.firewall, list(RAW_COLUMNS["firewall"]))


@query
def identity_pipeline_summary(t: Feed) -> DataFrame:
    return quality.identity_summary(t.stage("identity"))


@query
def iam_pipeline_summary(t: Feed) -> DataFrame:
    raw = t.raw("iam")
    return quality.iam_summary(t.stage("iam"), len(raw.columns))


@query
def endpoint_pipeline_summary(t: Feed) -> DataFrame:
    return quality.endpoint_summary(t.stage("endpoint"))


@query
def firewall_pipeline_summary(t: Feed) -> DataFrame:
    return quality.firewall_summary(t.stage("firewall"))


@query
def device_conflict_summary(t: Feed) -> DataFrame:
    identity = quality.device_conflicts(t.identity).select(F.lit("identity").alias("source"), "*")
    return identity.unionByName(quality.device_conflicts(t.iam).select(F.lit("iam").alias("source"), "*"))


@query
def endpoint_domain_violations(t: Feed) -> DataFrame:
    return quality.domain_violations(t.endpoint)


@query
def iam_value_ranges(t: Feed) -> DataFrame:
    return quality.value_ranges(t.iam)


@query
def firewall_value_counts(t: Feed) -> DataFrame:
    return quality.value_counts(t.firewall, ["protocol", "action", "geo_country"])


# --- linkage ----------------------------------------------------------------------------

def _linkage_report(t: Feed, compat: bool) -> DataFrame:
    sources = [t.narrow(table, "links") for table in ("iam", "endpoint", "firewall")]
    report = linkage.relationship_report(t.identity, *sources, compat)
    counts = ("matched", "missing", "unmatched", "usable_pairs", "consistent_pairs", "inconsistent_pairs")
    return report.withColumns({n: F.col(n).cast("string") for n in counts})


@query
def relationship_quality_report(t: Feed) -> DataFrame:
    return _linkage_report(t, compat=False)


@query
def relationship_quality_report_compat(t: Feed) -> DataFrame:
    return _linkage_report(t, compat=True)


@query
def ambiguous_hostnames(t: Feed) -> DataFrame:
    return linkage.ambiguous_keys(linkage.identity_keys(t.identity), "hostname_join_key")


@query
def ambiguous_devices(t: Feed) -> DataFrame:
    return linkage.ambiguous_keys(linkage.identity_keys(t.identity), "device_key")


@query
def session_relationship_report(t: Feed) -> DataFrame:
    return linkage.session_overlap(t.iam, t.firewall)


@query
def shared_session_evidence(t: Feed) -> DataFrame:
    return linkage.evidence_of_events(t.session_events)


@query
def session_hostname_consistency_report(t: Feed) -> DataFrame:
    return linkage.session_evidence_summary(linkage.evidence_of_events(t.session_events))


@query
def shared_session_diagnostic(t: Feed) -> DataFrame:
    return linkage.diagnostic_of_events(t.session_events)


@query
def shared_session_hosts(t: Feed) -> DataFrame:
    return linkage.hosts_of_events(t.session_events)


# --- user risk ----------------------------------------------------------------------------

@query
def identity_user_rollup(t: Feed) -> DataFrame:
    return signals.identity_users(t.identity, risk_key)


@query
def iam_user_rollup(t: Feed) -> DataFrame:
    return risk.iam_rollup(t.iam).withColumn(
        "iam_avg_risk_score", quality.two_decimals(F.col("iam_avg_risk_score")))


@query
def endpoint_user_rollup(t: Feed) -> DataFrame:
    return risk.endpoint_rollup(t.endpoint)


@query
def post_termination_counts(t: Feed) -> DataFrame:
    events = signals.event_moments(t.iam, t.endpoint, risk_key)
    return signals.post_termination(events, signals.termination_dates(t.identity, risk_key)).select(
        "user_key", "iam_events", "endpoint_events")


@query
def user_risk_scores(t: Feed) -> DataFrame:
    return risk.score_users(t.identity, t.facts("iam"), t.facts("endpoint"))


@query
def risk_band_distribution(t: Feed) -> DataFrame:
    return risk.band_distribution(t.risk)


@query
def top_100_risk_users(t: Feed) -> DataFrame:
    return risk.top_users(t.risk)


# --- detections ---------------------------------------------------------------------------

@query
def post_termination_detections(t: Feed) -> DataFrame:
    return detections.post_termination_activity(t.identity, t.signals)


@query
def credential_compromise_detections(t: Feed) -> DataFrame:
    return detections.credential_compromise(t.signals)


@query
def malware_lateral_detections(t: Feed) -> DataFrame:
    return detections.malware_lateral_movement(t.signals)


@query
def administrative_abuse_detections(t: Feed) -> DataFrame:
    return detections.administrative_abuse(t.signals)


@query
def hostname_mismatch_detections(t: Feed) -> DataFrame:
    return detections.identity_hostname_mismatch(t.identity, t.signals)


@query
def hostname_mismatch_detections_compat(t: Feed) -> DataFrame:
    return detections.identity_hostname_mismatch(t.identity, t.signals, compat=True)


@query
def temporal_closest_pairs(t: Feed) -> DataFrame:
    """The closest high-risk sign-in and administrative alert of every user within 24 hours."""
    events = t.signals.where("user_key IS NOT NULL")
    pairs = closest_pairs(events, ["user_key"], F.col("us"), F.col("high_risk_flag"), F.expr(detections.ADMINISTRATIVE), None,
                          24 * detections.HOUR_MICROS)
    return pairs.select(
        "user_key", (F.col("gap_us") / detections.HOUR_MICROS).alias("delta_hours"),
        signals.at_micros(F.col("left_us")).alias("timestamp_left"),
        signals.at_micros(F.col("right_us")).alias("timestamp_right"))


@query
def threat_detections(t: Feed) -> DataFrame:
    found = detections.detect(t.identity, t.signals)
    return detections.sorted_detections(detections.with_threat_ids(found))


@query
def threat_type_summary(t: Feed) -> DataFrame:
    return detections.type_summary(t.threats)


@query
def threat_severity_summary(t: Feed) -> DataFrame:
    return detections.type_summary(t.threats, "severity")


@query
def threat_affected_users(t: Feed) -> DataFrame:
    return detections.affected_users(t.threats)


# --- queue ----------------------------------------------------------------------------------

@query
def threat_corroboration(t: Feed) -> DataFrame:
    return queue.corroboration(t.threats)


@query
def investigation_queue(t: Feed) -> DataFrame:
    return queue.build_queue(t.threats, t.risk, t.identity)


@query
def investigation_queue_summary(t: Feed) -> DataFrame:
    return queue.queue_summary(t.queue)


# --- investigation ----------------------------------------------------------------------------

@query
def known_iam_users(t: Feed) -> DataFrame:
    return investigate.existing_users(t.iam.select("user_id").distinct(), t.identity, t.risk)


@query
def user_mentions(t: Feed) -> DataFrame:
    return investigate.user_mentions(t.raw("messages"), ["conv_id", "turn"], t.identity, t.risk)


@query
def identity_context(t: Feed) -> DataFrame:
    return investigate.identity_context(t.identity)


@query
def user_risk_profile(t: Feed) -> DataFrame:
    profile = investigate.risk_profile(t.risk)
    fixed = [n for n in profile.columns if n not in ("score_breakdown", "metrics")]
    return profile.select(*fixed, "score_breakdown.*", "metrics.*")


@query
def user_threats(t: Feed) -> DataFrame:
    rows = investigate.user_threats(t.threats, t.queue)
    entry = F.col("investigation_queue")
    return rows.select(
        *[n for n in rows.columns if n != "investigation_queue"],
        entry["priority_rank"].cast("string").alias("priority_rank"),
        entry["investigation_priority"].alias("investigation_priority"),
        entry["recommended_action"].alias("queue_action"))


@query
def iam_events_per_user(t: Feed) -> DataFrame:
    return investigate.iam_events(t.iam)


@query
def endpoint_events_per_user(t: Feed) -> DataFrame:
    return investigate.endpoint_events(t.endpoint)


@query
def firewall_events_per_user(t: Feed) -> DataFrame:
    return t.firewall_events()


@query
def iam_first_50_events_per_user(t: Feed) -> DataFrame:
    return investigate.iam_events(t.iam, 50)


@query
def endpoint_first_50_events_per_user(t: Feed) -> DataFrame:
    return investigate.endpoint_events(t.endpoint, 50)


@query
def firewall_first_50_events_per_user(t: Feed) -> DataFrame:
    return t.firewall_events(50)


@query
def related_hosts(t: Feed) -> DataFrame:
    return investigate.related_hosts(t.identity, t.iam, t.endpoint)


@query
def evidence_timeline(t: Feed) -> DataFrame:
    return t.build_timeline()


@query
def evidence_timeline_first_100(t: Feed) -> DataFrame:
    return t.timeline_once().where("position <= 100")


@query
def timeline_chart_points(t: Feed) -> DataFrame:
    return investigate.chart_points(t.timeline_once())


@query
def investigation_report(t: Feed) -> DataFrame:
    headers = t.report_headers
    fixed = [n for n in headers.columns if n != "score_breakdown"]
    return headers.select(*fixed, "score_breakdown.*")


@query
def investigation_report_lines(t: Feed) -> DataFrame:
    return investigate.report_lines(t.report_headers, t.threats, t.queue)


@query
def critical_accounts(t: Feed) -> DataFrame:
    return investigate.critical_accounts(t.risk)


@query
def system_summary(t: Feed) -> DataFrame:
    return investigate.system_summary(t.threats, t.risk)


@query
def primary_detections(t: Feed) -> DataFrame:
    return investigate.primary_detections(t.threats)


@query
def user_comparison(t: Feed) -> DataFrame:
    return investigate.user_comparison(t.identity, t.risk, t.threats)


@query
def traffic_volume(t: Feed) -> DataFrame:
    return investigate.traffic_volume(t.traffic)


@query
def mfa_evidence(t: Feed) -> DataFrame:
    return investigate.mfa_evidence(investigate.iam_events(t.iam))


@query
def evidence_bundle(t: Feed) -> DataFrame:
    iam, endpoint = t.narrow("iam", "events"), t.narrow("endpoint", "events")  # written first, so that scores and hosts are read from them
    parts = {
        "identity": identity_context(t), "risk": user_risk_profile(t), "threats": user_threats(t),
        "iam": investigate.iam_events(iam), "endpoint": investigate.endpoint_events(endpoint),
        "firewall": t.firewall_events(), "timeline": t.timeline}
    bundle = investigate.evidence_bundle({n: portable(part) for n, part in parts.items()}, t.identity.where("user_id IS NOT NULL"))
    return bundle.withColumn("payload", F.to_json("payload"))


# --- summaries ----------------------------------------------------------------------------------

@query
def snapshot_meta(t: Feed) -> DataFrame:
    return summary.snapshot_meta(t.risk, t.threats, t.queue)


@query
def source_coverage(t: Feed) -> DataFrame:
    return summary.source_coverage(
        {"identity": t.identity, "iam": t.iam, "endpoint": t.endpoint, "firewall": t.firewall})


@query
def threat_vector_split(t: Feed) -> DataFrame:
    return summary.threat_vectors(t.threats)


@query
def threat_search(t: Feed) -> DataFrame:
    return summary.search_threats(t.threats, "Malware", "CRITICAL").select(
        "threat_id", "user_id", "threat_type", "severity")


@query
def user_search(t: Feed) -> DataFrame:
    return summary.search_users(t.risk, "sale").select("user_id", "department", "risk_score")


@query
def department_breakdown(t: Feed) -> DataFrame:
    return summary.department_breakdown(t.risk)


@query
def overall_risk(t: Feed) -> DataFrame:
    return summary.overall(t.risk)


@query
def top_5_users(t: Feed) -> DataFrame:
    return summary.highest_scores(t.risk, 5)


@query
def top_7_users(t: Feed) -> DataFrame:
    return summary.highest_scores(t.risk, 7)
