"""The batch pipeline: raw inputs -> clean tables -> linkage, risk, threats -> queue.

Stages meet at published tables. Each one is a plain function of DataFrames, so a stage can
also be run alone on tables read with ``published.read``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import detections, linkage, quality, queue, risk, signals
from ..operators.cleaning import STAGES
from ..operators.dedupe import COPIES, UNPARSED
from ..schemas import RAW_COLUMNS
from ..session import ensure_checkpoint_dir, prepare
from ..sources.published import publish, require_outputs
from ..sources.raw import Contract, check_raw_inputs, scan, unexpected_columns


def clean_and_report(table: str, raw: DataFrame, folder: str, approximate: bool = False) -> DataFrame:
    """Publish a clean table with its quality report and pipeline summary.

    The raw row count and the texts without a readable time are observed while the clean table is
    written; everything else in the reports is read back from that table. Columns beyond the contract are not
    cleaned; the summary names them under ``unexpected_column: name``, one line each, and counts malformed records.
    ``approximate`` takes distinct counts of the quality report from sketches.
    """
    seen, contract = Observation(), Contract(raw, table)
    stage = STAGES[table](contract.watched)
    sums = {COPIES: "raw_rows", UNPARSED: "unparsed"}
    stage = stage.observe(seen, *[F.sum(c).alias(n) for c, n in sums.items() if c in stage.columns])
    clean = publish(stage.drop(COPIES, UNPARSED), folder, f"{table}_clean", accept=contract.check)
    raw_rows, unparsed = seen.get["raw_rows"] or 0, seen.get.get("unparsed") or 0
    summaries = {
        "identity": lambda: quality.identity_summary(clean, raw_rows, unparsed),
        "iam": lambda: quality.iam_summary(
            clean, len(RAW_COLUMNS[table]) + len(unexpected_columns(raw, table)), raw_rows, unparsed),
        "endpoint": lambda: quality.endpoint_summary(clean, raw_rows),
        "firewall": lambda: quality.firewall_summary(clean, raw_rows),
    }
    columns = list(RAW_COLUMNS["firewall"]) if table == "firewall" else None
    publish(quality.column_profile(clean, columns, approximate), folder, f"{table}_quality_report")
    summary = summaries[table]()
    rows = [(f"unexpected_column: {n}", 1) for n in unexpected_columns(raw, table)]
    if contract.check():
        rows.append(("malformed_records", contract.check()))
    if rows:
        summary = summary.unionByName(raw.sparkSession.createDataFrame(rows, "metric string, value bigint"))
    publish(summary, folder, f"{table}_pipeline_summary")
    if table == "endpoint":
        quality.require_domains(clean)
    return clean


def publish_linkage(clean: dict[str, DataFrame], folder: str, compat: bool = False) -> None:
    identity, iam, firewall = clean["identity"], clean["iam"], clean["firewall"]
    report = linkage.relationship_report(identity, iam, clean["endpoint"], firewall, compat)
    keys = linkage.identity_keys(identity, compat)
    publish(report, folder, "relationship_quality_report")
    publish(linkage.session_overlap(iam, firewall), folder, "session_relationship_report")
    evidence = publish(
        linkage.shared_session_evidence(iam, firewall, compat), folder, "shared_session_evidence")
    publish(linkage.session_evidence_summary(evidence), folder, "session_hostname_consistency_report")
    publish(linkage.ambiguous_keys(keys, "hostname_join_key"), folder, "ambiguous_hostnames")
    publish(linkage.ambiguous_keys(keys, "device_key"), folder, "ambiguous_devices")


def publish_risk(clean: dict[str, DataFrame], folder: str) -> DataFrame:
    scores = publish(
        risk.score_users(clean["identity"], clean["iam"], clean["endpoint"]), folder, "user_risk_scores")
    publish(risk.band_distribution(scores), folder, "risk_band_distribution")
    publish(risk.top_users(scores), folder, "top_100_risk_users")
    return scores


def publish_threats(clean: dict[str, DataFrame], folder: str, compat: bool = False) -> DataFrame:
    events = publish(signals.user_signals(clean["iam"], clean["endpoint"]), folder, "user_signals")
    found = detections.detect(clean["identity"], events, compat=compat)
    threats = publish(
        detections.sorted_detections(detections.with_threat_ids(found)), folder, "threat_detections")
    publish(detections.type_summary(threats), folder, "threat_type_summary")
    publish(detections.type_summary(threats, "severity"), folder, "threat_severity_summary")
    return threats


def publish_queue(
    threats: DataFrame, scores: DataFrame, identity: DataFrame, folder: str
) -> DataFrame:
    ranked = publish(queue.build_queue(threats, scores, identity), folder, "investigation_queue")
    publish(queue.queue_summary(ranked), folder, "investigation_queue_summary")
    return ranked


def run(
    spark: SparkSession, inputs: dict[str, tuple], folder: str, compat: bool = False, approximate: bool = False
) -> None:
    """``inputs``: table -> (path, kind[, options]) with kind csv, json, jsonl or parquet and the options of
    its scan, such as ``{"multi_line": False}``; results go to ``folder``."""
    prepare(spark)
    ensure_checkpoint_dir(spark)
    check_raw_inputs(spark, inputs)
    clean = {
        table: clean_and_report(table, scan(spark, table, *inputs[table]), folder, approximate)
        for table in RAW_COLUMNS
    }
    publish_linkage(clean, folder, compat)
    scores = publish_risk(clean, folder)
    threats = publish_threats(clean, folder, compat)
    publish_queue(threats, scores, clean["identity"], folder)
    require_outputs(spark, folder)
