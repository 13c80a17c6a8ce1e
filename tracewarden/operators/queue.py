"""Corroboration of scores and detections into a ranked investigation queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import queue_key
from ..functions.text import strip
from ..schemas import QUEUE_COLUMNS
from .dedupe import first_per_key
from .ranking import number_rows

# Ranks of severity and confidence labels; anything else ranks 0.
SEVERITY_RANK = {"Critical": 3, "High": 2, "Medium": 1, "Low": 0}
CONFIDENCE_RANK = {"High": 3, "Medium": 2, "Low": 1}
PRIORITIES = ("Critical", "High", "Medium", "Low")

CONTEXT_COLUMNS = (
    "user_id", "full_name", "role", "department", "location", "status", "username", "hostname",
    "device_id", "manager_username", "device_id_conflict", "device_user_count",
)


def _rank(label: Column, ranks: dict[str, int]) -> Column:
    rank = F.lit(0)
    for name, value in ranks.items():
        rank = F.when(label == name, value).otherwise(rank)
    return rank


def _label(rank: Column, ranks: dict[str, int]) -> Column:
    label = F.lit("Low")
    for name, value in ranks.items():
        label = F.when(rank == value, name).otherwise(label)
    return label


def prepared_threats(threats: DataFrame) -> DataFrame:
    clean = threats.select(
        queue_key(F.col("user_id")).alias("user_id"),
        *[strip(F.col(n)).alias(n) for n in ("threat_type", "severity", "confidence")],
    )
    return clean.withColumns({
        "severity_rank": _rank(F.col("severity"), SEVERITY_RANK),
        "confidence_rank": _rank(F.col("confidence"), CONFIDENCE_RANK),
    })


def prepared_risk(risk: DataFrame) -> DataFrame:
    level = "risk_level" if "risk_level" in risk.columns else "risk_band"
    return risk.withColumns({
        "user_id": queue_key(F.col("user_id")),
        "risk_score": F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0)),
        "risk_level": strip(F.col(level)),
    })


def identity_context(identity: DataFrame) -> DataFrame:
    """One identity record per user."""
    rows = identity.withColumn("user_id", queue_key(F.col("user_id"))).select(*CONTEXT_COLUMNS)
    return first_per_key(rows, "user_id")


def corroboration(threats: DataFrame) -> DataFrame:
    """Per user (a null user included). The set of types is bounded by the number of rules."""
    severity = F.col("severity")

    def of(level: str) -> Column:
        return F.count(F.when(severity == level, 1))

    grouped = prepared_threats(threats).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("threat_detection_count"),
        F.collect_set("threat_type").alias("types"),
        of("Critical").alias("critical_detections"), of("High").alias("high_detections"),
        of("Medium").alias("medium_detections"),
        F.max("severity_rank").alias("highest_severity_rank"),
        F.max("confidence_rank").alias("highest_confidence_rank"),
    )
    types = F.col("types")
    return grouped.withColumns({
        "distinct_threat_types": F.size(types).cast("bigint"),
        "threat_types": F.array_join(F.array_sort(types), " | "),
        "highest_severity": _label(F.col("highest_severity_rank"), SEVERITY_RANK),
        "highest_confidence": _label(F.col("highest_confidence_rank"), CONFIDENCE_RANK),
    }).drop("types")


def priority_score() -> Column:
    """The risk score plus a bounded bonus for corroborating detections."""
    c = F.col
    bonus = sum(
        (F.when(condition, float(points)).otherwise(0.0) for condition, points in (
            (c("distinct_threat_types") >= 2, 5), (c("distinct_threat_types") >= 3, 5),
            (c("critical_detections") >= 1, 5), (c("critical_detections") >= 2, 5),
            (c("high_detections") >= 2, 2),
        )),
        F.lit(0.0),
    )
    return F.least(c("risk_score") + bonus, F.lit(100.0))


def priority(score: Column) -> Column:
    return (F.when(score >= 80, "Critical").when(score >= 60, "High")
            .when(score >= 40, "Medium").otherwise("Low"))


def reason() -> Column:
    c = F.col

    def count(name: str, text: str) -> Column:
        return F.concat(c(name).cast("string"), F.lit(f" {text}"))

    score = F.format_string("%.1f", c("risk_score"))
    phrases = F.concat_ws(
        "; ",
        F.when(c("risk_score") >= 80, F.concat(F.lit("very high user risk score ("), score, F.lit(")")))
        .when(c("risk_score") >= 60, F.concat(F.lit("high user risk score ("), score, F.lit(")"))),
        F.when(c("distinct_threat_types") >= 2, count("distinct_threat_types", "distinct threat types")),
        F.when(c("critical_detections") > 0, count("critical_detections", "critical detection(s)")),
        F.when(c("high_detections") > 0, count("high_detections", "high-severity detection(s)")),
    )
    return F.coalesce(
        F.nullif(phrases, F.lit("")), count("threat_detection_count", "threat detection(s)")
    )


def action() -> Column:
    c = F.col
    critical = c("critical_detections") > 0
    return (
        F.when(critical & (c("distinct_threat_types") >= 2),
               "Immediate investigation: correlate endpoint, IAM and identity evidence; "
               "validate affected account and assets.")
        .when(critical, "Prioritize investigation of critical telemetry and validate affected "
                        "account and asset.")
        .when(c("high_detections") > 0, "Review high-severity detections and correlate supporting "
                                        "IAM and endpoint evidence.")
        .otherwise("Review detection evidence and validate identity and asset context.")
    )


def build_queue(threats: DataFrame, risk: DataFrame, identity: DataFrame) -> DataFrame:
    """Users with detections, ranked. Where risk and identity both have a column, risk wins."""
    risk_columns = ("user_id", "department", "role", "status", "risk_score", "risk_level")
    context = identity_context(identity).select(
        "user_id", "full_name", "location", "hostname", "device_id", "device_id_conflict",
        "device_user_count",
    )
    joined = (
        prepared_risk(risk).select(*risk_columns)
        .join(corroboration(threats), "user_id")
        .join(context, "user_id", "left")
        .withColumn("investigation_priority_score", priority_score())
        .withColumns({
            "investigation_priority": priority(F.col("investigation_priority_score")),
            "investigation_reason": reason(),
            "recommended_action": action(),
        })
    )
    order = [F.desc(n) for n in (
        "investigation_priority_score", "risk_score", "critical_detections", "high_detections")]
    return number_rows(joined, [*order, F.asc("user_id")], "priority_rank").select(*QUEUE_COLUMNS)


def queue_summary(queue: DataFrame) -> DataFrame:
    """Users per priority, most urgent first."""
    place = _rank(F.col("investigation_priority"), {p: i for i, p in enumerate(PRIORITIES)})
    return (
        queue.groupBy("investigation_priority").agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(place)
    )
