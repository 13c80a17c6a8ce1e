"""Summary datasets behind an overview page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .investigate import one_decimal

# Display names of the clean tables.
SOURCE_NAMES = {
    "endpoint": "Endpoint Alerts", "firewall": "Firewall Logs",
    "iam": "Iam Audit Trail", "identity": "Identity Asset Master",
}
_MALWARE_WORDS = "malware|powershell|lateral"
_LEAVER_WORDS = "termination|disabled|inactive"


def _is_level(level: str) -> Column:
    return F.lower(F.coalesce("risk_level", F.lit(""))) == level


def snapshot_meta(risk: DataFrame, threats: DataFrame, queue: DataFrame) -> DataFrame:
    """users, threats, queue and critical in one row."""
    def tagged(df: DataFrame, **figures: Column) -> DataFrame:
        names = ("users", "threats", "queue", "critical")
        return df.agg(*[figures.get(n, F.max(F.lit(None).cast("bigint"))).alias(n) for n in names])

    rows = F.count(F.lit(1))
    parts = (
        tagged(risk, users=rows, critical=F.count(F.when(_is_level("critical"), 1)))
        .unionByName(tagged(threats, threats=rows)).unionByName(tagged(queue, queue=rows))
    )
    return parts.agg(*[F.max(n).alias(n) for n in parts.columns])


def source_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(SOURCE_NAMES[name]).alias("source"), F.lit("Reviewed").alias("status"), "rows",
            F.concat(F.format_number("rows", 0), F.lit(" rows")).alias("coverage"),
            F.lit("Schema available").alias("issues"))
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def threat_vectors(threats: DataFrame) -> DataFrame:
    """Malware, leaver and identity shares of all detections; the first match wins."""
    kind = F.lower("threat_type")
    malware = kind.rlike(_MALWARE_WORDS)
    leaver = ~malware & kind.rlike(_LEAVER_WORDS)
    counts = threats.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(malware, 1)).alias("m"),
        F.count(F.when(leaver, 1)).alias("l"), F.count(F.when(~malware & ~leaver, 1)).alias("i"))
    return counts.selectExpr(
        "total", "stack(3, 'malware', m, 'post_termination', l, 'identity', i) AS (vector, detections)"
    ).select("vector", "detections",
             (F.col("detections") / F.greatest("total", F.lit(1))).alias("share"))


def _contains(name: str, term: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit(""))).contains(term.lower())


def search_threats(threats: DataFrame, term: str = "", severity: str = "ALL") -> DataFrame:
    found = threats
    if term:
        found = found.where(_contains("user_id", term) | _contains("threat_type", term))
    return found if severity == "ALL" else found.where(F.upper("severity") == severity)


def search_users(risk: DataFrame, term: str = "") -> DataFrame:
    return risk.where(_contains("user_id", term) | _contains("department", term)) if term else risk


def department_breakdown(risk: DataFrame) -> DataFrame:
    department = F.coalesce(F.nullif("department", F.lit("")), F.lit("Other"))
    return (
        risk.groupBy(department.alias("department")).agg(
            F.count(F.lit(1)).alias("users"), one_decimal(F.avg("risk_score")).alias("average_score"))
        .orderBy(F.desc("average_score"), "department")
    )


def overall(risk: DataFrame) -> DataFrame:
    return risk.agg(
        F.coalesce(one_decimal(F.avg("risk_score")), F.lit(0.0)).alias("average_score"),
        F.count(F.when(_is_level("critical"), 1)).alias("critical_users"),
        F.count(F.when(_is_level("high"), 1)).alias("high_users"),
    )


def highest_scores(risk: DataFrame, n: int) -> DataFrame:
    return risk.orderBy(F.desc("risk_score"), "user_id").limit(n).select(
        "user_id", "username", "department", "risk_score", "risk_level")
