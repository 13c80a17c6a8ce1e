"""Quality assertions, column profiles and pipeline summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions.text import as_flag, strip
from .cleaning import device_users
from .dedupe import COPIES, UNPARSED, duplicate_key_summary


def two_decimals(c: Column) -> Column:
    """Round half to even on the scaled double, as array libraries do."""
    return F.rint(c * 100) / 100


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _metrics(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """One aggregation, then one row per metric."""
    row = df.agg(*[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in figures.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in figures)
    return row.selectExpr(f"stack({len(figures)}, {pairs}) AS (metric, value)")


def column_profile(
    df: DataFrame, columns: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """rows, missing_count, missing_pct and unique_values per column.

    Values are turned into (column, value) pairs and counted with map-side combine, then
    counted again per column: the shuffle carries distinct values, never whole rows, and a
    value filling a third of a column is one partial count per split. ``approximate``
    replaces the exact distinct count with one mergeable sketch per column.
    """
    columns = columns or df.columns
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS STRING)" for n in columns)
    values = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)")
    n = F.col("n")
    if approximate:
        counted = values.groupBy("column").agg(
            F.count(F.lit(1)).alias("rows"),
            _count_if(F.col("value").isNull()).alias("missing_count"),
            F.approx_count_distinct("value", 0.01).alias("unique_values"),
        )
    else:
        counted = (
            values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column").agg(
                F.sum(n).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), n)), F.lit(0)).alias("missing_count"),
                F.count("value").alias("unique_values"),
            )
        )
    share = F.col("missing_count") / F.col("rows") * 100
    return counted.select(
        "column", "rows", "missing_count", two_decimals(share).alias("missing_pct"), "unique_values"
    )


def raw_profile(raw: DataFrame) -> DataFrame:
    """Rows, columns, exact duplicates and missing cells of a raw table."""
    from .dedupe import distinct_with_copies

    names = raw.columns
    missing = sum((F.col(n).isNull().cast("int") for n in names), F.lit(0))
    return distinct_with_copies(raw).agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows"),
        F.lit(len(names)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("exact_duplicate_rows"),
        F.coalesce(F.sum(missing * F.col(COPIES)), F.lit(0)).alias("total_missing_cells"),
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per non-null value of each column."""
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS STRING)" for n in columns)
    return (
        df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)")
        .where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    )


def value_ranges(iam: DataFrame) -> DataFrame:
    """Score and time range of the IAM table."""
    return iam.agg(
        F.min("risk_score").alias("risk_score_min"), F.max("risk_score").alias("risk_score_max"),
        F.min("timestamp").alias("timestamp_min"), F.max("timestamp").alias("timestamp_max"),
    )


def id_integrity(df: DataFrame, key: str) -> DataFrame:
    """Missing (null or blank) and extra duplicate key values."""
    blank = F.col(key).isNull() | (strip(F.col(key)) == "")
    n = F.col("n")
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.when(blank, n)), F.lit(0)).alias("missing_ids"),
            F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_ids"),
        )
    )


def domain_violations(endpoint: DataFrame) -> DataFrame:
    """Rows outside the allowed domains, per rule; all zero on a sound table."""
    outside = lambda n, allowed: F.col(n).isNotNull() & ~F.col(n).isin(*allowed)
    both = F.col("detected_timestamp").isNotNull() & F.col("resolved_timestamp").isNotNull()
    return _metrics(endpoint, {
        "severity_outside_domain": _count_if(outside("severity", cat.ALLOWED_LEVELS)),
        "status_outside_domain": _count_if(outside("status", cat.ALLOWED_STATUSES)),
        "criticality_outside_domain": _count_if(outside("device_criticality", cat.ALLOWED_LEVELS)),
        "impossible_without_both_times": _count_if(F.col("impossible_resolution_flag") & ~both),
    })


def require_domains(endpoint: DataFrame) -> None:
    broken = [r["metric"] for r in domain_violations(endpoint).where("value > 0").collect()]
    if broken:
        raise ValueError(f"Endpoint table violates: {broken}")


def device_conflicts(df: DataFrame) -> DataFrame:
    """Devices used by several users, and the rows on them."""
    per_device = (
        df.where(F.col("device_id").isNotNull()).groupBy("device_id")
        .agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
    )
    return per_device.where("users > 1").agg(
        F.count(F.lit(1)).alias("conflicting_devices"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("conflict_records"),
    )


def termination_before_hire(identity: DataFrame) -> Column:
    return as_flag(F.col("termination_date") < F.col("hire_date"))


def _missing(*names: str) -> dict[str, Column]:
    return {f"missing_{n}": _count_if(F.col(n).isNull()) for n in names}


def _raw_and_clean(raw_rows: int | None, names: tuple[str, str, str]) -> dict[str, Column]:
    """Raw rows, exact duplicates and clean rows of a stage, or of a clean table whose raw row
    count was observed while it was written."""
    raw = F.sum(COPIES) if raw_rows is None else F.lit(raw_rows)
    clean = F.count(F.lit(1))
    return dict(zip(names, (raw, raw - clean, clean), strict=True))


def _width(df: DataFrame) -> Column:
    return F.lit(len([n for n in df.columns if n not in (COPIES, UNPARSED)]))


def _seen_or_sum(seen: int | None, column: str) -> Column:
    """A sum over the stage, or its value as observed while a clean table without the column was written."""
    return F.coalesce(F.sum(column), F.lit(0)) if seen is None else F.lit(seen)


def identity_summary(stage: DataFrame, raw_rows: int | None = None, unparsed: int | None = None) -> DataFrame:
    figures = {
        **_raw_and_clean(raw_rows, ("raw_rows", "exact_duplicate_rows", "clean_rows")),
        **_missing("user_id", "username", "hostname", "device_id"),
        "device_conflict_records": _count_if(F.col("device_id_conflict")),
        "conflicting_devices": F.countDistinct(F.when(F.col("device_id_conflict"), F.col("device_id"))),
        "termination_before_hire": _count_if(termination_before_hire(stage)),
        "unparsed_dates": _seen_or_sum(unparsed, UNPARSED),
    }
    repeated = duplicate_key_summary(stage, "user_id").select(
        F.lit("duplicate_user_id_rows").alias("metric"),
        F.col("rows_in_duplicate_groups").alias("value"),
    )
    return _metrics(stage, figures).unionByName(repeated)


def iam_summary(
    stage: DataFrame, raw_columns: int, raw_rows: int | None = None, unparsed: int | None = None
) -> DataFrame:
    figures = {
        **_raw_and_clean(raw_rows, ("raw_rows", "exact_duplicates_removed", "final_rows")),
        "raw_columns": F.lit(raw_columns),
        "final_columns": _width(stage),
        "missing_timestamps": _count_if(F.col("timestamp").isNull()),
        "missing_user_ids": _count_if(F.col("user_id").isNull()),
        "missing_session_ids": _count_if(F.col("session_id").isNull()),
        "unparsed_timestamps": _seen_or_sum(unparsed, UNPARSED),
    }
    repeated = duplicate_key_summary(stage, "event_id").select(
        F.lit("duplicate_event_ids").alias("metric"), F.col("extra_duplicate_rows").alias("value")
    )
    devices = device_conflicts(stage).selectExpr(
        "stack(2, 'device_conflicting_ids', conflicting_devices, "
        "'device_conflict_records', conflict_records) AS (metric, value)"
    )
    return _metrics(stage, figures).unionByName(repeated).unionByName(devices)


def endpoint_summary(stage: DataFrame, raw_rows: int | None = None) -> DataFrame:
    # duplicate removal keeps every alert id, so raw and final distinct ids agree
    flags = {
        "remaining_duplicate_alert_id_rows": "duplicate_alert_id_flag",
        "missing_user_id": "missing_user_id_flag",
        "missing_hostname": "missing_hostname_flag",
        "invalid_detected_timestamp": "invalid_detected_timestamp_flag",
        "invalid_resolved_timestamp": "invalid_resolved_timestamp_flag",
        "impossible_resolution": "impossible_resolution_flag",
        "resolved_without_timestamp": "resolved_without_timestamp_flag",
        "unresolved_with_resolution_timestamp": "unresolved_with_resolution_timestamp_flag",
        "missing_sha256": "sha256_missing_flag",
        "invalid_sha256": "invalid_sha256_flag",
    }
    figures = {
        **_raw_and_clean(raw_rows, ("raw_rows", "exact_duplicate_rows_removed", "final_rows")),
        "raw_unique_alert_ids": F.countDistinct("alert_id"),
        "final_unique_alert_ids": F.countDistinct("alert_id"),
        **{name: _count_if(F.col(flag)) for name, flag in flags.items()},
        "rows_requiring_review": _count_if(F.col("data_quality_status") == "Review"),
    }
    return _metrics(stage, figures)


def firewall_summary(stage: DataFrame, raw_rows: int | None = None) -> DataFrame:
    c = F.col

    def states(column: str, flag: str, good, bad) -> dict[str, Column]:
        return {
            f"valid_{column}": _count_if(c(flag) == good),
            f"invalid_{column}": _count_if(c(flag) == bad),
            f"missing_{column}": _count_if(c(column).isNull()),
        }

    figures = {
        **_raw_and_clean(raw_rows, ("raw_rows", "exact_duplicate_rows", "clean_rows")),
        "clean_columns": _width(stage),
        "missing_log_ids": _count_if(c("log_id").isNull()),
        "standardized_timestamps": F.count("timestamp"),
        "missing_timestamps": _count_if(c("timestamp").isNull()),
        "missing_hostnames": _count_if(c("hostname").isNull()),
        **states("src_ip", "src_ip_valid", True, False),
        **states("dst_ip", "dst_ip_valid", True, False),
        **states("src_port", "src_port_status", "valid", "invalid"),
        **states("dst_port", "dst_port_status", "valid", "invalid"),
        "threat_flag_true": _count_if(c("threat_flag")),
        "threat_flag_false": _count_if(~c("threat_flag")),
        "valid_session_ids": F.count("session_id"),
        "missing_session_ids": _count_if(c("session_id").isNull()),
        "missing_rule_names": _count_if(c("rule_name").isNull()),
        "missing_geo_country": _count_if(c("geo_country").isNull()),
    }
    repeated = duplicate_key_summary(stage, "log_id").select(
        F.lit("duplicate_log_ids").alias("metric"), c("extra_duplicate_rows").alias("value")
    )
    names = {"hostname": "unique_hostnames", "hostname_join_key": "unique_hostname_join_keys"}
    distinct = column_profile(stage, list(names)).select(
        F.when(c("column") == "hostname", names["hostname"])
        .otherwise(names["hostname_join_key"]).alias("metric"),
        c("unique_values").alias("value"),
    )
    return _metrics(stage, figures).unionByName(repeated).unionByName(distinct)
