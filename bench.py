"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores.
Every query is executed in full into the noop sink. Cleaning queries run from the raw feed;
the others read the published clean tables, whose one-time writing is reported separately.
"""

from __future__ import annotations

import json
import os
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "clean_identity", "clean_iam", "clean_endpoint", "clean_firewall", "firewall_quality_report",
    "firewall_pipeline_summary", "relationship_quality_report", "shared_session_evidence",
    "user_risk_scores", "post_termination_detections", "credential_compromise_detections",
    "malware_lateral_detections", "administrative_abuse_detections",
    "hostname_mismatch_detections", "threat_detections", "investigation_queue",
    "firewall_events_per_user", "firewall_first_50_events_per_user", "evidence_timeline", "traffic_volume", "evidence_bundle",
    "investigation_report_lines", "user_mentions", "shared_session_diagnostic",
)


def main() -> None:
    from pyspark.sql import functions as F

    from tracewarden.operators.detections import credential_compromise
    from tracewarden.plans.feed import Feed
    from tracewarden.plans.queries import QUERIES
    from tracewarden.session import build_session

    spark = build_session(
        "bench", f"local[{CPUS}]", int(CPUS),
        **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    feed = Feed(spark, SF_DIR)
    stages = {
        f"publish_{name}": timed(lambda n=name: getattr(feed, n))
        for name in ("identity", "iam", "endpoint", "firewall", "signals", "risk", "threats", "queue", "hosts", "traffic", "timeline")
    }

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    def hot_user() -> None:
        """The credential rule with all sign-ins and alerts under one user."""
        events = feed.signals.withColumn("user_key", F.lit("HOT"))
        credential_compromise(events).write.format("noop").mode("overwrite").save()

    times = {name: timed(lambda n=name: run(n)) for name in HEADLINE}
    times["credential_compromise_one_hot_user"] = timed(hot_user)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "published_tables": stages, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
