"""The tables a query starts from, each built lazily and once per query."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, investigate, linkage
from ..operators.dedupe import COPIES, UNPARSED
from ..operators.detections import detect, with_threat_ids
from ..operators.queue import build_queue
from ..operators.risk import score_users
from ..operators.signals import user_signals
from ..session import ensure_checkpoint_dir, prepare
from ..sources import sample_feed
from ..sources.published import inputs_stamp, publish, read
from ..sources.raw import with_null_tokens


def portable(df: DataFrame) -> DataFrame:
    """Times and flags as text, whole numbers as bigint: equal on every engine."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("timestamp_ntz", "boolean"):
            c = c.cast("string").alias(name)
        elif kind in ("int", "smallint", "tinyint") or kind.startswith("decimal"):
            c = c.cast("bigint").alias(name)
        out.append(c)
    return df.select(*out)


# the columns of clean tables that some readers share, written for those readers alone
FACTS = {
    "iam": ("event_id", "timestamp", "user_id", "event_type", "hostname", "session_id", "mfa_passed", "failure_reason", "risk_score"),
    "endpoint": ("alert_id", "detected_timestamp", "hostname", "user_id", "alert_name", "severity", "description", "process_name",
                 "unresolved_alert_flag", "impossible_resolution_flag"),
}
_FIREWALL = ("log_id", "timestamp", "hostname", "hostname_join_key", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "action",
             "bytes_sent", "bytes_received", "threat_flag", "geo_country")
NARROW = {
    "facts": FACTS,
    "links": {"iam": ("user_id", "hostname", "device_id"), "endpoint": ("user_id", "hostname", "hostname_join_key"),
              "firewall": ("hostname_join_key",)},
    "timeline": {
        "iam": ("event_id", "timestamp", "user_id", "event_type", "auth_method", "source_ip", "hostname", "mfa_passed", "failure_reason"),
        "endpoint": ("alert_id", "detected_timestamp", "user_id", "hostname", "alert_name", "process_name", "severity", "status"),
        "firewall": _FIREWALL},
    "events": {
        "iam": (*FACTS["iam"], "auth_method", "source_ip", "device_id", "risk_level", "geo_location"),
        "endpoint": (*FACTS["endpoint"], "status", "file_path"),
        "firewall": (*_FIREWALL, "rule_name")},
}
# (application, folder and stamp of its tables, table) -> folder of the written table
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Feed:
    """Raw and clean telemetry derived from the test tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        # a table that changes within an application is read anew
        self.stamp = inputs_stamp(self.spark, sf_dir)

    def raw(self, table: str) -> DataFrame:
        df = sample_feed.load(self.spark, self.sf_dir, table)
        return df if table in ("iam", "messages") else with_null_tokens(df)

    def _key(self, name: str) -> tuple[str, str, str]:
        return self.spark.sparkContext.applicationId, f"{self.sf_dir} {self.stamp}", name

    def published(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The named table, written once per application to the shared checkpoint folder.

        Stages meet at written, typed tables: later ones prune columns and push filters into
        the scan, and a lost executor re-reads a file instead of repeating earlier stages.
        """
        key = self._key(name)
        if key not in _WRITTEN:
            run = hashlib.sha1(" ".join(key[:2]).encode()).hexdigest()[:16]
            folder = f"{ensure_checkpoint_dir(self.spark)}/tracewarden/{run}"
            publish(build(), folder, name)
            _WRITTEN[key] = folder
        return read(self.spark, _WRITTEN[key], name)

    def stage(self, table: str) -> DataFrame:
        """The clean table with the number of raw copies of each row."""
        return self.published(f"{table}_stage", lambda: cleaning.STAGES[table](self.raw(table)))

    def _clean(self, table: str) -> DataFrame:
        return self.stage(table).drop(COPIES, UNPARSED)

    def _written_part(self, table: str, columns: Sequence[str]) -> DataFrame | None:
        """Some columns of a clean table, of a written table that has them."""
        if self._key(f"{table}_stage") in _WRITTEN:
            return self._clean(table).select(*columns)
        for name, tables in NARROW.items():
            if set(columns) <= set(tables.get(table, ())) and self._key(f"{table}_{name}") in _WRITTEN:
                return read(self.spark, _WRITTEN[self._key(f"{table}_{name}")], f"{table}_{name}").select(*columns)
        return None

    def part(self, table: str, *columns: str) -> DataFrame:
        """Some columns of a clean table, for a reader that goes through them once: of a written table, if one has
        them, else only these columns are cleaned and no whole rows are shuffled."""
        found = self._written_part(table, columns)
        return cleaning.clean_part(table, self.raw(table), columns) if found is None else found

    def narrow(self, table: str, name: str) -> DataFrame:
        """The columns in ``NARROW[name]``, written unless a written table has them."""
        columns = NARROW[name][table]
        found = self._written_part(table, columns)
        return self.published(f"{table}_{name}", lambda: cleaning.clean_part(table, self.raw(table), columns)) if found is None else found

    def facts(self, table: str) -> DataFrame:
        return self.narrow(table, "facts")

    @cached_property
    def identity(self) -> DataFrame:
        return self._clean("identity")

    @cached_property
    def iam(self) -> DataFrame:
        return self._clean("iam")

    @cached_property
    def endpoint(self) -> DataFrame:
        return self._clean("endpoint")

    @cached_property
    def firewall(self) -> DataFrame:
        return self._clean("firewall")

    @cached_property
    def risk(self) -> DataFrame:
        return self.published(
            "user_risk_scores", lambda: score_users(self.identity, self.facts("iam"), self.facts("endpoint")))

    @cached_property
    def threats(self) -> DataFrame:
        return self.published(
            "threat_detections",
            lambda: with_threat_ids(detect(self.identity, self.signals)))

    @cached_property
    def signals(self) -> DataFrame:
        return self.published("user_signals", lambda: user_signals(self.facts("iam"), self.facts("endpoint")))

    @cached_property
    def queue(self) -> DataFrame:
        return self.published(
            "investigation_queue", lambda: build_queue(self.threats, self.risk, self.identity))

    @cached_property
    def hosts(self) -> DataFrame:
        """Every host of every user."""
        return self.published("related_hosts", lambda: investigate.related_hosts(
            self.identity, self.part("iam", "user_id", "hostname"), self.part("endpoint", "user_id", "hostname")))

    @cached_property
    def traffic(self) -> DataFrame:
        return self.published(
            "user_traffic", lambda: investigate.user_traffic(investigate.host_keys(self.hosts), self.part(
                "firewall", "hostname_join_key", "hostname", "bytes_sent", "bytes_received", "timestamp")))

    @cached_property
    def session_events(self) -> DataFrame:
        """The events of both sources that have a session, narrow: all session queries read this one table."""
        columns = ("session_id", "hostname", "timestamp")
        return self.published(
            "session_events", lambda: linkage.session_events(self.part("iam", *columns), self.part("firewall", *columns)))

    def firewall_events(self, n: int | None = None, columns: str = "events") -> DataFrame:
        firewall = self.narrow("firewall", columns)  # written first, so that the traffic is read from it
        return investigate.firewall_events(investigate.host_keys(self.hosts), firewall, n, self.traffic)

    def build_timeline(self, columns: str = "timeline") -> DataFrame:
        iam, endpoint = self.narrow("iam", columns), self.narrow("endpoint", columns)
        return investigate.evidence_timeline(
            investigate.iam_events(iam), investigate.endpoint_events(endpoint), self.firewall_events(columns=columns),
            sizes=investigate.event_counts(iam, endpoint, self.traffic))

    def timeline_once(self) -> DataFrame:
        """The whole timeline for a reader that goes through it once: written only if it is already."""
        return self.timeline if self._key("evidence_timeline") in _WRITTEN else self.build_timeline()

    @cached_property
    def timeline(self) -> DataFrame:
        """The whole evidence timeline of every user, for several readers."""
        return self.published("evidence_timeline", self.build_timeline)

    @cached_property
    def report_headers(self) -> DataFrame:
        return investigate.report_headers(
            self.identity, self.risk, investigate.latest_activity(
                self.part("iam", "user_id", "timestamp"), self.part("endpoint", "user_id", "detected_timestamp"), self.traffic))
