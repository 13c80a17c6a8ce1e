"""name -> DuckDB SQL."""

from __future__ import annotations

from tracewarden.schemas import CLEAN_COLUMNS, RAW_COLUMNS

from .build import CTES, with_ctes

SQL: dict[str, str] = {}
SQL_BODY: dict[str, str] = {}


def add(name: str, needs, body: str) -> None:
    SQL_BODY[name] = body
    SQL[name] = with_ctes(needs, body)


def _text(columns, as_text) -> str:
    return ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' if c in as_text else f'"{c}"' for c in columns)


# --- cleaning -------------------------------------------------------------------------
add("clean_identity", "identity", f"""SELECT {_text(CLEAN_COLUMNS['identity'],
    ('hire_date', 'termination_date', 'device_id_conflict'))} FROM identity""")
add("clean_iam", "iam", f"SELECT {_text(CLEAN_COLUMNS['iam'], ('timestamp', 'mfa_passed'))} FROM iam")
_flags = [c for c in CLEAN_COLUMNS["endpoint"] if c.endswith("_flag")]
_endpoint_times = ("detected_timestamp", "resolved_timestamp")
_end_cols = [c for c in CLEAN_COLUMNS["endpoint"] if c != "data_quality_issue_count"]
add("clean_endpoint", "endpoint", f"""SELECT {_text(_end_cols, (*_flags, *_endpoint_times))},
    CAST(data_quality_issue_count AS BIGINT) AS data_quality_issue_count FROM endpoint""")
add("clean_firewall", "firewall", f"""SELECT {_text(CLEAN_COLUMNS['firewall'],
    ('timestamp', 'src_port', 'dst_port', 'bytes_sent', 'bytes_received', 'threat_flag',
     'src_ip_valid', 'dst_ip_valid'))} FROM firewall""")

# --- duplicates -------------------------------------------------------------------------
_RAWS = tuple(f"raw_{t}" for t in RAW_COLUMNS)
_KEYS = {"identity": "user_id", "iam": "event_id", "endpoint": "alert_id", "firewall": "log_id"}
add("exact_duplicates", _RAWS, " UNION ALL ".join(f"""
    SELECT '{t}' AS source, (SELECT COUNT(*) FROM raw_{t}) AS rows,
      (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{t})) AS distinct_rows,
      (SELECT COUNT(*) FROM raw_{t}) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{t})) AS duplicate_rows
    """ for t in RAW_COLUMNS))
add("raw_table_profile", _RAWS, " UNION ALL ".join(f"""
    SELECT '{t}' AS source, COUNT(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns,
      COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{t})) AS exact_duplicate_rows,
      {' + '.join(f'COUNT(*) - COUNT("{c}")' for c in cols)} AS total_missing_cells FROM raw_{t}
    """ for t, cols in RAW_COLUMNS.items()))
add("duplicate_keys", _RAWS, " UNION ALL ".join(f"""
    SELECT '{t}' AS source, CAST(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS rows_in_duplicate_groups,
      CAST(SUM(CASE WHEN r > 1 THEN 1 ELSE 0 END) AS BIGINT) AS extra_duplicate_rows,
      COUNT(DISTINCT k) AS distinct_keys
    FROM (SELECT {k} AS k, COUNT(*) OVER (PARTITION BY {k}) AS n,
                 ROW_NUMBER() OVER (PARTITION BY {k}) AS r FROM raw_{t})
    """ for t, k in _KEYS.items()))
_ec = ", ".join(f'"{c}"' for c in RAW_COLUMNS["endpoint"])
add("conflicting_alert_ids", "raw_endpoint", f"""
    SELECT DISTINCT alert_id FROM (
      SELECT alert_id, COUNT(*) OVER (PARTITION BY alert_id) AS per_id,
        COUNT(*) OVER (PARTITION BY {_ec}) AS per_row FROM raw_endpoint)
    WHERE per_id > 1 AND per_row = 1""")
add("firewall_id_integrity", "firewall", """
    SELECT COUNT(*) FILTER (WHERE log_id IS NULL OR trim(log_id) = '') AS missing_ids,
      COUNT(*) - COUNT(DISTINCT COALESCE(log_id, '~')) AS duplicate_ids FROM firewall""")

_order = ", ".join(f'"{c}" ASC NULLS FIRST' for c in CLEAN_COLUMNS["identity"] if c != "user_id")
add("first_identity_per_user", "identity", f"""
    SELECT {_text(CLEAN_COLUMNS['identity'], ('hire_date', 'termination_date', 'device_id_conflict'))} FROM identity
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {_order}) = 1""")


# --- quality reports ----------------------------------------------------------------------
def _profile(table: str, columns) -> str:
    return " UNION ALL ".join(f"""
      SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT("{c}") AS missing_count,
        round_even((COUNT(*) - COUNT("{c}")) / COUNT(*) * 100 * 100, 0) / 100 AS missing_pct,
        COUNT(DISTINCT "{c}") AS unique_values FROM {table}""" for c in columns)


for _t in ("identity", "iam", "endpoint"):
    add(f"{_t}_quality_report", _t, _profile(_t, CLEAN_COLUMNS[_t]))
add("firewall_quality_report", "firewall", _profile("firewall", RAW_COLUMNS["firewall"]))


def _summary(figures: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(({q}) AS BIGINT) AS value" for m, q in figures.items())


def _n(table: str, condition: str = "TRUE") -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


def _common(raw: str, table: str, dup: str, rows: str) -> dict[str, str]:
    return {"raw_rows": _n(raw), dup: f"({_n(raw)}) - ({_n(table)})", rows: _n(table)}


add("identity_pipeline_summary", ("raw_identity", "identity"), _summary({
    **_common("raw_identity", "identity", "exact_duplicate_rows", "clean_rows"),
    "duplicate_user_id_rows": """SELECT COUNT(*) FROM (SELECT COUNT(*) OVER (PARTITION BY user_id) AS n
        FROM identity) WHERE n > 1""",
    **{f"missing_{c}": _n("identity", f"{c} IS NULL") for c in ("user_id", "username", "hostname", "device_id")},
    "device_conflict_records": _n("identity", "device_id_conflict"),
    "conflicting_devices": "SELECT COUNT(DISTINCT device_id) FROM identity WHERE device_id_conflict",
    "termination_before_hire": _n("identity", "termination_date < hire_date"),
    # texts that are no token of absence, less those that gave a date
    "unparsed_dates": """SELECT (SELECT COUNT(*) FILTER (WHERE lower(trim(hire_date)) NOT IN ('not available', 'na', 'n/a', 'none', 'null', ''))
        + COUNT(*) FILTER (WHERE lower(trim(termination_date)) NOT IN ('not available', 'na', 'n/a', 'none', 'null', ''))
        FROM (SELECT DISTINCT * FROM raw_identity)) - (SELECT COUNT(hire_date) + COUNT(termination_date) FROM identity)""",
}))
_iam_conf = "SELECT device_id FROM iam WHERE device_id IS NOT NULL GROUP BY device_id HAVING COUNT(DISTINCT user_id) > 1"
add("iam_pipeline_summary", ("raw_iam", "iam"), _summary({
    **_common("raw_iam", "iam", "exact_duplicates_removed", "final_rows"),
    "raw_columns": "15", "final_columns": "17",
    "duplicate_event_ids": "SELECT COUNT(*) - COUNT(DISTINCT COALESCE(event_id, '~')) FROM iam",
    "missing_timestamps": _n("iam", '"timestamp" IS NULL'), "missing_user_ids": _n("iam", "user_id IS NULL"),
    "missing_session_ids": _n("iam", "session_id IS NULL"),
    "unparsed_timestamps": """SELECT (SELECT COUNT(*) FILTER (WHERE trim("timestamp") <> '') FROM (SELECT DISTINCT * FROM raw_iam))
        - (SELECT COUNT("timestamp") FROM iam)""",
    "device_conflicting_ids": f"SELECT COUNT(*) FROM ({_iam_conf})",
    "device_conflict_records": _n("iam", f"device_id IN ({_iam_conf})"),
}))
add("endpoint_pipeline_summary", ("raw_endpoint", "endpoint"), _summary({
    **_common("raw_endpoint", "endpoint", "exact_duplicate_rows_removed", "final_rows"),
    "raw_unique_alert_ids": "SELECT COUNT(DISTINCT alert_id) FROM raw_endpoint",
    "final_unique_alert_ids": "SELECT COUNT(DISTINCT alert_id) FROM endpoint",
    "remaining_duplicate_alert_id_rows": _n("endpoint", "duplicate_alert_id_flag"),
    "missing_user_id": _n("endpoint", "user_id IS NULL"), "missing_hostname": _n("endpoint", "hostname IS NULL"),
    **{n: _n("endpoint", f"{n}_flag") for n in (
        "invalid_detected_timestamp", "invalid_resolved_timestamp", "impossible_resolution",
        "resolved_without_timestamp", "unresolved_with_resolution_timestamp", "invalid_sha256")},
    "missing_sha256": _n("endpoint", "sha256_missing_flag"),
    "rows_requiring_review": _n("endpoint", "data_quality_issue_count > 0"),
}))
add("firewall_pipeline_summary", ("raw_firewall", "firewall"), _summary({
    **_common("raw_firewall", "firewall", "exact_duplicate_rows", "clean_rows"),
    "clean_columns": "22",
    "duplicate_log_ids": "SELECT COUNT(*) - COUNT(DISTINCT COALESCE(log_id, '~')) FROM firewall",
    "missing_log_ids": _n("firewall", "log_id IS NULL"),
    "standardized_timestamps": _n("firewall", '"timestamp" IS NOT NULL'),
    "missing_timestamps": _n("firewall", '"timestamp" IS NULL'),
    "unique_hostnames": "SELECT COUNT(DISTINCT hostname) FROM firewall",
    "missing_hostnames": _n("firewall", "hostname IS NULL"),
    "unique_hostname_join_keys": "SELECT COUNT(DISTINCT hostname_join_key) FROM firewall",
    **{f"{w}_{c}": _n("firewall", t.format(c=c)) for c in ("src_ip", "dst_ip") for w, t in (
        ("valid", "{c}_valid"), ("invalid", "NOT {c}_valid"), ("missing", "{c} IS NULL"))},
    **{f"{w}_{c}": _n("firewall", t.format(c=c)) for c in ("src_port", "dst_port") for w, t in (
        ("valid", "{c}_status = 'valid'"), ("invalid", "{c}_status = 'invalid'"), ("missing", "{c} IS NULL"))},
    "threat_flag_true": _n("firewall", "threat_flag"), "threat_flag_false": _n("firewall", "NOT threat_flag"),
    "valid_session_ids": _n("firewall", "session_id IS NOT NULL"),
    "missing_session_ids": _n("firewall", "session_id IS NULL"),
    "missing_rule_names": _n("firewall", "rule_name IS NULL"),
    "missing_geo_country": _n("firewall", "geo_country IS NULL"),
}))
add("device_conflict_summary", ("identity", "iam"), " UNION ALL ".join(f"""
    SELECT '{t}' AS source, COUNT(*) AS conflicting_devices, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS conflict_records
    FROM (SELECT device_id, COUNT(*) AS n FROM {t} WHERE device_id IS NOT NULL GROUP BY device_id
          HAVING COUNT(DISTINCT user_id) > 1)""" for t in ("identity", "iam")))
add("endpoint_domain_violations", "endpoint", _summary({
    "severity_outside_domain": _n("endpoint", "severity NOT IN ('Critical', 'High', 'Medium', 'Low')"),
    "status_outside_domain": _n(
        "endpoint", "status NOT IN ('New', 'Open', 'In Progress', 'Resolved', 'Closed', 'Unassigned')"),
    "criticality_outside_domain": _n("endpoint", "device_criticality NOT IN ('Critical', 'High', 'Medium', 'Low')"),
    "impossible_without_both_times": _n(
        "endpoint", "impossible_resolution_flag AND (detected_timestamp IS NULL OR resolved_timestamp IS NULL)"),
}))
add("iam_value_ranges", "iam", """
    SELECT MIN(risk_score) AS risk_score_min, MAX(risk_score) AS risk_score_max,
      CAST(MIN("timestamp") AS VARCHAR) AS timestamp_min, CAST(MAX("timestamp") AS VARCHAR) AS timestamp_max FROM iam""")
add("firewall_value_counts", "firewall", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", {c} AS value, COUNT(*) AS rows FROM firewall WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in ("protocol", "action", "geo_country")))


# --- linkage ----------------------------------------------------------------------------
def _host(x: str, compat: bool) -> str:
    clean = f"replace(lower(trim({x})), '_', '-')"
    cut = f"CASE WHEN ends_with({clean}, '.corp.local') THEN left({clean}, length({clean}) - {10 if compat else 11}) ELSE {clean} END"
    return f"NULLIF({cut}, '')"


def _strength(rate: str) -> str:
    return f"CASE WHEN {rate} >= 90 THEN 'Strong' WHEN {rate} >= 75 THEN 'Moderate' ELSE 'Weak' END"


def _coverage(name: str, rel: str, table: str, key: str, known: str) -> str:
    return f"""
      SELECT '{name}' AS source, '{rel}' AS relationship, {_strength('rate')} AS relationship_status, rows,
        CAST(matched AS VARCHAR) AS matched, CAST(missing AS VARCHAR) AS missing,
        CAST(rows - missing - matched AS VARCHAR) AS unmatched, round_even(rate * 100, 0) / 100 AS match_rate_pct,
        NULL AS usable_pairs, NULL AS consistent_pairs, NULL AS inconsistent_pairs, NULL AS consistency_rate_pct
      FROM (SELECT *, CASE WHEN rows > missing THEN matched / (rows - missing) * 100 ELSE 0 END AS rate FROM (
        SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE k IS NULL) AS missing,
          COUNT(*) FILTER (WHERE k IN (SELECT DISTINCT {known} FROM identity WHERE {known} IS NOT NULL)) AS matched
        FROM (SELECT {key} AS k FROM {table})))"""


def _pairs(name: str, table: str, compat: bool) -> str:
    h = _host("hostname", compat)
    return f"""
      SELECT '{name}' AS source, 'user_id + hostname -> identity' AS relationship,
        {_strength('rate')} AS relationship_status, rows, NULL AS matched, NULL AS missing, NULL AS unmatched,
        NULL AS match_rate_pct, CAST(usable AS VARCHAR) AS usable_pairs, CAST(good AS VARCHAR) AS consistent_pairs,
        CAST(usable - good AS VARCHAR) AS inconsistent_pairs, round_even(rate * 100, 0) / 100 AS consistency_rate_pct
      FROM (SELECT *, CASE WHEN usable > 0 THEN good / usable * 100 ELSE 0 END AS rate FROM (
        SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE u IS NOT NULL AND h IS NOT NULL) AS usable,
          COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM identity i WHERE upper(i.user_id) = u AND {_host('i.hostname', compat)} = h)) AS good
        FROM (SELECT upper(user_id) AS u, {h} AS h FROM {table})))"""


for _name, _compat in (("relationship_quality_report", False), ("relationship_quality_report_compat", True)):
    _h = _host("hostname", _compat)
    _k = _host("hostname_join_key", _compat)
    add(_name, ("identity", "iam", "endpoint", "firewall"), " UNION ALL ".join([
        _coverage("IAM", "user_id -> identity", "iam", "upper(user_id)", "upper(user_id)"),
        _coverage("IAM", "hostname -> identity", "iam", _h, _h),
        _coverage("IAM", "device_id -> identity", "iam", "upper(device_id)", "upper(device_id)"),
        _pairs("IAM", "iam", _compat),
        _coverage("Endpoint", "user_id -> identity", "endpoint", "upper(user_id)", "upper(user_id)"),
        _coverage("Endpoint", "hostname -> identity", "endpoint", _k, _h),
        _pairs("Endpoint", "endpoint", _compat),
        _coverage("Firewall", "hostname -> identity", "firewall", _k, _h),
    ]))
for _name, _col, _expr in (("ambiguous_hostnames", "hostname_join_key", _host("hostname", False)),
                           ("ambiguous_devices", "device_key", "upper(device_id)")):
    add(_name, "identity", f"""SELECT {_expr} AS {_col}, COUNT(DISTINCT user_id) AS distinct_user_count FROM identity
        WHERE {_expr} IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT user_id) > 1""")
_SESSIONS = """(SELECT DISTINCT upper(session_id) AS s FROM {t} WHERE trim(session_id) <> '')"""
_a, _f = _SESSIONS.format(t="iam"), _SESSIONS.format(t="firewall")
add("session_relationship_report", ("iam", "firewall"), f"""
    SELECT 'IAM session_id <-> Firewall session_id' AS relationship, 'Weak / Rejected' AS relationship_status,
      a AS iam_unique_sessions, f AS firewall_unique_sessions, s AS shared_session_ids,
      a - s AS iam_only_sessions, f - s AS firewall_only_sessions,
      round_even(s / a * 100 * 100, 0) / 100 AS session_match_rate_iam_pct,
      round_even(s / f * 100 * 100, 0) / 100 AS session_match_rate_firewall_pct
    FROM (SELECT (SELECT COUNT(*) FROM {_a}) AS a, (SELECT COUNT(*) FROM {_f}) AS f,
      (SELECT COUNT(*) FROM (SELECT s FROM {_a} INTERSECT SELECT s FROM {_f})) AS s)""")
CTES["iam_sessions"] = (("iam",), f"""SELECT upper(session_id) AS s, {_host('hostname', False)} AS h,
    epoch_us("timestamp") AS us FROM iam WHERE trim(session_id) <> ''""")
CTES["firewall_sessions"] = (("firewall",), f"""SELECT upper(session_id) AS s, {_host('hostname', False)} AS h,
    epoch_us("timestamp") AS us FROM firewall WHERE trim(session_id) <> ''""")
CTES["session_pairs"] = (("iam_sessions", "firewall_sessions"), """
    SELECT a.s AS s, MIN(ABS(a.us - f.us)) / 1000000 AS lo, MAX(ABS(a.us - f.us)) / 1000000 AS hi,
      MEDIAN(ABS(a.us - f.us)) / 1000000 AS mid,
      COUNT(DISTINCT CASE WHEN a.h = f.h THEN a.h END) AS common
    FROM iam_sessions a JOIN firewall_sessions f ON a.s = f.s GROUP BY a.s""")
CTES["evidence"] = (("session_pairs",), """
    SELECT p.s AS session_id, (SELECT COUNT(*) FROM iam_sessions a WHERE a.s = p.s) AS iam_rows,
      (SELECT COUNT(*) FROM firewall_sessions f WHERE f.s = p.s) AS firewall_rows,
      common > 0 AS hostname_overlap, lo IS NOT NULL AS timestamp_evidence, lo AS min_time_difference_seconds,
      COALESCE(lo <= 3600, FALSE) AS within_60_minutes FROM session_pairs p""")
add("shared_session_evidence", "evidence", """SELECT session_id, iam_rows, firewall_rows,
    CAST(hostname_overlap AS VARCHAR) AS hostname_overlap, CAST(timestamp_evidence AS VARCHAR) AS timestamp_evidence,
    min_time_difference_seconds, CAST(within_60_minutes AS VARCHAR) AS within_60_minutes FROM evidence""")
add("session_hostname_consistency_report", "evidence", """
    SELECT COUNT(*) AS shared_sessions_checked, COUNT(*) FILTER (WHERE hostname_overlap) AS hostname_consistent_sessions,
      COUNT(*) FILTER (WHERE NOT hostname_overlap AND timestamp_evidence) AS hostname_inconsistent_sessions,
      COUNT(*) FILTER (WHERE NOT hostname_overlap AND NOT timestamp_evidence) AS sessions_without_hostname_evidence,
      COUNT(*) FILTER (WHERE within_60_minutes) AS timestamp_within_60_minutes,
      'Rejected' AS session_join_decision FROM evidence""")
_side = "SELECT s, COUNT(*) AS n, COUNT(us) AS nt, COUNT(DISTINCT h) AS nh FROM {t} GROUP BY s"
add("shared_session_diagnostic", "session_pairs", f"""
    SELECT p.s AS session_id, a.n AS iam_rows, f.n AS firewall_rows, a.nh AS iam_hostname_count,
      f.nh AS firewall_hostname_count, common AS common_hostname_count, a.nt AS iam_timestamp_count,
      f.nt AS firewall_timestamp_count, lo AS min_time_diff_seconds, mid AS median_time_diff_seconds, hi AS max_time_diff_seconds,
      CAST(common > 0 AS VARCHAR) AS hostname_match
    FROM session_pairs p JOIN ({_side.format(t='iam_sessions')}) a ON a.s = p.s
      JOIN ({_side.format(t='firewall_sessions')}) f ON f.s = p.s""")
add("shared_session_hosts", "session_pairs", """
    SELECT s AS session_id, h AS host, CAST(MAX(i) = 1 AS VARCHAR) AS by_iam, CAST(MIN(i) = 0 AS VARCHAR) AS by_firewall
    FROM (SELECT s, h, 1 AS i FROM iam_sessions UNION ALL SELECT s, h, 0 FROM firewall_sessions)
    WHERE h IS NOT NULL AND s IN (SELECT s FROM session_pairs) GROUP BY s, h""")


# --- user risk ----------------------------------------------------------------------------
def _key(x: str) -> str:
    return (f"CASE WHEN upper(trim({x})) IN ('', 'NAN', 'NONE', 'NULL', 'NA', '<NA>') THEN NULL "
            f"WHEN regexp_full_match(trim({x}), '[0-9]+') THEN 'EMP' || trim({x}) ELSE upper(trim({x})) END")


_rec = ", ".join(f"COALESCE({c}, '')" for c in (
    "full_name", "hostname", "device_id", "role", "department", "status", "username"))
CTES["id_users"] = (("identity",), f"""
    SELECT {_key('user_id')} AS user_key,
      {', '.join(f"first({c} ORDER BY {_rec}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ('username', 'department', 'role', 'status'))},
      COUNT(DISTINCT hostname) AS hostname_count, COUNT(DISTINCT device_id) AS device_count,
      MAX(termination_date) AS termination_date
    FROM identity WHERE {_key('user_id')} IS NOT NULL GROUP BY 1""")
add("identity_user_rollup", "id_users",
    "SELECT * REPLACE (CAST(termination_date AS VARCHAR) AS termination_date) FROM id_users")
CTES["iam_f"] = (("iam",), f"""
    SELECT *, {_key('user_id')} AS user_key, upper(trim(user_id)) AS link_user, {_host('hostname', False)} AS h,
      epoch_us("timestamp") AS us,
      COALESCE(lower(event_type), '') LIKE '%fail%' OR COALESCE(lower(event_type), '') LIKE '%denied%'
        OR COALESCE(lower(event_type), '') LIKE '%reject%' OR COALESCE(length(failure_reason), 0) > 0 AS failed,
      COALESCE(mfa_passed = FALSE, FALSE) AS mfa, COALESCE(risk_score >= 70, FALSE) AS high FROM iam""")
CTES["end_f"] = (("endpoint",), f"""
    SELECT *, {_key('user_id')} AS user_key, upper(trim(user_id)) AS link_user, {_host('hostname', False)} AS h,
      epoch_us(detected_timestamp) AS us,
      txt LIKE '%malware%' OR txt LIKE '%ransomware%' OR txt LIKE '%trojan%' AS malware,
      txt LIKE '%credential%' OR txt LIKE '%keylogger%' AS cred,
      txt LIKE '%lateral%' OR txt LIKE '%admin share%' AS lateral_move,
      txt LIKE '%powershell%' AS ps, txt LIKE '%usb%' AS usb,
      txt LIKE '%disable security%' OR txt LIKE '%tamper%' AS tamper
    FROM (SELECT *, lower(COALESCE(alert_name, '') || ' ' || COALESCE(description, '') || ' ' || COALESCE(process_name, '')) AS txt
          FROM endpoint)""")
_n_if = lambda c: f"COUNT(*) FILTER (WHERE {c})"
CTES["iam_u"] = (("iam_f",), f"""
    SELECT user_key, COUNT(event_id) AS iam_events, {_n_if('failed')} AS iam_failed_auth, {_n_if('mfa')} AS iam_mfa_failures,
      {_n_if('high')} AS iam_high_risk_events, round_even(AVG(risk_score) * 100, 0) / 100 AS iam_avg_risk_score,
      MAX(risk_score) AS iam_max_risk_score, COUNT(DISTINCT hostname) AS iam_hostname_count,
      COUNT(DISTINCT session_id) AS iam_session_count
    FROM iam_f WHERE user_key IS NOT NULL GROUP BY user_key""")
CTES["end_u"] = (("end_f",), f"""
    SELECT user_key, COUNT(alert_id) AS endpoint_alerts,
      {_n_if("severity = 'Critical'")} AS endpoint_critical_alerts, {_n_if("severity = 'High'")} AS endpoint_high_alerts,
      {_n_if("severity = 'Critical' AND unresolved_alert_flag")} AS endpoint_unresolved_critical,
      {_n_if('malware')} AS endpoint_malware_alerts, {_n_if('cred')} AS endpoint_credential_alerts,
      {_n_if('lateral_move')} AS endpoint_lateral_movement, {_n_if('ps')} AS endpoint_powershell,
      {_n_if('tamper')} AS endpoint_tampering, {_n_if('usb')} AS endpoint_usb,
      {_n_if('impossible_resolution_flag')} AS endpoint_impossible_resolution,
      COUNT(DISTINCT hostname) AS endpoint_hostname_count
    FROM end_f WHERE user_key IS NOT NULL GROUP BY user_key""")
add("iam_user_rollup", "iam_u", "SELECT * FROM iam_u")
add("endpoint_user_rollup", "end_u", "SELECT * FROM end_u")
CTES["post_u"] = (("id_users", "iam_f", "end_f"), """
    SELECT user_key, COUNT(*) FILTER (WHERE src = 0) AS iam_events, COUNT(*) FILTER (WHERE src = 1) AS endpoint_events,
      MIN(us) AS first_us, MAX(us) AS last_us,
      first(hostname ORDER BY src, us, hostname) FILTER (WHERE hostname IS NOT NULL) AS hostname
    FROM (SELECT user_key, us, hostname, 0 AS src FROM iam_f UNION ALL SELECT user_key, us, hostname, 1 FROM end_f)
      JOIN id_users USING (user_key) WHERE us > epoch_us(termination_date) GROUP BY user_key""")
add("post_termination_counts", "post_u", "SELECT user_key, iam_events, endpoint_events FROM post_u")
_min = lambda c, w, top: f"LEAST({c} * {w}, {top})"
_zero = (
    "iam_events iam_failed_auth iam_mfa_failures iam_high_risk_events iam_avg_risk_score iam_max_risk_score "
    "iam_hostname_count iam_session_count endpoint_alerts endpoint_critical_alerts endpoint_high_alerts "
    "endpoint_unresolved_critical endpoint_malware_alerts endpoint_credential_alerts endpoint_lateral_movement "
    "endpoint_powershell endpoint_tampering endpoint_usb endpoint_impossible_resolution endpoint_hostname_count"
).split()
CTES["risk0"] = (("id_users", "iam_u", "end_u", "post_u"), f"""
    SELECT i.user_key AS user_id, username, department, role, status, hostname_count, device_count,
      {', '.join(f'COALESCE({c}, 0) AS {c}' for c in _zero)}, termination_date,
      COALESCE(p.iam_events, 0) AS post_termination_iam_events, COALESCE(p.endpoint_events, 0) AS post_termination_endpoint_events,
      COALESCE(p.iam_events, 0) + COALESCE(p.endpoint_events, 0) AS post_termination_activity
    FROM id_users i LEFT JOIN iam_u ON i.user_key = iam_u.user_key LEFT JOIN end_u ON i.user_key = end_u.user_key
      LEFT JOIN post_u p ON i.user_key = p.user_key""".replace("COALESCE(iam_events, 0)", "COALESCE(iam_u.iam_events, 0)"))
CTES["risk1"] = (("risk0",), f"""
    SELECT *, LEAST({_min('iam_failed_auth', 1, 10)} + {_min('iam_mfa_failures', 1.5, 10)}, 20)::DOUBLE AS authentication_risk,
      LEAST({_min('iam_high_risk_events', 2, 15)} + CASE WHEN iam_failed_auth >= 5 AND iam_high_risk_events >= 3 THEN 5 ELSE 0 END, 20)::DOUBLE AS iam_risk,
      LEAST({_min('endpoint_critical_alerts', 5, 15)} + {_min('endpoint_high_alerts', 2, 5)}, 20)::DOUBLE AS endpoint_severity_risk,
      LEAST({_min('endpoint_malware_alerts', 6, 12)} + {_min('endpoint_credential_alerts', 6, 8)}
        + {_min('endpoint_lateral_movement', 6, 8)} + {_min('endpoint_powershell', 3, 4)}
        + {_min('endpoint_tampering', 4, 5)} + {_min('endpoint_usb', 1, 2)}, 30)::DOUBLE AS threat_behavior_risk,
      LEAST({_min('post_termination_activity', 3, 10)} + {_min('endpoint_unresolved_critical', 2, 5)}, 15)::DOUBLE AS contextual_risk
    FROM risk0""")
CTES["risk2"] = (("risk1",), """
    SELECT *, LEAST(CASE WHEN authentication_risk >= 8 AND threat_behavior_risk >= 6 THEN 5 ELSE 0 END
      + CASE WHEN endpoint_malware_alerts > 0 AND endpoint_credential_alerts > 0 THEN 5 ELSE 0 END
      + CASE WHEN endpoint_malware_alerts > 0 AND endpoint_lateral_movement > 0 THEN 5 ELSE 0 END
      + CASE WHEN iam_mfa_failures >= 3 AND iam_high_risk_events >= 3 THEN 3 ELSE 0 END, 10)::DOUBLE AS cross_signal_bonus
    FROM risk1""")
_drivers = [
    ("iam_high_risk_events", "high-risk IAM events"), ("endpoint_malware_alerts", "malware alerts"),
    ("endpoint_credential_alerts", "credential-access alerts"),
    ("endpoint_lateral_movement", "lateral-movement alerts"), ("endpoint_powershell", "PowerShell alerts"),
    ("endpoint_tampering", "security-tampering alerts"), ("endpoint_critical_alerts", "critical endpoint alerts"),
    ("post_termination_activity", "events after identity termination"),
    ("endpoint_unresolved_critical", "unresolved critical alerts"),
]
CTES["risk"] = (("risk2",), f"""
    SELECT *, CASE WHEN risk_score <= 24 THEN 'Low' WHEN risk_score <= 49 THEN 'Medium' WHEN risk_score <= 74 THEN 'High'
        ELSE 'Critical' END AS risk_band,
      COALESCE(NULLIF(concat_ws('; ',
        CASE WHEN authentication_risk >= 8 THEN 'elevated authentication risk (' || iam_failed_auth || ' failed auth, '
          || iam_mfa_failures || ' MFA failures)' WHEN iam_failed_auth > 0 THEN iam_failed_auth || ' failed authentication events' END,
        {', '.join(f"CASE WHEN {c} > 0 THEN {c} || ' {t}' END" for c, t in _drivers)}), ''),
        'No high-priority risk drivers') AS risk_drivers
    FROM (SELECT *, LEAST(authentication_risk + iam_risk + endpoint_severity_risk + threat_behavior_risk + contextual_risk
      + cross_signal_bonus, 100)::DOUBLE AS risk_score FROM risk2)""")
_risk_out = """SELECT *, risk_band AS risk_level, CAST(post_termination_activity > 0 AS VARCHAR) AS post_termination_activity_flag
    FROM (SELECT * REPLACE (CAST(termination_date AS VARCHAR) AS termination_date) FROM risk)"""
add("user_risk_scores", "risk", _risk_out)
add("risk_band_distribution", "risk", """
    SELECT b AS risk_band, (SELECT COUNT(*) FROM risk WHERE risk_band = b) AS user_count,
      round_even((SELECT COUNT(*) FROM risk WHERE risk_band = b) / (SELECT COUNT(*) FROM risk) * 100 * 100, 0) / 100 AS percentage
    FROM (VALUES ('Low'), ('Medium'), ('High'), ('Critical')) AS v(b)""")
add("top_100_risk_users", "risk", f"""{_risk_out}
    ORDER BY risk_score DESC, endpoint_critical_alerts DESC, user_id LIMIT 100""")


# --- detections ---------------------------------------------------------------------------
def _ts(us: str) -> str:
    return f"make_timestamp({us})"


CTES["t_post"] = (("post_u",), f"""
    SELECT 1 AS rule, user_key AS user_id, 'Post-Termination Activity' AS threat_type, 'Critical' AS severity,
      CASE WHEN iam_events > 0 AND endpoint_events > 0 THEN 'High' ELSE 'Medium' END AS confidence,
      concat_ws(' and ', CASE WHEN iam_events > 0 THEN iam_events || ' IAM' END,
        CASE WHEN endpoint_events > 0 THEN endpoint_events || ' endpoint' END)
        || ' events occurred after the recorded termination date'
        || CASE WHEN iam_events > 0 AND endpoint_events > 0 THEN '; corroborated across IAM and endpoint telemetry' ELSE '' END AS evidence,
      {_ts('first_us')} AS first_observed, {_ts('last_us')} AS last_observed, hostname AS related_hostname,
      iam_events + endpoint_events AS related_alert_count,
      CASE WHEN iam_events > 0 AND endpoint_events > 0 THEN 'Immediately review account status and both IAM and endpoint activity; revoke unauthorized access if confirmed'
        ELSE 'Review post-termination telemetry, account status, and access authorization' END AS recommended_action
    FROM post_u""")
_DAY = 86400000000
CTES["anchors"] = (("iam_f", "end_f"), f"""
    SELECT a.link_user AS u, a.us AS us,
      (SELECT COUNT(*) FROM iam_f w WHERE w.link_user = a.link_user AND w.us BETWEEN a.us AND a.us + {_DAY} AND w.failed) AS failed,
      (SELECT COUNT(*) FROM iam_f w WHERE w.link_user = a.link_user AND w.us BETWEEN a.us AND a.us + {_DAY} AND w.mfa) AS mfa,
      (SELECT COUNT(*) FROM end_f w WHERE w.link_user = a.link_user AND w.us BETWEEN a.us AND a.us + {_DAY} AND w.cred) AS cred
    FROM (SELECT DISTINCT link_user, us FROM iam_f WHERE us IS NOT NULL AND link_user IS NOT NULL) a""")
CTES["t_cred"] = (("anchors",), f"""
    SELECT 2 AS rule, u AS user_id, 'Potential Credential Compromise' AS threat_type, 'High' AS severity, 'High' AS confidence,
      failed || ' failed authentication events, ' || mfa || ' MFA failures, and ' || cred
        || ' credential-access endpoint alerts within 24 hours' AS evidence,
      {_ts('us')} AS first_observed,
      {_ts(f'''(SELECT MAX(t) FROM (SELECT w.us AS t FROM iam_f w WHERE w.link_user = u AND w.us BETWEEN k.us AND k.us + {_DAY}
         UNION ALL SELECT w.us FROM end_f w WHERE w.link_user = u AND w.cred AND w.us BETWEEN k.us AND k.us + {_DAY}))''')} AS last_observed,
      (SELECT first(h ORDER BY src, t, h) FROM (SELECT w.h AS h, 0 AS src, w.us AS t FROM iam_f w
          WHERE w.link_user = u AND w.us BETWEEN k.us AND k.us + {_DAY} AND w.h IS NOT NULL
        UNION ALL SELECT w.h, 1, w.us FROM end_f w WHERE w.link_user = u AND w.cred AND w.us BETWEEN k.us AND k.us + {_DAY}
          AND w.h IS NOT NULL)) AS related_hostname,
      cred AS related_alert_count,
      'Investigate the authentication sequence, MFA failures, and credential-access activity' AS recommended_action
    FROM (SELECT * FROM anchors WHERE failed >= 3 AND mfa >= 2 AND cred >= 1
          QUALIFY ROW_NUMBER() OVER (PARTITION BY u ORDER BY us) = 1) k""")
_pair = "LEAST(l, r)", "GREATEST(l, r)"
CTES["t_mal"] = (("end_f",), f"""
    SELECT 3 AS rule, u AS user_id, 'Malware + Lateral Movement' AS threat_type,
      CASE WHEN host IS NOT NULL THEN 'Critical' ELSE 'High' END AS severity,
      CASE WHEN host IS NOT NULL THEN 'High' ELSE 'Medium' END AS confidence,
      CASE WHEN host IS NOT NULL THEN 'Malware and lateral-movement alerts were observed on the same hostname (' || host || ') within 24 hours'
        ELSE 'Malware and lateral-movement alerts were observed for the same user within 24 hours, but same-host corroboration was unavailable' END AS evidence,
      {_ts(_pair[0])} AS first_observed, {_ts(_pair[1])} AS last_observed, host AS related_hostname, CAST(2 AS BIGINT) AS related_alert_count,
      CASE WHEN host IS NOT NULL THEN 'Isolate the affected endpoint and investigate lateral-movement indicators immediately'
        ELSE 'Review endpoint telemetry and validate the affected asset before escalation' END AS recommended_action
    FROM (SELECT a.link_user AS u, a.us AS l, b.us AS r, CASE WHEN a.h = b.h THEN a.h END AS host
      FROM end_f a JOIN end_f b ON a.link_user = b.link_user AND a.malware AND b.lateral_move AND ABS(a.us - b.us) <= {_DAY}
      QUALIFY ROW_NUMBER() OVER (PARTITION BY a.link_user
        ORDER BY CASE WHEN a.h = b.h THEN 0 ELSE 1 END, ABS(a.us - b.us), a.us, b.us, CASE WHEN a.h = b.h THEN a.h END) = 1)""")
CTES["t_adm"] = (("iam_f", "end_f"), f"""
    SELECT 4 AS rule, u AS user_id, 'Suspicious Administrative Activity' AS threat_type, 'High' AS severity,
      CASE WHEN host IS NOT NULL THEN 'High' ELSE 'Medium' END AS confidence,
      'A high-risk IAM event and ' || concat_ws(' and ', CASE WHEN ps THEN 'PowerShell' END, CASE WHEN tamper THEN 'security-tampering' END)
        || ' activity were observed ' || CASE WHEN host IS NOT NULL THEN 'on the same hostname (' || host || ') within 24 hours'
        ELSE 'for the same user within 24 hours, but same-host corroboration was unavailable' END AS evidence,
      {_ts(_pair[0])} AS first_observed, {_ts(_pair[1])} AS last_observed, host AS related_hostname, CAST(2 AS BIGINT) AS related_alert_count,
      'Review the administrative command/process activity and ' || CASE WHEN host IS NOT NULL THEN '' ELSE 'validate the ' END
        || 'associated account actions' AS recommended_action
    FROM (SELECT a.link_user AS u, a.us AS l, b.us AS r, b.ps AS ps, b.tamper AS tamper, CASE WHEN a.h = b.h THEN a.h END AS host
      FROM iam_f a JOIN end_f b ON a.link_user = b.link_user AND a.high AND (b.ps OR b.tamper) AND ABS(a.us - b.us) <= {_DAY}
      QUALIFY ROW_NUMBER() OVER (PARTITION BY a.link_user
        ORDER BY CASE WHEN a.h = b.h THEN 0 ELSE 1 END, ABS(a.us - b.us), a.us, b.us, CASE WHEN a.h = b.h THEN a.h END,
          b.alert_id, b.ps, b.tamper) = 1)""")
for _name, _compat in (("t_mis", False), ("t_mis_compat", True)):
    _h = _host("hostname", _compat)
    CTES[_name] = (("identity", "iam_f", "end_f"), f"""
    SELECT 5 AS rule, u AS user_id, 'Identity / Hostname Mismatch' AS threat_type, 'Medium' AS severity, 'Medium' AS confidence,
      n || ' telemetry events observed on hostname ' || h2 || ', which is not assigned to this user in the identity master' AS evidence,
      {_ts('lo')} AS first_observed, {_ts('hi')} AS last_observed, h2 AS related_hostname, n AS related_alert_count,
      'Verify asset ownership, account sharing, and recent device changes' AS recommended_action
    FROM (SELECT u, h2, COUNT(*) AS n, MIN(us) AS lo, MAX(us) AS hi FROM (
        SELECT link_user AS u, {_h} AS h2, us FROM iam_f UNION ALL SELECT link_user, {_h}, us FROM end_f) e
      WHERE u IS NOT NULL AND h2 IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM identity i WHERE upper(i.user_id) = e.u AND {_host('i.hostname', _compat)} = e.h2)
      GROUP BY u, h2 HAVING COUNT(*) >= 2)""")
_det = """CAST(first_observed AS VARCHAR) AS first_observed, CAST(last_observed AS VARCHAR) AS last_observed"""
for _name, _cte in (("post_termination_detections", "t_post"), ("credential_compromise_detections", "t_cred"),
                    ("malware_lateral_detections", "t_mal"), ("administrative_abuse_detections", "t_adm"),
                    ("hostname_mismatch_detections", "t_mis"), ("hostname_mismatch_detections_compat", "t_mis_compat")):
    add(_name, _cte, f"SELECT * EXCLUDE (rule, first_observed, last_observed), CAST(rule AS BIGINT) AS rule, {_det} FROM {_cte}")
add("temporal_closest_pairs", ("iam_f", "end_f"), f"""
    SELECT a.link_user AS user_key, ABS(a.us - b.us) / 3600000000 AS delta_hours,
      CAST({_ts('a.us')} AS VARCHAR) AS timestamp_left, CAST({_ts('b.us')} AS VARCHAR) AS timestamp_right
    FROM iam_f a JOIN end_f b ON a.link_user = b.link_user AND a.high AND (b.ps OR b.tamper) AND ABS(a.us - b.us) <= {_DAY}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY a.link_user ORDER BY ABS(a.us - b.us), a.us, b.us) = 1""")
CTES["threats"] = (("t_post", "t_cred", "t_mal", "t_adm", "t_mis"), """
    SELECT 'THR' || CASE WHEN rn < 100000 THEN lpad(CAST(rn AS VARCHAR), 5, '0') ELSE CAST(rn AS VARCHAR) END AS threat_id,
      * EXCLUDE (rule, rn)
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY rule, user_id, related_hostname NULLS FIRST) AS rn FROM (
      SELECT * FROM t_post UNION ALL SELECT * FROM t_cred UNION ALL SELECT * FROM t_mal
      UNION ALL SELECT * FROM t_adm UNION ALL SELECT * FROM t_mis))""")
add("threat_detections", "threats", f"SELECT * EXCLUDE (first_observed, last_observed), {_det} FROM threats")
add("threat_type_summary", "threats", "SELECT threat_type, COUNT(*) AS detection_count FROM threats GROUP BY 1")
add("threat_severity_summary", "threats", "SELECT severity, COUNT(*) AS detection_count FROM threats GROUP BY 1")
add("threat_affected_users", "threats",
    "SELECT COUNT(*) AS detections, COUNT(DISTINCT user_id) AS affected_users FROM threats")

# --- queue ----------------------------------------------------------------------------------
_level = lambda v, names: "CASE " + v + " " + " ".join(f"WHEN {r} THEN '{n}'" for n, r in names) + " ELSE 'Low' END"
_sev = "MAX(CASE severity WHEN 'Critical' THEN 3 WHEN 'High' THEN 2 WHEN 'Medium' THEN 1 ELSE 0 END)"
_conf = "MAX(CASE confidence WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 ELSE 0 END)"
CTES["corr"] = (("threats",), f"""
    SELECT user_id, COUNT(*) AS threat_detection_count, COUNT(DISTINCT threat_type) AS distinct_threat_types,
      string_agg(DISTINCT threat_type, ' | ' ORDER BY threat_type) AS threat_types,
      COUNT(*) FILTER (WHERE severity = 'Critical') AS critical_detections,
      COUNT(*) FILTER (WHERE severity = 'High') AS high_detections,
      COUNT(*) FILTER (WHERE severity = 'Medium') AS medium_detections,
      CAST({_sev} AS BIGINT) AS highest_severity_rank, CAST({_conf} AS BIGINT) AS highest_confidence_rank,
      {_level(_sev, (('Critical', 3), ('High', 2), ('Medium', 1)))} AS highest_severity,
      {_level(_conf, (('High', 3), ('Medium', 2), ('Low', 1)))} AS highest_confidence
    FROM threats GROUP BY user_id""")
add("threat_corroboration", "corr", "SELECT * FROM corr")
_qord = ", ".join(f'"{c}" ASC NULLS FIRST' for c in (
    "full_name", "role", "department", "location", "status", "username", "hostname", "device_id",
    "manager_username", "device_id_conflict", "device_user_count"))
CTES["ident1"] = (("identity",), f"""
    SELECT * FROM identity QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {_qord}) = 1""")
CTES["queue"] = (("risk", "corr", "ident1"), """
    SELECT ROW_NUMBER() OVER (ORDER BY investigation_priority_score DESC, risk_score DESC, critical_detections DESC,
        high_detections DESC, user_id) AS priority_rank, *,
      CASE WHEN investigation_priority_score >= 80 THEN 'Critical' WHEN investigation_priority_score >= 60 THEN 'High'
        WHEN investigation_priority_score >= 40 THEN 'Medium' ELSE 'Low' END AS investigation_priority,
      COALESCE(NULLIF(concat_ws('; ',
        CASE WHEN risk_score >= 80 THEN 'very high user risk score (' || printf('%.1f', risk_score) || ')'
             WHEN risk_score >= 60 THEN 'high user risk score (' || printf('%.1f', risk_score) || ')' END,
        CASE WHEN distinct_threat_types >= 2 THEN distinct_threat_types || ' distinct threat types' END,
        CASE WHEN critical_detections > 0 THEN critical_detections || ' critical detection(s)' END,
        CASE WHEN high_detections > 0 THEN high_detections || ' high-severity detection(s)' END), ''),
        threat_detection_count || ' threat detection(s)') AS investigation_reason,
      CASE WHEN critical_detections > 0 AND distinct_threat_types >= 2 THEN 'Immediate investigation: correlate endpoint, IAM and identity evidence; validate affected account and assets.'
        WHEN critical_detections > 0 THEN 'Prioritize investigation of critical telemetry and validate affected account and asset.'
        WHEN high_detections > 0 THEN 'Review high-severity detections and correlate supporting IAM and endpoint evidence.'
        ELSE 'Review detection evidence and validate identity and asset context.' END AS recommended_action
    FROM (SELECT r.user_id, i.full_name, r.department, r.role, r.status, i.location, i.hostname, i.device_id, r.risk_score,
        r.risk_band AS risk_level, i.device_id_conflict, i.device_user_count, c.* EXCLUDE (user_id, highest_severity_rank, highest_confidence_rank),
        LEAST(100, r.risk_score + CASE WHEN distinct_threat_types >= 2 THEN 5 ELSE 0 END
          + CASE WHEN distinct_threat_types >= 3 THEN 5 ELSE 0 END + CASE WHEN critical_detections >= 1 THEN 5 ELSE 0 END
          + CASE WHEN critical_detections >= 2 THEN 5 ELSE 0 END + CASE WHEN high_detections >= 2 THEN 2 ELSE 0 END)::DOUBLE AS investigation_priority_score
      FROM risk r JOIN corr c ON r.user_id = c.user_id LEFT JOIN ident1 i ON r.user_id = i.user_id)""")
add("investigation_queue", "queue",
    "SELECT * REPLACE (CAST(device_id_conflict AS VARCHAR) AS device_id_conflict) FROM queue")
add("investigation_queue_summary", "queue",
    "SELECT investigation_priority, COUNT(*) AS user_count FROM queue GROUP BY 1")


# --- investigation ----------------------------------------------------------------------------
_known = "SELECT upper(user_id) AS user_id FROM identity WHERE user_id IS NOT NULL UNION SELECT upper(user_id) FROM risk"
add("known_iam_users", ("identity", "risk", "iam"),
    f"SELECT DISTINCT user_id FROM iam WHERE user_id IN ({_known})")
CTES["mentioned"] = (("messages", "identity", "risk"), f"""
    SELECT conv_id, turn, user_id, user_id IN ({_known}) AS found, 'id' AS how FROM (
      SELECT conv_id, turn, CASE WHEN starts_with(m, 'USR') AND contains(m, '-') THEN m
          ELSE regexp_replace(m, '[\\s_-]', '', 'g') END AS user_id
      FROM (SELECT conv_id, turn, upper(unnest(regexp_extract_all(text,
        '(?i)\\b(EMP\\s*[-_]?\\s*\\d+|USR\\s*[-_]?\\s*\\d+)\\b', 1))) AS m FROM messages))
    UNION ALL
    SELECT conv_id, turn, n.user_id, TRUE, 'name' FROM messages m JOIN (
      SELECT user_id, full_name AS name FROM identity WHERE user_id IS NOT NULL
      UNION SELECT user_id, username FROM identity WHERE user_id IS NOT NULL) n
      ON length(n.name) >= 4 AND contains(lower(m.text), lower(n.name))
    WHERE regexp_matches(m.text, '(?i)\\b' || regexp_escape(n.name) || '\\b')""")
add("user_mentions", "mentioned", """SELECT conv_id, turn, user_id, CAST(bool_or(found) AS VARCHAR) AS found,
    MIN(how) AS how FROM mentioned GROUP BY conv_id, turn, user_id""")
_iord = ", ".join(f'"{c}" ASC NULLS FIRST' for c in CLEAN_COLUMNS["identity"] if c != "user_id")
CTES["context"] = (("identity",), f"""
    SELECT user_id, COALESCE(full_name, username, user_id) AS user_name, COALESCE(username, '') AS username,
      COALESCE(department, 'Unknown') AS department, COALESCE(role, 'Employee') AS role,
      COALESCE(location, 'Unknown') AS location, COALESCE(status, 'Active') AS employment_status, hire_date, termination_date,
      COALESCE(hostname, '') AS hostname, COALESCE(device_id, '') AS device_id, COALESCE(manager_username, 'None') AS manager,
      device_id_conflict, CASE WHEN COALESCE(device_user_count, 0) = 0 THEN 1 ELSE device_user_count END AS device_user_count,
      COALESCE(NULLIF(concat_ws(', ', NULLIF(hostname, ''), NULLIF(device_id, '')), ''), 'None') AS assigned_assets
    FROM identity WHERE user_id IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {_iord}) = 1""")
add("identity_context", "context", """SELECT * REPLACE (CAST(hire_date AS VARCHAR) AS hire_date,
    CAST(termination_date AS VARCHAR) AS termination_date, CAST(device_id_conflict AS VARCHAR) AS device_id_conflict)
    FROM context""")
_parts = (("authentication", "authentication_risk"), ("iam", "iam_risk"), ("endpoint", "endpoint_severity_risk"),
          ("threat_behaviour", "threat_behavior_risk"), ("context", "contextual_risk"), ("cross_signal", "cross_signal_bonus"))
_break = ", ".join(f"round_even({c} * 10, 0) / 10 AS {n}" for n, c in _parts)
add("user_risk_profile", "risk", f"""
    SELECT user_id, COALESCE(username, '') AS username, COALESCE(department, '') AS department, COALESCE(role, '') AS role,
      COALESCE(status, 'Active') AS status, round_even(risk_score * 10, 0) / 10 AS risk_score, risk_band, risk_drivers,
      CAST(post_termination_activity > 0 AS VARCHAR) AS post_termination_flag, {_break},
      iam_events, iam_failed_auth, iam_mfa_failures, iam_high_risk_events, endpoint_alerts, endpoint_critical_alerts,
      endpoint_malware_alerts, endpoint_powershell, post_termination_iam_events, post_termination_endpoint_events FROM risk""")
_at = "severity || '|' || confidence || '|' || threat_type || '|' || threat_id"
add("user_threats", ("threats", "queue"), f"""
    SELECT t.user_id, threat_id, threat_type AS threat_name, upper(severity) AS severity, confidence, evidence,
      CAST(first_observed AS VARCHAR) AS first_observed, CAST(last_observed AS VARCHAR) AS last_observed,
      COALESCE(related_hostname, '') AS related_hostname, t.recommended_action AS recommended_action,
      {_at} AS threat_order, CAST(q.priority_rank AS VARCHAR) AS priority_rank, q.investigation_priority,
      q.recommended_action AS queue_action
    FROM threats t LEFT JOIN queue q ON t.user_id = q.user_id""")


def _first(n: int | None, order: str) -> str:
    """A numbered cut to the first n rows of each user, or all rows."""
    return "" if n is None else f"QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order}) <= {n}"


def _number(n: int | None, order: str) -> str:
    return "" if n is None else f"ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order}) AS event_no,"


def _iam_events(n: int | None = None) -> str:
    blanks = ", ".join(f"COALESCE(x.{c}, '') AS {c}" for c in (
        "event_id", "event_type", "auth_method", "source_ip", "hostname", "device_id", "risk_level",
        "failure_reason", "geo_location"))
    order = 'x."timestamp" NULLS LAST, x.event_id, x.event_type NULLS FIRST, x.hostname NULLS FIRST'
    return f"""SELECT user_id, {_number(n, order)} "timestamp", mfa_passed, COALESCE(risk_score, 0)::DOUBLE AS risk_score, {blanks}
      FROM iam x WHERE user_id IS NOT NULL {_first(n, order)}"""


def _endpoint_events(n: int | None = None) -> str:
    order = """x.detected_timestamp NULLS LAST, x.alert_id NULLS FIRST, x.alert_name NULLS FIRST, x.hostname NULLS FIRST,
        x.process_name NULLS FIRST"""
    return f"""SELECT user_id, {_number(n, order)} detected_timestamp, COALESCE(x.alert_id, '') AS alert_id,
        COALESCE(x.alert_name, '') AS alert_name, upper(COALESCE(x.severity, 'Medium')) AS severity, COALESCE(x.status, 'New') AS status,
        COALESCE(x.process_name, 'N/A') AS process_name, COALESCE(x.file_path, 'N/A') AS file_path,
        COALESCE(x.hostname, 'N/A') AS hostname, COALESCE(x.description, '') AS description
      FROM endpoint x WHERE user_id IS NOT NULL {_first(n, order)}"""


def _firewall_events(n: int | None = None) -> str:
    order = """x."timestamp" NULLS LAST, x.log_id NULLS FIRST, x.src_ip NULLS FIRST, x.dst_ip NULLS FIRST,
        x.src_port NULLS FIRST, x.dst_port NULLS FIRST, x.bytes_sent NULLS FIRST, x.bytes_received NULLS FIRST"""
    return f"""SELECT user_id, {_number(n, order)} "timestamp", COALESCE(x.log_id, '') AS log_id, COALESCE(x.hostname, '') AS hostname,
        COALESCE(x.src_ip, '') AS src_ip, COALESCE(x.dst_ip, '') AS dst_ip, COALESCE(CAST(x.src_port AS VARCHAR), '') AS src_port,
        COALESCE(CAST(x.dst_port AS VARCHAR), '') AS dst_port,
        COALESCE(x.rule_name, '') AS rule_name, COALESCE(x.geo_country, '') AS geo_country, COALESCE(x.protocol, 'TCP') AS protocol,
        COALESCE(x.action, 'ALLOW') AS action, COALESCE(x.bytes_sent, 0) AS bytes_sent, COALESCE(x.bytes_received, 0) AS bytes_received,
        COALESCE(x.bytes_sent, 0) + COALESCE(x.bytes_received, 0) AS total_bytes, threat_flag
      FROM user_rows x {_first(n, order)}"""


CTES["hosts"] = (("context", "iam", "endpoint"), """
    SELECT DISTINCT user_id, trim(host) AS host FROM (SELECT user_id, hostname AS host FROM context
      UNION ALL SELECT user_id, hostname FROM iam UNION ALL SELECT user_id, hostname FROM endpoint WHERE hostname <> 'N/A')
    WHERE user_id IS NOT NULL AND trim(host) <> ''""")
CTES["host_keys"] = (("hosts",), "SELECT DISTINCT user_id, lower(host) AS host_key FROM hosts")
CTES["direct_users"] = (("host_keys", "firewall"), """
    SELECT DISTINCT user_id FROM host_keys WHERE host_key IN (SELECT DISTINCT lower(hostname_join_key) FROM firewall
      WHERE hostname_join_key IS NOT NULL)""")
_rows = lambda column, keep: f"""SELECT h.user_id, f.* FROM host_keys h JOIN firewall f ON lower(f.{column}) = h.host_key
    WHERE h.user_id {keep} (SELECT user_id FROM direct_users)"""  # noqa: E731
CTES["user_rows"] = (("direct_users", "firewall"), f"{_rows('hostname_join_key', 'IN')} UNION ALL {_rows('hostname', 'NOT IN')}")
for _part, _need, _build in (("iam", "iam", _iam_events), ("end", "endpoint", _endpoint_events), ("fw", "user_rows", _firewall_events)):
    CTES[f"{_part}_all"] = ((_need,), _build())
for _suffix, _n in (("", None), ("_first_50", 50)):
    _name = lambda source: f"{source}{_suffix}_events_per_user"
    add(_name("iam"), "iam", f"""SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp",
        CAST(mfa_passed AS VARCHAR) AS mfa_passed) FROM ({_iam_events(_n)})""")
    add(_name("endpoint"), "endpoint", f"""SELECT * REPLACE (CAST(detected_timestamp AS VARCHAR) AS detected_timestamp)
        FROM ({_endpoint_events(_n)})""")
    add(_name("firewall"), "user_rows", f"""SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp",
        CAST(threat_flag AS VARCHAR) AS threat_flag) FROM ({_firewall_events(_n)})""")
add("related_hosts", "hosts", "SELECT user_id, host FROM hosts")
CTES["timeline"] = (("iam_all", "end_all", "fw_all"), """SELECT user_id, position, ts, source, event_type, severity, details FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, src, tie, details) AS position FROM (
        SELECT user_id, concat_ws('|', event_id, event_type, hostname) AS tie, 1 AS src, "timestamp" AS ts, 'IAM Audit Trail' AS source, event_type,
          CASE WHEN COALESCE(NOT mfa_passed, FALSE) OR contains(event_type, 'FAIL') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
          'Event: ' || event_type || ', Method: ' || auth_method || ', IP: ' || source_ip || ', MFA: '
            || CASE WHEN mfa_passed THEN 'True' WHEN NOT mfa_passed THEN 'False' ELSE 'Unknown' END
            || CASE WHEN failure_reason <> '' THEN ', Reason: ' || failure_reason ELSE '' END AS details FROM iam_all
        UNION ALL
        SELECT user_id, concat_ws('|', alert_id, alert_name, hostname, process_name), 2, detected_timestamp, 'Endpoint Alert (EDR)', alert_name, severity,
          'Process: ' || process_name || ', Host: ' || hostname || ', Status: ' || status FROM end_all
        UNION ALL
        SELECT user_id, concat_ws('|', log_id, src_ip, dst_ip, src_port, dst_port, bytes_sent, bytes_received), 3, "timestamp", 'Firewall Logs',
          'NETWORK_TRAFFIC (' || protocol || ')',
          CASE WHEN threat_flag THEN 'CRITICAL' WHEN total_bytes > 10000000 THEN 'HIGH' ELSE 'MEDIUM' END,
          'Host: ' || hostname || ', Dst: ' || dst_ip || ':' || dst_port || ', Bytes: ' || format('{:,}', total_bytes)
            || ', Action: ' || action || ', Country: ' || geo_country FROM fw_all)
      WHERE ts IS NOT NULL)""")
_line = """SELECT user_id, position, CAST(ts AS VARCHAR) AS "timestamp", source, event_type, severity, details FROM timeline"""
add("evidence_timeline", "timeline", _line)
add("evidence_timeline_first_100", "timeline", f"{_line} WHERE position <= 100")
add("timeline_chart_points", "timeline", """SELECT user_id, position, CAST(ts AS VARCHAR) AS "timestamp",
    CAST(CASE severity WHEN 'CRITICAL' THEN 10 WHEN 'HIGH' THEN 7 WHEN 'MEDIUM' THEN 4 WHEN 'LOW' THEN 1 ELSE 3 END AS BIGINT)
      AS severity_level, source AS event_source, event_type FROM timeline""")
CTES["latest"] = (("iam_all", "end_all", "fw_all"), """SELECT user_id, MAX(ts) AS latest FROM (
    SELECT user_id, "timestamp" AS ts FROM iam_all UNION ALL SELECT user_id, detected_timestamp FROM end_all
    UNION ALL SELECT user_id, "timestamp" FROM fw_all) GROUP BY user_id""")
CTES["header"] = (("context", "risk", "latest"), f"""
    SELECT c.user_id, user_name, employment_status, c.termination_date, c.hostname, c.device_id, c.device_id_conflict,
      c.device_user_count, COALESCE(round_even(r.risk_score * 10, 0) / 10, 0) AS risk_score,
      upper(COALESCE(risk_band, 'Low')) AS risk_band, risk_drivers,
      COALESCE(post_termination_activity > 0, FALSE) OR (upper(employment_status) IN ('DISABLED', 'INACTIVE', 'TERMINATED')
        AND COALESCE((SELECT l.latest FROM latest l WHERE l.user_id = c.user_id) > c.termination_date, FALSE)) AS post_termination,
      {_break}
    FROM context c LEFT JOIN risk r ON c.user_id = r.user_id""")
add("investigation_report", "header", """SELECT * REPLACE (CAST(termination_date AS VARCHAR) AS termination_date,
    CAST(device_id_conflict AS VARCHAR) AS device_id_conflict, CAST(post_termination AS VARCHAR) AS post_termination) FROM header""")
CTES["named"] = (("threats", "header"), f"""
    SELECT user_id, {_at} AS place, threat_id, threat_type, upper(severity) AS severity, evidence FROM threats
    WHERE user_id IN (SELECT user_id FROM header)""")
_post = "h.post_termination"
_steps = f"""list_filter([
    CASE WHEN {_post} THEN 'Immediately revoke all active identity credentials, SSO tokens, and IAM session access.' END,
    CASE WHEN {_post} AND hostname <> '' THEN 'Isolate assigned endpoint device (' || hostname || ') from the enterprise network.' END,
    (SELECT recommended_action FROM queue q WHERE q.user_id = h.user_id),
    CASE WHEN risk_score >= 80 THEN 'Escalate case to Tier 2 Incident Response Team for priority containment.'
      WHEN risk_score >= 50 THEN 'Schedule mandatory credential rotation and verify multi-factor authentication enrollment.'
      ELSE 'Continue standard telemetry monitoring in triage queue.' END,
    CASE WHEN risk_score >= 80 THEN 'Collect endpoint forensic memory dump and inspect authentication audit logs.' END],
    lambda s: s IS NOT NULL)"""
add("investigation_report_lines", ("header", "named", "queue"), f"""
    SELECT user_id, section, CAST(part AS BIGINT) AS part, line_order, line FROM (
    SELECT user_id, 'key_drivers' AS section, 1 AS part, CAST(pos - 1 AS VARCHAR) AS line_order,
      upper(left(trim(piece), 1)) || substring(trim(piece), 2) AS line
    FROM (SELECT user_id, unnest(string_split(risk_drivers, ';')) AS piece,
            generate_subscripts(string_split(risk_drivers, ';'), 1) AS pos FROM header WHERE risk_drivers IS NOT NULL)
    UNION ALL SELECT user_id, 'key_drivers', 2, place, 'Active Threat Detection: ' || threat_type || ' (' || severity || ')' FROM named
    UNION ALL SELECT user_id, 'key_drivers', 3, '0', 'Routine activity monitoring.' FROM header
      WHERE risk_drivers IS NULL AND user_id NOT IN (SELECT user_id FROM named)
    UNION ALL SELECT user_id, 'critical_findings', 1, '0', 'CRITICAL: Unauthorized post-termination activity detected for user '
      || user_id || ' (' || user_name || ') after termination date ' || COALESCE(CAST(termination_date AS VARCHAR), '') || '.'
      FROM header WHERE post_termination
    UNION ALL SELECT user_id, 'critical_findings', 2, place, 'Threat Detection [' || threat_id || ']: ' || threat_type || ' ('
      || severity || ')' || ' — Evidence: ' || evidence FROM named
    UNION ALL SELECT user_id, 'critical_findings', 3, '0', 'Device Ownership Conflict: Device ' || device_id || ' is linked to '
      || device_user_count || ' different users.' FROM header WHERE device_id_conflict
    UNION ALL SELECT user_id, 'critical_findings', 4, '0', 'No critical security anomalies detected.' FROM header
      WHERE NOT post_termination AND NOT device_id_conflict AND user_id NOT IN (SELECT user_id FROM named)
    UNION ALL SELECT user_id, 'recommended_next_steps', 1, CAST(pos - 1 AS VARCHAR), step FROM (
      SELECT user_id, unnest(steps) AS step, generate_subscripts(steps, 1) AS pos FROM (SELECT h.user_id, {_steps} AS steps FROM header h)))""")
add("critical_accounts", "risk", """
    SELECT user_id, risk_score, risk_band AS risk_level, department, risk_drivers FROM (
      SELECT *, MAX(CASE WHEN risk_band = 'Critical' THEN 1 ELSE 0 END) OVER () AS any_critical FROM risk)
    WHERE any_critical = 0 OR risk_band = 'Critical'
    ORDER BY CASE WHEN any_critical = 1 THEN 0 ELSE -risk_score END, user_id LIMIT 5""")
add("system_summary", ("threats", "risk"), """SELECT (SELECT COUNT(*) FROM threats) AS active_threat_detections,
    (SELECT COUNT(*) FROM risk WHERE risk_band = 'Critical') AS critical_risk_users""")
add("primary_detections", "threats", """SELECT threat_id, user_id, threat_type, severity FROM threats
    ORDER BY severity, confidence, threat_type, threat_id LIMIT 5""")
add("user_comparison", ("context", "risk", "threats"), f"""
    SELECT c.user_id, user_name, COALESCE(round_even(r.risk_score * 10, 0) / 10, 0) AS risk_score,
      upper(COALESCE(risk_band, 'Low')) AS risk_band, employment_status, COALESCE(n, 0) AS active_threat_detections, primary_threat
    FROM context c LEFT JOIN risk r ON c.user_id = r.user_id LEFT JOIN (
      SELECT user_id, COUNT(*) AS n, first(threat_type || ' (' || upper(severity) || ')' ORDER BY {_at}) AS primary_threat
      FROM threats GROUP BY user_id) t ON c.user_id = t.user_id""")
add("traffic_volume", "fw_all", """SELECT user_id, CAST(SUM(total_bytes) AS BIGINT) AS total_bytes, COUNT(*) AS log_entries,
    round_even(CAST(SUM(total_bytes) AS DOUBLE) / 1048576 * 100, 0) / 100 AS traffic_mb FROM fw_all GROUP BY user_id""")
add("mfa_evidence", "iam_all", """SELECT * REPLACE (CAST("timestamp" AS VARCHAR) AS "timestamp", CAST(mfa_passed AS VARCHAR) AS mfa_passed)
    FROM iam_all WHERE NOT mfa_passed OR contains(event_type, 'MFA')""")


def _records(domain: str, rows: str, fields: str, place: tuple[str, ...] = ()) -> str:
    """One row per record: its fields as JSON with sorted keys."""
    pairs = ", ".join(f"'{f}': {f}" for f in sorted(fields.split()))
    at = "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in place) + ")" if place else "''"
    return f"SELECT user_id, '{domain}' AS domain, {at} AS place, CAST(to_json({{{pairs}}}) AS VARCHAR) AS payload FROM ({rows})"


_bundle = [
    _records("identity", SQL_BODY["identity_context"], """user_name username department role location employment_status hire_date
        termination_date hostname device_id manager device_id_conflict device_user_count assigned_assets"""),
    _records("risk", SQL_BODY["user_risk_profile"], """username department role status risk_score risk_band risk_drivers
        post_termination_flag authentication iam endpoint threat_behaviour context cross_signal iam_events iam_failed_auth iam_mfa_failures
        iam_high_risk_events endpoint_alerts endpoint_critical_alerts endpoint_malware_alerts endpoint_powershell
        post_termination_iam_events post_termination_endpoint_events"""),
    _records("threats", SQL_BODY["user_threats"], """threat_id threat_name severity confidence evidence first_observed last_observed
        related_hostname recommended_action threat_order priority_rank investigation_priority queue_action""", ("threat_order",)),
    _records("iam", SQL_BODY["iam_events_per_user"], """timestamp mfa_passed risk_score event_id
        event_type auth_method source_ip hostname device_id risk_level failure_reason geo_location""",
             ("timestamp", "event_id", "event_type", "hostname")),
    _records("endpoint", SQL_BODY["endpoint_events_per_user"], """detected_timestamp
        alert_id alert_name severity status process_name file_path hostname description""",
             ("detected_timestamp", "alert_id", "alert_name", "hostname", "process_name")),
    _records("firewall", SQL_BODY["firewall_events_per_user"], """timestamp log_id hostname src_ip
        dst_ip src_port dst_port rule_name geo_country protocol action bytes_sent bytes_received total_bytes threat_flag""",
             ("timestamp", "log_id", "src_ip", "dst_ip", "src_port", "dst_port", "bytes_sent", "bytes_received")),
    _records("timeline", _line, "position timestamp source event_type severity details", ("lpad(CAST(position AS VARCHAR), 12, '0')",)),
]
add("evidence_bundle", ("context", "risk", "threats", "queue", "iam", "endpoint", "user_rows", "timeline"), f"""
    SELECT * FROM ({' UNION ALL '.join(_bundle)}) WHERE user_id IN (SELECT user_id FROM identity WHERE user_id IS NOT NULL)""")

# --- summaries ----------------------------------------------------------------------------------
add("snapshot_meta", ("risk", "threats", "queue"), """SELECT (SELECT COUNT(*) FROM risk) AS users,
    (SELECT COUNT(*) FROM threats) AS threats, (SELECT COUNT(*) FROM queue) AS queue,
    (SELECT COUNT(*) FROM risk WHERE risk_band = 'Critical') AS critical""")
add("source_coverage", ("identity", "iam", "endpoint", "firewall"), " UNION ALL ".join(f"""
    SELECT '{n}' AS source, 'Reviewed' AS status, COUNT(*) AS rows, format('{{:,}}', COUNT(*)) || ' rows' AS coverage,
      'Schema available' AS issues FROM {t}""" for t, n in (
        ("identity", "Identity Asset Master"), ("iam", "Iam Audit Trail"), ("endpoint", "Endpoint Alerts"),
        ("firewall", "Firewall Logs"))))
_vector = """CASE WHEN lower(threat_type) LIKE '%malware%' OR lower(threat_type) LIKE '%powershell%' OR lower(threat_type) LIKE '%lateral%' THEN 'malware'
    WHEN lower(threat_type) LIKE '%termination%' OR lower(threat_type) LIKE '%disabled%' OR lower(threat_type) LIKE '%inactive%' THEN 'post_termination'
    ELSE 'identity' END"""
add("threat_vector_split", "threats", f"""SELECT v AS vector, COUNT(t.k) AS detections,
    COUNT(t.k) / GREATEST((SELECT COUNT(*) FROM threats), 1) AS share
    FROM (VALUES ('malware'), ('post_termination'), ('identity')) AS vs(v) LEFT JOIN (SELECT {_vector} AS k FROM threats) t ON t.k = v GROUP BY v""")
add("threat_search", "threats", """SELECT threat_id, user_id, threat_type, severity FROM threats
    WHERE (contains(lower(user_id), 'malware') OR contains(lower(threat_type), 'malware')) AND upper(severity) = 'CRITICAL'""")
add("user_search", "risk", """SELECT user_id, department, risk_score FROM risk
    WHERE contains(lower(user_id), 'sale') OR contains(lower(department), 'sale')""")
add("department_breakdown", "risk", """SELECT COALESCE(NULLIF(department, ''), 'Other') AS department, COUNT(*) AS users,
    round_even(AVG(risk_score) * 10, 0) / 10 AS average_score FROM risk GROUP BY 1""")
add("overall_risk", "risk", """SELECT round_even(AVG(risk_score) * 10, 0) / 10 AS average_score,
    COUNT(*) FILTER (WHERE risk_band = 'Critical') AS critical_users, COUNT(*) FILTER (WHERE risk_band = 'High') AS high_users FROM risk""")
for _n in (5, 7):
    add(f"top_{_n}_users", "risk", f"""SELECT user_id, username, department, risk_score, risk_band AS risk_level FROM risk
        ORDER BY risk_score DESC, user_id LIMIT {_n}""")
