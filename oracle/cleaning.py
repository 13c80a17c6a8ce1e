"""Clean tables in DuckDB SQL, on top of the shared raw feed."""

from __future__ import annotations

from tracewarden.functions import categories as cat
from tracewarden.functions.text import NULL_TOKENS
from tracewarden.schemas import RAW_COLUMNS
from tracewarden.sources.sample_feed import RAW_SQL


def _list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _map(x: str, mapping: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {x} {arms} ELSE {default} END"


def _scan(table: str) -> str:
    cols = ", ".join(
        f"CASE WHEN {c} IN {_list(NULL_TOKENS)} THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS[table]
    )
    return f"SELECT {cols} FROM ({RAW_SQL[table]()}) AS src"


def _emp(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]+') THEN 'EMP' || {x} ELSE {x} END"


def _alnum(x: str) -> str:
    return f"regexp_replace({x}, '[^A-Z0-9]', '', 'g')"


def _short_host(x: str) -> str:
    return f"replace(regexp_replace({x}, '\\.CORP\\.LOCAL$', ''), '_', '-')"


def _device(x: str) -> str:
    return f"regexp_replace({x}, '[\\s-]+', '', 'g')"


def _unix(x: str) -> str:
    return f"make_timestamp(CAST({x} AS BIGINT) * 1000000)"


def _formats(day: str, *tails: str) -> str:
    return "[" + ", ".join(f"'{day}{t}'" for t in tails) + "]"


_TAILS = ("", " %H:%M:%S", " %H:%M", "T%H:%M:%S", "T%H:%M")


def _mixed(x: str) -> str:
    def parse(day):
        return f"try_strptime({x}, {_formats(day, *_TAILS)})"

    half = f"try_strptime({x}, ['%m-%d-%Y %I:%M:%S %p', '%m-%d-%Y %I:%M %p'])"
    swapped = f"try_strptime({x}, ['%d-%m-%Y %I:%M:%S %p', '%d-%m-%Y %I:%M %p'])"
    return f"""CASE
      WHEN regexp_full_match({x}, '\\d{{10}}') THEN {_unix(x)}
      WHEN regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {parse('%Y-%m-%d')}
      WHEN regexp_matches({x}, '^\\d{{4}}/\\d{{2}}/\\d{{2}}') THEN {parse('%Y/%m/%d')}
      WHEN regexp_matches({x}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN COALESCE({parse('%d/%m/%Y')}, {parse('%m/%d/%Y')})
      WHEN regexp_matches({x}, '^\\d{{1,2}}-[A-Za-z]{{3}}-\\d{{4}}') THEN {parse('%d-%b-%Y')}
      WHEN regexp_matches({x}, '^\\d{{2}}-\\d{{2}}-\\d{{4}}.*(AM|PM|am|pm)$') THEN COALESCE({half}, {swapped})
      END"""


_ENDPOINT_FORMATS = (
    "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %H:%M",
    "%Y/%m/%d", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y", "%d-%b-%Y %H:%M:%S",
    "%d-%b-%Y %H:%M", "%d-%b-%Y", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y",
    "%m-%d-%Y %I:%M:%S %p", "%m-%d-%Y %I:%M %p",
)


def _endpoint_time(x: str) -> str:
    tries = ", ".join(f"try_strptime({x}, '{f}')" for f in _ENDPOINT_FORMATS)
    return (f"CASE WHEN regexp_full_match({x}, '\\d{{10}}(\\.0)?') THEN {_unix(f'SUBSTRING({x}, 1, 10)')} "
            f"ELSE COALESCE({tries}) END")


_FIREWALL_RULES = (
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"),
    (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", "%d/%m/%Y %H:%M"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "%Y-%m-%dT%H:%M:%S"),
    (r"\d{2}-[A-Za-z]{3}-\d{4} \d{2}:\d{2}:\d{2}", "%d-%b-%Y %H:%M:%S"),
    (r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2} [AP]M", "%m-%d-%Y %I:%M:%S %p"),
    (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
    (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
)


def _firewall_time(x: str) -> str:
    arms = " ".join(
        f"WHEN regexp_full_match({x}, '{p}') THEN try_strptime({x}, '{f}')" for p, f in _FIREWALL_RULES
    )
    return f"CASE {arms} WHEN regexp_full_match({x}, '\\d{{10}}') THEN {_unix(x)} END"


def _is_v4(x: str) -> str:
    octet = lambda o: f"(regexp_full_match({o}, '0|[1-9][0-9]{{0,2}}') AND TRY_CAST({o} AS INT) <= 255)"
    return (f"COALESCE(len(string_split({x}, '.')) = 4 AND "
            + " AND ".join(octet(f"split_part({x}, '.', {i})") for i in range(1, 5)) + ", FALSE)")


def _is_v6(x: str) -> str:
    """Enough of the rule for plain groups: hex groups, at most one '::'."""
    groups = f"string_split({x}, ':')"
    pairs = f"len(string_split({x}, '::')) - 1"
    return (f"(contains({x}, ':') AND NOT contains({x}, ':::') AND "
            f"regexp_full_match({x}, '[0-9A-Fa-f:]+') AND NOT regexp_matches({x}, '[0-9A-Fa-f]{{5}}') AND "
            f"(({pairs} = 0 AND len({groups}) = 8) OR ({pairs} = 1 AND len({groups}) <= 8)))")


def _is_private(x: str) -> str:
    o = [f"TRY_CAST(split_part({x}, '.', {i}) AS INT)" for i in (1, 2, 3)]
    return f"""({o[0]} IN (0, 10, 127) OR {o[0]} >= 240 OR ({o[0]} = 169 AND {o[1]} = 254)
      OR ({o[0]} = 172 AND {o[1]} BETWEEN 16 AND 31) OR ({o[0]} = 192 AND {o[1]} = 168)
      OR ({o[0]} = 192 AND {o[1]} = 0 AND {o[2]} IN (0, 2)) OR ({o[0]} = 198 AND {o[1]} IN (18, 19))
      OR ({o[0]} = 198 AND {o[1]} = 51 AND {o[2]} = 100) OR ({o[0]} = 203 AND {o[1]} = 0 AND {o[2]} = 113))"""


_IAM_TOKENS = "('', 'NA', 'N/A', 'NONE', 'NULL', 'UNKNOWN')"
_END_TOKENS = "('', 'NA', 'N/A', 'NONE', 'NULL', 'NAN', 'NOT AVAILABLE', 'UNKNOWN')"
_ID_TOKENS = "('', 'NAN', 'NONE', 'NULL', 'NA')"
_NAME_TOKENS = "('', 'nan', 'none', 'null', 'na', 'n/a')"


def _unless(test: str, tokens: str, value: str) -> str:
    return f"CASE WHEN {test} NOT IN {tokens} THEN {value} END"


def _identity() -> str:
    def mapped(col, mapping):
        return _unless(f"lower(trim({col}))", _NAME_TOKENS, _map(f"trim({col})", mapping))

    uid = _alnum("upper(trim(user_id))")
    date = lambda c: _unless(f"lower(trim({c}))", "('not available', 'na', 'n/a', 'none', 'null', '')", _mixed(f"trim({c})"))
    return f"""
      SELECT full_name, role, {_unless(uid, _ID_TOKENS, _emp(uid))} AS user_id,
        {mapped('department', cat.IDENTITY_DEPARTMENTS)} AS department,
        {mapped('location', cat.IDENTITY_LOCATIONS)} AS location,
        {mapped('status', cat.IDENTITY_STATUSES)} AS status,
        {date('hire_date')} AS hire_date, {date('termination_date')} AS termination_date,
        {_unless('lower(trim(username))', _NAME_TOKENS, 'lower(trim(username))')} AS username,
        {_unless('upper(trim(hostname))', _ID_TOKENS, _short_host('upper(trim(hostname))'))} AS hostname,
        {_unless('upper(trim(device_id))', _ID_TOKENS, _device('upper(trim(device_id))'))} AS device_id,
        {_unless('lower(trim(manager_username))', _NAME_TOKENS, 'lower(trim(manager_username))')} AS manager_username
      FROM (SELECT DISTINCT * FROM raw_identity)
    """


def _iam() -> str:
    def text(c):
        return _unless(f"upper(trim({c}))", _IAM_TOKENS, f"trim({c})")

    def up(c):
        return _unless(f"upper(trim({c}))", _IAM_TOKENS, f"upper(trim({c}))")

    def mapped(c, mapping):
        return _unless(f"upper(trim({c}))", _IAM_TOKENS, _map(f"upper(trim({c}))", mapping, f"upper(trim({c}))"))

    uid = _alnum("upper(trim(user_id))")
    ip, score = "trim(source_ip)", "upper(trim(risk_score))"
    number = (f"CASE WHEN regexp_full_match({score}, '\\d+(\\.\\d+)?\\s*/\\s*100') "
              f"THEN TRY_CAST(trim(split_part({score}, '/', 1)) AS DOUBLE) "
              f"WHEN regexp_full_match({score}, '[-+]?\\d+(\\.\\d+)?') THEN TRY_CAST({score} AS DOUBLE) END")
    geo = "upper(trim(geo_location))"
    return f"""
      SELECT trim(event_id) AS event_id, {_mixed('trim("timestamp")')} AS "timestamp",
        {_unless('upper(trim(user_id))', _IAM_TOKENS, f"NULLIF({_emp(uid)}, '')")} AS user_id,
        lower({text('username')}) AS username, {mapped('department', cat.IAM_DEPARTMENTS)} AS department,
        {mapped('event_type', cat.IAM_EVENT_TYPES)} AS event_type, {up('auth_method')} AS auth_method,
        {text('source_ip')} AS source_ip,
        CASE WHEN source_ip IS NULL OR {ip} = '' THEN 'MISSING' WHEN upper({ip}) IN {_IAM_TOKENS} THEN 'UNKNOWN'
             WHEN {_is_v4(ip)} THEN CASE WHEN {_is_private(ip)} THEN 'VALID_PRIVATE' ELSE 'VALID_PUBLIC' END
             WHEN {_is_v6(ip)} THEN 'VALID_OTHER' ELSE 'MALFORMED' END AS ip_status,
        {_short_host(up('hostname'))} AS hostname, {_device(up('device_id'))} AS device_id,
        {up('session_id')} AS session_id,
        CASE WHEN upper(trim(mfa_passed)) IN {_list(cat.IAM_PASSED)} THEN TRUE
             WHEN upper(trim(mfa_passed)) IN {_list(cat.IAM_NOT_PASSED)} THEN FALSE END AS mfa_passed,
        {mapped('failure_reason', cat.IAM_FAILURE_REASONS)} AS failure_reason,
        CASE WHEN {number} BETWEEN 0 AND 100 THEN {number} END AS risk_score,
        CASE WHEN {score} IN ('LOW', 'MEDIUM', 'HIGH') THEN {score} END AS risk_level,
        CASE WHEN {geo} IN ('', 'NONE', 'N/A', 'NA') THEN NULL WHEN {geo} IN ('IN', 'INDIA', 'IND') THEN 'INDIA'
             WHEN {geo} IN ('PB', 'PUNJAB') THEN 'PUNJAB' WHEN {geo} IN ('DL', 'DELHI') THEN 'DELHI' ELSE {geo} END AS geo_location
      FROM (SELECT DISTINCT * FROM raw_iam)
    """


def _endpoint() -> str:
    def text(c):
        return _unless(f"upper(trim({c}))", _END_TOKENS, f"trim({c})")

    def label(c):
        return f"trim(regexp_replace({text(c)}, '\\s+', ' ', 'g'))"

    def mapped(c, mapping):
        return _map(f"upper({text(c)})", mapping)

    uid = _alnum(f"upper({text('user_id')})")
    host = f"replace(lower({text('hostname')}), '_', '-')"
    labels = ", ".join(f"{label(c)} AS {c}" for c in (
        "endpoint_product", "alert_name", "description", "file_path", "process_name", "sha256", "assigned_to"))
    gone = lambda c: f"({text(c)}) IS NULL"
    return f"""
      SELECT *,
        user_id IS NULL AS missing_user_id_flag, hostname IS NULL AS missing_hostname_flag,
        no_det AND detected_timestamp IS NULL AS missing_detected_timestamp_flag,
        NOT no_det AND detected_timestamp IS NULL AS invalid_detected_timestamp_flag,
        no_res AND resolved_timestamp IS NULL AS missing_resolved_timestamp_flag,
        NOT no_res AND resolved_timestamp IS NULL AS invalid_resolved_timestamp_flag,
        COALESCE(resolved_timestamp < detected_timestamp, FALSE) AS impossible_resolution_flag,
        COALESCE(status IN ('New', 'Open', 'In Progress', 'Unassigned'), FALSE) AS unresolved_alert_flag,
        COALESCE(status IN ('Resolved', 'Closed'), FALSE) AND resolved_timestamp IS NULL AS resolved_without_timestamp_flag,
        COALESCE(status IN ('New', 'Open', 'In Progress', 'Unassigned'), FALSE) AND resolved_timestamp IS NOT NULL
          AS unresolved_with_resolution_timestamp_flag,
        severity IS NULL AND NOT no_sev AS unmapped_severity_flag,
        status IS NULL AND NOT no_st AS unmapped_status_flag,
        device_criticality IS NULL AND NOT no_crit AS unmapped_criticality_flag,
        NOT sha256_valid_flag AND NOT sha256_missing_flag AS invalid_sha256_flag,
        CASE WHEN sha256_missing_flag THEN 'missing_sha256' WHEN sha256_valid_flag THEN 'valid_sha256'
             ELSE 'malformed_sha256' END AS sha256_validation_status
      FROM (
        SELECT alert_id, {_endpoint_time(text('detected_timestamp'))} AS detected_timestamp,
          {_endpoint_time(text('resolved_timestamp'))} AS resolved_timestamp,
          {host} AS hostname, NULLIF(regexp_replace({host}, '\\.corp\\.local$', ''), '') AS hostname_join_key,
          NULLIF({_emp(uid)}, '') AS user_id, {labels},
          {mapped('severity', cat.ENDPOINT_SEVERITIES)} AS severity,
          {mapped('status', cat.ENDPOINT_STATUSES)} AS status,
          {mapped('device_criticality', cat.ENDPOINT_CRITICALITIES)} AS device_criticality,
          {gone('detected_timestamp')} AS no_det, {gone('resolved_timestamp')} AS no_res,
          {gone('severity')} AS no_sev, {gone('status')} AS no_st, {gone('device_criticality')} AS no_crit,
          {gone('sha256')} AS sha256_missing_flag,
          COALESCE(regexp_full_match({text('sha256')}, '[0-9A-Fa-f]{{64}}'), FALSE) AS sha256_valid_flag,
          COUNT(*) OVER (PARTITION BY alert_id) > 1 AS duplicate_alert_id_flag,
          SUM(copies) OVER (PARTITION BY alert_id) > 1 AND MIN(copies) OVER (PARTITION BY alert_id) = 1
            AS duplicate_alert_id_different_content_flag
        FROM (SELECT {', '.join(RAW_COLUMNS['endpoint'])}, COUNT(*) AS copies FROM raw_endpoint
              GROUP BY {', '.join(RAW_COLUMNS['endpoint'])})
      )
    """


def _firewall() -> str:
    host = "replace(lower(trim(hostname)), '_', '-')"

    def ip(c):
        x = f"trim({c})"
        return f"CASE WHEN {x} <> '' THEN {_is_v4(x)} OR {_is_v6(x)} END"

    def port(c):
        x = f"CASE WHEN regexp_full_match(trim({c}), '[+-]?\\d+(\\.\\d*)?') THEN TRY_CAST(trim({c}) AS DOUBLE) END"
        return f"CASE WHEN {x} >= 0 AND {x} <= 65535 AND {x} = FLOOR({x}) THEN CAST({x} AS INT) END"

    def size(c):
        x = f"upper(replace(trim({c}), ',', ''))"
        n = f"TRY_CAST(regexp_extract({x}, '^[-+]?\\d+(\\.\\d+)?') AS DOUBLE)"
        unit = (f"CASE WHEN {x} LIKE '%KB' THEN 1024 WHEN {x} LIKE '%MB' THEN 1048576 "
                f"WHEN {x} LIKE '%GB' THEN 1073741824 ELSE 1 END")
        return (f"CASE WHEN regexp_full_match({x}, '[-+]?\\d+(\\.\\d+)?\\s*(KB|MB|GB)?') AND {n} >= 0 "
                f"THEN CAST(round_even({n} * {unit}, 0) AS BIGINT) END")

    def state(c, value):
        return f"CASE WHEN COALESCE(trim({c}), '') = '' THEN 'missing' WHEN ({value}) IS NULL THEN 'invalid' ELSE 'valid' END"

    def mapped(c, mapping, other=None):
        x = f"upper(trim({c}))"
        return f"CASE WHEN {x} <> '' THEN {_map(x, mapping, repr(other) if other else 'NULL')} END"

    def cols(names, f, g):
        return ", ".join(f"{f(n)} AS {n}" for n in names) + ", " + ", ".join(f"{state(n, g(n))} AS {n}_status" for n in names)

    return f"""
      SELECT log_id, {_firewall_time('trim("timestamp")')} AS "timestamp", {host} AS hostname,
        CASE WHEN {ip('src_ip')} THEN trim(src_ip) END AS src_ip, CASE WHEN {ip('dst_ip')} THEN trim(dst_ip) END AS dst_ip,
        {mapped('protocol', cat.FIREWALL_PROTOCOLS, 'OTHER')} AS protocol,
        {mapped('action', cat.FIREWALL_ACTIONS, 'OTHER')} AS action,
        {cols(('src_port', 'dst_port'), port, port)}, {cols(('bytes_sent', 'bytes_received'), size, size)},
        regexp_replace(upper(trim(session_id)), '^SID-(\\d{{6}})$', 'SID\\1') AS session_id,
        CASE WHEN lower(trim(threat_flag)) IN ('true', 'yes', 'y', '1') THEN TRUE
             WHEN lower(trim(threat_flag)) IN ('false', 'no', 'n', '0') THEN FALSE END AS threat_flag,
        upper(trim(rule_name)) AS rule_name, {mapped('geo_country', cat.FIREWALL_COUNTRIES)} AS geo_country,
        regexp_replace({host}, '\\.corp\\.local$', '') AS hostname_join_key,
        {ip('src_ip')} AS src_ip_valid, {ip('dst_ip')} AS dst_ip_valid
      FROM (SELECT DISTINCT * FROM raw_firewall)
    """


ISSUES = (
    "duplicate_alert_id_flag", "missing_user_id_flag", "missing_hostname_flag",
    "invalid_detected_timestamp_flag", "invalid_resolved_timestamp_flag", "impossible_resolution_flag",
    "resolved_without_timestamp_flag", "unresolved_with_resolution_timestamp_flag",
    "unmapped_severity_flag", "unmapped_status_flag", "unmapped_criticality_flag", "invalid_sha256_flag",
)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_identity": ((), _scan("identity")),
    "raw_iam": ((), RAW_SQL["iam"]()),
    "raw_endpoint": ((), _scan("endpoint")),
    "raw_firewall": ((), _scan("firewall")),
    "messages": ((), RAW_SQL["messages"]()),
    "identity0": (("raw_identity",), _identity()),
    "identity": (("identity0",), """
      SELECT i.*, COALESCE(d.n, 0) AS device_user_count,
        i.device_id IS NOT NULL AND COALESCE(d.n, 0) > 1 AS device_id_conflict
      FROM identity0 i LEFT JOIN (SELECT device_id, COUNT(DISTINCT user_id) AS n FROM identity0
        WHERE device_id IS NOT NULL GROUP BY device_id) d ON i.device_id = d.device_id"""),
    "iam": (("raw_iam",), _iam()),
    "endpoint0": (("raw_endpoint",), _endpoint()),
    "endpoint": (("endpoint0",), f"""
      SELECT * EXCLUDE (no_det, no_res, no_sev, no_st, no_crit),
        {' + '.join(f'CAST({f} AS INT)' for f in ISSUES)} AS data_quality_issue_count,
        CASE WHEN {' OR '.join(ISSUES)} THEN 'Review' ELSE 'Pass' END AS data_quality_status
      FROM endpoint0"""),
    "firewall": (("raw_firewall",), _firewall()),
}
