"""Derive the four raw telemetry tables from the star-schema test tables.

The text is plain SQL that Spark and DuckDB read alike, so that both engines clean the very
same messy rows. Only arithmetic, CASE, SUBSTRING and string concatenation are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "events", "orders", "lineitem", "conversations")


def _s(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _pick(selector: str, *choices: str) -> str:
    """CASE over 0..n-1; the last choice is the default."""
    branches = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices[:-1]))
    return f"CASE {selector} {branches} ELSE {choices[-1]} END"


def _number(k: str) -> str:
    return _s(f"10000 + {k}")


def _user(k: str, style: str) -> str:
    n = _number(k)
    return _pick(f"({style}) % 4", f"'EMP' || {n}", f"'emp-' || {n}", f"' EMP_' || {n} || ' '", n)


def _host(k: str) -> str:
    n = _number(k)
    return _pick(f"({k}) % 3", f"'WS-' || {n}", f"'lpt_' || {n} || '.corp.local'",
                 f"'VDR_' || {n} || '.CORP.LOCAL'")


def _dates(iso: str) -> dict[str, str]:
    """Pieces of an ISO date or time text."""
    month = f"CAST(SUBSTRING({iso}, 6, 2) AS INT)"
    return {
        "y": f"SUBSTRING({iso}, 1, 4)", "m": f"SUBSTRING({iso}, 6, 2)",
        "d": f"SUBSTRING({iso}, 9, 2)", "t": f"SUBSTRING({iso}, 12, 8)",
        "hm": f"SUBSTRING({iso}, 12, 5)",
        "mon": f"SUBSTRING('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * {month} - 2, 3)",
    }


def _half_day(iso: str) -> str:
    """MM-DD-YYYY hh:mm:ss AM/PM."""
    p = _dates(iso)
    hour = f"CAST(SUBSTRING({iso}, 12, 2) AS INT)"
    shown = f"(CASE WHEN {hour} % 12 = 0 THEN 12 ELSE {hour} % 12 END)"
    padded = f"LPAD({_s(shown)}, 2, '0')"
    half = f"CASE WHEN {hour} >= 12 THEN ' PM' ELSE ' AM' END"
    return (f"{p['m']} || '-' || {p['d']} || '-' || {p['y']} || ' ' || {padded} || "
            f"SUBSTRING({iso}, 14, 6) || {half}")


def _date_text(iso: str, days: str, style: str) -> str:
    """A date in the identity master's spellings; ``days`` counts from 2015-01-01."""
    p = _dates(iso)
    return _pick(
        f"({style}) % 6",
        iso, f"{p['y']} || '/' || {p['m']} || '/' || {p['d']}",
        f"{p['d']} || '/' || {p['m']} || '/' || {p['y']}",
        f"{p['d']} || '-' || {p['mon']} || '-' || {p['y']}",
        f"{p['m']} || '-' || {p['d']} || '-' || {p['y']} || ' 12:00:00 AM'",
        _s(f"(16436 + ({days})) * 86400"),
    )


def raw_identity() -> str:
    k = "k"
    base = """
      SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg,
             CAST(DATE '2015-01-01' + CAST(c_custkey * 37 % 2500 AS INT) AS STRING) AS hired,
             c_custkey * 37 % 2500 AS hired_days,
             CAST(DATE '2024-01-03' + CAST(c_custkey % 25 AS INT) AS STRING) AS left_on,
             3289 + c_custkey % 25 AS left_days
      FROM customer
    """
    hired = f"""CASE WHEN k % 31 = 0 THEN 'Not Available' WHEN k % 37 = 0 THEN 'soon'
      WHEN k % 29 = 0 THEN {_dates('hired')['m']} || '/' || {_dates('hired')['d']} || '/' || {_dates('hired')['y']}
      ELSE {_date_text('hired', 'hired_days', 'k')} END"""
    left = f"""CASE WHEN k % 8 = 0 THEN {_date_text('left_on', 'left_days', 'CAST(FLOOR(k / 8) AS BIGINT)')}
      WHEN k % 50 = 1 THEN '2010-06-01' WHEN k % 50 = 2 THEN 'N/A' END"""
    first = f"""
      SELECT
        CASE WHEN k % 97 = 0 THEN 'Alex Morgan' ELSE 'Casey ' || SUBSTRING(name, 10, 9) END AS full_name,
        {_pick('k % 5', "'Analyst'", "'Engineer'", "'Manager'", "'Contractor'", "'Director'")} AS role,
        CASE WHEN k % 211 = 5 THEN 'N/A' WHEN k % 211 = 6 THEN ' null ' ELSE {_user(k, 'k')} END AS user_id,
        CASE WHEN seg = 'BUILDING' AND k % 2 = 0 THEN 'Call Center' ELSE
        {_pick('k % 12', "'HR'", "'hr dept'", "'Finance'", "'Fin'", "'IT Support'", "'R&D'",
               "'sales team'", "'Ops'", "'HR DEPT'", "'n/a'", "' Legal '", "'Supply Chain'")} END AS department,
        {_pick('k % 7', "'Head_Office'", "'remote'", "'WAREHOUSE'", "'Moon Base'", "NULL",
               "'Work From Home'", "'DATA CENTER'")} AS location,
        {_pick('k % 9', "'Active'", "'A'", "'Disabled'", "'LWP'", "'ON_LEAVE'", "'Terminated'",
               "'x'", "'Live'", "' none '")} AS status,
        {hired} AS hire_date,
        {left} AS termination_date,
        CASE WHEN k % 53 = 0 THEN 'none' WHEN k % 2 = 0 THEN ' User' || {_number(k)}
             ELSE 'user' || {_number(k)} END AS username,
        CASE WHEN k % 61 = 0 THEN NULL WHEN k % 50 = 3 THEN 'ws-shared' || {_s('CAST(FLOOR(k / 100) AS BIGINT)')}
             ELSE {_host(k)} END AS hostname,
        CASE WHEN k % 40 = 3 THEN 'DEV-0' WHEN k % 25 = 1 THEN 'dev - ' || {_number('k - 1')}
             WHEN k % 71 = 0 THEN 'NONE' ELSE 'DEV' || {_number(k)} END AS device_id,
        CASE WHEN k % 20 = 0 THEN 'n/a' ELSE 'user' || {_number('k % 20')} END AS manager_username
      FROM ({base}) AS c
    """
    second = f"""
      SELECT 'Casey ' || SUBSTRING(name, 10, 9) AS full_name, 'Analyst' AS role,
        {_user(k, 'k + 1')} AS user_id, 'IT' AS department, 'REMOTE' AS location,
        'Working' AS status, hired AS hire_date, NULL AS termination_date,
        'user' || {_number(k)} AS username, 'WS-9' || {_number(k)} AS hostname,
        'DEV9' || {_number(k)} AS device_id, NULL AS manager_username
      FROM ({base}) AS c WHERE k % 45 = 7
    """
    return f"""
      SELECT * FROM ({first}) AS a
      UNION ALL SELECT * FROM ({first} WHERE k % 33 = 0) AS b
      UNION ALL SELECT * FROM ({second}) AS c2
    """


def raw_iam() -> str:
    e, u = "e", "u"
    p = _dates("iso")
    epoch = (f"1704067200 + ((CAST({p['m']} AS INT) - 1) * 31 + CAST({p['d']} AS INT) - 1) * 86400"
             f" + CAST(SUBSTRING(iso, 12, 2) AS INT) * 3600 + CAST(SUBSTRING(iso, 15, 2) AS INT) * 60"
             f" + CAST(SUBSTRING(iso, 18, 2) AS INT)")
    time = f"""CASE WHEN e % 43 = 0 THEN '' WHEN e % 47 = 0 THEN 'yesterday' ELSE {_pick(
        'e % 9', 'iso', f"{p['y']} || '-' || {p['m']} || '-' || {p['d']} || 'T' || {p['t']}",
        f"{p['y']} || '/' || {p['m']} || '/' || {p['d']} || ' ' || {p['t']}",
        f"{p['d']} || '/' || {p['m']} || '/' || {p['y']} || ' ' || {p['t']}",
        f"{p['d']} || '-' || {p['mon']} || '-' || {p['y']} || ' ' || {p['t']}",
        _half_day('iso'), _s(epoch),
        f"{p['d']} || '/' || {p['m']} || '/' || {p['y']} || ' ' || {p['hm']}",
        f"' ' || {p['y']} || '-' || {p['m']} || '-' || {p['d']} || ' '")} END"""
    kind = _pick(
        "kind_no",
        _pick("e % 3", "'LOGIN_SUCCESS'", "'auth_success'", "'login'"),
        _pick("e % 3", "'MFA_ENROLLED'", "'DEVICE_REGISTRATION'", "'token_refresh'"),
        _pick("e % 3", "'PASSWORD_CHANGED'", "'mfa_failed'", "'SESSION_END'"),
        _pick("e % 3", "'PRIVILEGE_ESCALATION'", "'ACCOUNT_LOCKED'", "'unknown'"),
        _pick("e % 3", "'LOGIN_FAILURE'", "'auth_failed'", "'access denied'"),
    )
    base = """
      SELECT event_id AS e, user_id AS u, SUBSTRING(CAST(ts AS STRING), 1, 19) AS iso, value AS v,
        CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2
             WHEN 'purchase' THEN 3 ELSE 4 END AS kind_no
      FROM events
    """
    row = f"""
      SELECT
        ' EVT-' || {_s(e)} AS event_id,
        {time} AS timestamp,
        CASE WHEN e % 83 = 0 THEN 'unknown' WHEN e % 89 = 0 THEN 'nan'
             WHEN e % 41 = 0 THEN 'EMP9' || {_number(u)} ELSE {_user(u, 'e')} END AS user_id,
        CASE WHEN e % 19 = 0 THEN 'N/A' ELSE 'User' || {_number(u)} END AS username,
        {_pick('u % 6', "'ops'", "'hr dept'", "'IT Dept'", "'finance'", "NULL", "'Customer Service'")} AS department,
        {kind} AS event_type,
        {_pick('e % 5', "'Password'", "'sso'", "'MFA'", "'fido2'", "'none'")} AS auth_method,
        {_pick('e % 11', "'10.0.' || " + _s('e % 256') + " || '.7'", "'8.8.' || " + _s('e % 300') + " || '.8'",
               "'198.18.0.1'", "'100.64.0.1'", "'fe80::1'", "'192.168.01.1'", "'unknown'", "NULL",
               "'203.0.113.' || " + _s('e % 256'), "'2001:db8::g'", "' 172.16.0.9 '")} AS source_ip,
        CASE WHEN e % 23 = 0 THEN NULL WHEN e % 20 = 0 THEN 'WS-' || {_number('(e % 37) * 3')}
             WHEN e % 31 = 0 THEN 'WS-ROGUE' || {_s('u % 4')} ELSE {_host(u)} END AS hostname,
        CASE WHEN e % 13 = 0 THEN NULL WHEN e % 6 = 0 THEN 'DEV-77' || {_s('e % 50')}
             ELSE 'dev-' || {_number(u)} END AS device_id,
        CASE WHEN e % 17 = 0 THEN 'unknown' WHEN e % 10 = 1 THEN 'SID111111'
             WHEN e % 5 = 0 THEN 'sid' || {_s('100000 + e % 900000')}
             ELSE 'SID-' || {_s('100000 + e % 900000')} END AS session_id,
        {_pick('e % 7', "'Yes'", "'FALSE'", "'fail'", "'1'", "'maybe'", "NULL", "'no'")} AS mfa_passed,
        CASE WHEN kind_no = 4 THEN {_pick('e % 4', "'invalid credentials'", "'Wrong Password'", "'OTP expired'", "'geo block'")}
             WHEN e % 4 = 0 THEN 'MFA failed' WHEN e % 5 = 0 THEN 'n/a' END AS failure_reason,
        {_pick('e % 8', _s('e * 37 % 101') + " || '/100'", _s('e * 37 % 101'), _s('e * 37 % 101') + " || '.5'",
               "'high'", "'150'", "'nan'", "NULL", "' ' || " + _s('e * 53 % 101') + " || ' / 100'")} AS risk_score,
        {_pick('e % 9', "'in'", "'Punjab'", "'dl'", "'UNKNOWN'", "'remote'", "'N/A'", "NULL", "'Goa'", "'IND'")} AS geo_location
      FROM ({base}) AS ev
    """
    return f"SELECT * FROM ({row}) AS a UNION ALL SELECT * FROM ({row} WHERE e % 40 = 0) AS b"


def raw_endpoint() -> str:
    d, r = _dates("det"), _dates("res")
    detected = f"""CASE WHEN o % 43 = 0 THEN 'N/A' WHEN o % 47 = 0 THEN 'tomorrow' ELSE {_pick(
        'o % 12', 'det', f"{d['y']} || '-' || {d['m']} || '-' || {d['d']} || 'T' || {d['t']}",
        f"{d['y']} || '-' || {d['m']} || '-' || {d['d']}",
        f"{d['y']} || '/' || {d['m']} || '/' || {d['d']} || ' ' || {d['hm']}",
        f"{d['d']} || '/' || {d['m']} || '/' || {d['y']} || ' ' || {d['t']}",
        f"{_s('CAST(' + d['d'] + ' AS INT)')} || '/' || {_s('CAST(' + d['m'] + ' AS INT)')} || '/' || {d['y']} || ' ' || {d['t']}",
        f"{d['d']} || '-' || {d['mon']} || '-' || {d['y']} || ' ' || {d['t']}",
        f"{d['m']} || '/' || {d['d']} || '/' || {d['y']} || ' ' || {d['hm']}",
        _half_day('det'), _s('1704067200 + sec') + " || '.0'", _s('1704067200 + sec'), 'det')} END"""
    resolved = f"""CASE WHEN o % 5 = 0 THEN NULL WHEN o % 59 = 0 THEN 'n/a ' WHEN o % 61 = 0 THEN '2024-13-01'
      ELSE {_pick('o % 3', 'res', f"{r['d']} || '/' || {r['m']} || '/' || {r['y']} || ' ' || {r['t']}",
                  f"{r['d']} || '-' || {r['mon']} || '-' || {r['y']} || ' ' || {r['hm']}")} END"""
    base = """
      SELECT o_orderkey AS o, o_orderstatus AS st, o_orderpriority AS pr, sec,
        CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % (SELECT MAX(user_id) + 1 FROM events)
             ELSE o_custkey END AS u,
        SUBSTRING(CAST(TIMESTAMP '2024-01-01 00:00:00' + sec * INTERVAL '1' SECOND AS STRING), 1, 19) AS det,
        SUBSTRING(CAST(TIMESTAMP '2024-01-01 00:00:00' + (sec + (o_orderkey % 9 - 1) * 10801) * INTERVAL '1' SECOND AS STRING), 1, 19) AS res
      FROM (SELECT *, o_orderkey * 7919 % 2592000 AS sec FROM orders) AS src
    """
    row = f"""
      SELECT
        CASE WHEN o % 50 = 1 THEN 'ALT-' || {_s('o - 1')} ELSE 'ALT-' || {_s('o')} END AS alert_id,
        {detected} AS detected_timestamp,
        {resolved} AS resolved_timestamp,
        CASE WHEN o % 27 = 0 THEN 'unknown' WHEN o % 20 = 0 THEN 'WS-' || {_number('(o % 41) * 3')}
             WHEN o % 31 = 0 THEN 'ws_rogue' || {_s('u % 4')} || '.corp.local' ELSE {_host('u')} END AS hostname,
        CASE WHEN o % 83 = 0 THEN 'Not Available' WHEN o % 41 = 0 THEN 'EMP9' || {_number('u')}
             ELSE {_user('u', 'o')} END AS user_id,
        {_pick('o % 4', "'Sensor  One'", "' Sensor Two'", "'n/a'", "'Shield'")} AS endpoint_product,
        {_pick('o % 15', "'Malware detected'", "'Ransomware behavior'", "'Trojan dropper'",
               "'Credential dumping'", "'Keylogger activity'", "'Lateral movement via SMB'",
               "'Admin share access'", "'PowerShell encoded command'", "'USB device inserted'",
               "'Attempt to disable security tool'", "'Tamper protection'", "'Suspicious login'",
               "'Policy violation'", "'Port scan'", "'unknown'")} AS alert_name,
        CASE pr WHEN '1-URGENT' THEN {_pick('o % 3', "'P1'", "'severe'", "'Critical'")}
                WHEN '2-HIGH' THEN {_pick('o % 3', "'h'", "'MAJOR'", "'high'")}
                WHEN '3-MEDIUM' THEN {_pick('o % 2', "'moderate'", "'S3'")}
                WHEN '5-LOW' THEN 'minor' ELSE {_pick('o % 2', "'zzz'", "'N/A'")} END AS severity,
        CASE st WHEN 'F' THEN {_pick('o % 3', "'fp'", "'Resolved'", "'false positive'")}
                WHEN 'O' THEN {_pick('o % 4', "'open'", "'active'", "'wip'", "'U'")}
                ELSE {_pick('o % 4', "'new'", "'pending'", "'unknown'", "'Investigating'")} END AS status,
        CASE WHEN o % 17 = 0 THEN 'Possible malware  on host' WHEN o % 19 = 0 THEN 'None'
             ELSE 'Rule ' || {_s('o % 15')} END AS description,
        '/opt/app/f' || {_s('o % 9')} || '.exe' AS file_path,
        CASE WHEN o % 22 = 0 THEN 'powershell.exe' WHEN o % 7 = 0 THEN NULL ELSE 'svc.exe' END AS process_name,
        CASE WHEN o % 6 = 0 THEN 'unknown' WHEN o % 10 = 1 THEN md5({_s('o')})
             ELSE UPPER(md5({_s('o')})) || md5({_s('o + 1')}) END AS sha256,
        {_pick('o % 3', "'tier1'", "' Tier 2'", "NULL")} AS assigned_to,
        {_pick('o % 6', "'p1'", "'H'", "'medium'", "'low'", "'vip'", "'n/a'")} AS device_criticality
      FROM ({base}) AS al
    """
    return f"SELECT * FROM ({row}) AS a UNION ALL SELECT * FROM ({row} WHERE o % 34 = 0) AS b"


def raw_firewall() -> str:
    p = _dates("iso")
    time = f"""CASE WHEN f % 43 = 0 THEN NULL ELSE {_pick(
        'f % 11', 'iso', f"{p['d']} || '/' || {p['m']} || '/' || {p['y']} || ' ' || {p['hm']}",
        f"{p['y']} || '-' || {p['m']} || '-' || {p['d']} || 'T' || {p['t']}",
        f"{p['d']} || '-' || {p['mon']} || '-' || {p['y']} || ' ' || {p['t']}",
        _half_day('iso'), f"{p['d']} || '/' || {p['m']} || '/' || {p['y']}",
        f"{p['y']} || '/' || {p['m']} || '/' || {p['d']}", _s('1704067200 + sec'),
        f"{p['m']} || '/' || {p['d']} || '/' || {p['y']}", f"LOWER({_half_day('iso')})", 'iso')} END"""
    size = "CAST(FLOOR(price) AS BIGINT)"

    def amount(style: str) -> str:
        return _pick(
            f"({style}) % 9", _s(size), f"{_s('1 + f % 900')} || ',' || {_s('100 + f % 800')}",
            f"{_s('f % 900')} || '.5 KB'", f"{_s('f % 30')} || 'mb'", f"{_s('f % 7')} || '.5'", "'-5'",
            "'5 TB'", "NULL", f"{_s('f % 900')} || ' kb'")

    base = """
      SELECT f, o, n, price, sec, u,
        SUBSTRING(CAST(TIMESTAMP '2024-01-01 00:00:00' + sec * INTERVAL '1' SECOND AS STRING), 1, 19) AS iso
      FROM (SELECT l_orderkey * 10 + l_linenumber AS f, l_orderkey AS o, l_linenumber AS n,
              l_extendedprice AS price,
              (l_orderkey * 8641 + l_linenumber * 1733 + CAST(FLOOR(l_extendedprice) AS BIGINT)) % 2592000 AS sec,
              (l_orderkey * 7 + l_linenumber) % (SELECT MAX(c_custkey) + 1 FROM customer) AS u
            FROM lineitem) AS src
    """
    row = f"""
      SELECT
        CASE WHEN f % 301 = 0 THEN NULL ELSE 'FW-' || {_s('f')} END AS log_id,
        {time} AS timestamp,
        CASE WHEN f % 21 = 0 THEN NULL WHEN f % 26 = 0 THEN 'gw_' || {_s('f % 5')} ELSE {_host('u')} END AS hostname,
        {_pick('f % 7', "'10.1.' || " + _s('f % 256') + " || '.3'", "'999.1.1.1'", "NULL", "' '", "'2001:db8::1'",
               "'1.2.3'", "'172.16.9.' || " + _s('f % 256'))} AS src_ip,
        {_pick('f % 4', "'8.8.8.8'", "'fe80::1::2'", "NULL", "'52.1.' || " + _s('f % 256') + " || '.9'")} AS dst_ip,
        {_pick('f % 8', _s('f % 65536'), "'80.0'", "'65536'", "'-1'", "'80.5'", "'abc'", "NULL", "' 443 '")} AS src_port,
        {_pick('f % 5', "'443'", "'22'", "'3389.0'", "''", "'x1'")} AS dst_port,
        {_pick('f % 10', "'tcp'", "'TCP/6'", "'6'", "'udp'", "'17'", "'icmp'", "'1'", "'gre'", "''", "NULL")} AS protocol,
        {_pick('f % 9', "'allow'", "'Permit'", "'pass'", "'deny'", "'drop'", "'BLOCK'", "'reset'", "''", "NULL")} AS action,
        {amount('f')} AS bytes_sent,
        {amount('f + 4')} AS bytes_received,
        CASE WHEN n = 7 AND f % 3 = 0 THEN 'SID-111111' WHEN f % 37 = 0 THEN NULL
             WHEN f % 38 = 0 THEN 'sid-12' ELSE 'sid-' || {_s('100000 + o % 900000')} END AS session_id,
        {_pick('f % 12', "'true'", "'no'", "'N'", "'0'", "'False'", "NULL", "'maybe'", "'no'", "'n'", "'0'", "'YES'", "'false'")} AS threat_flag,
        CASE WHEN f % 29 = 0 THEN NULL ELSE ' rule-' || {_s('f % 12')} END AS rule_name,
        {_pick('f % 9', "'us'", "'India'", "'IN'", "'Russia'", "'china'", "'Germany'", "'unknown'", "NULL", "'United States'")} AS geo_country
      FROM ({base}) AS lg
    """
    return f"SELECT * FROM ({row}) AS a UNION ALL SELECT * FROM ({row} WHERE f % 51 = 0) AS b"


def analyst_messages() -> str:
    """Conversation text with user mentions worked in."""
    return f"""
      SELECT conv_id, turn,
        text || {_pick(
            '(conv_id * 7 + turn) % 8', "' check EMP-' || " + _number('conv_id') + " || '!'",
            "' emp ' || " + _number('conv_id * 3') + " || ' and EMP_' || " + _number('turn'),
            "' ask Casey 00000' || LPAD(" + _s('conv_id % 10000') + ", 4, '0') || '.'",
            "' see user' || " + _number('conv_id % 900') + " || ', please'", "' USR-42 / usr 43'",
            "' EMP99999999'", "' alex morgan again, EMP1'", "''")} AS text
      FROM conversations
    """


RAW_SQL = {
    "identity": raw_identity, "iam": raw_iam, "endpoint": raw_endpoint,
    "firewall": raw_firewall, "messages": analyst_messages,
}


# what one task reads of a test table: its derived text is some fifty times as large
TASK_BYTES = 1 << 20


def _bytes(spark: SparkSession, files: list[str]) -> int:
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return sum(path(f).getFileSystem(conf).getContentSummary(path(f)).getLength() for f in files)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The test table in as many partitions as its size asks for, at least one for each core.

    A file's row groups are its only splits, however large they are, so a scan of fewer partitions is
    spread: the derived text of one task stays the same size in a larger table.
    """
    df = spark.read.parquet(path)
    wanted = max(spark.sparkContext.defaultParallelism, -(-_bytes(spark, df.inputFiles()) // TASK_BYTES))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw telemetry table, derived from the whole test tables under ``sf_dir``."""
    sql = RAW_SQL[table]()
    for name in TABLES:
        mention = re.compile(rf"\bFROM {name}\b")
        if mention.search(sql):
            _scan(spark, f"{sf_dir}/{name}.parquet").createOrReplaceTempView(f"feed_{name}")
            sql = mention.sub(f"FROM feed_{name}", sql)
    return spark.sql(sql)
