"""Truth tables of the field rules."""

import pytest
from helpers import applied, at

from tracewarden.functions import categories as cat
from tracewarden.functions import identifiers as ids
from tracewarden.functions import network as net
from tracewarden.functions import timestamps as times

CASES = [
    (ids.identity_user_id, {" emp-00123 ": "EMP00123", "123": "EMP123", "N/A": None, "--": None,
                            None: None, " emp7\t": "EMP7"}),
    (ids.iam_user_id, {"unknown": None, "EMP_7": "EMP7", "nan": "NAN", "42": "EMP42", "n/a": None}),
    (ids.endpoint_user_id, {"nan": None, "not available": None, "EMP-12345": "EMP12345", "--": None}),
    (ids.identity_hostname, {"ws_102.corp.local": "WS-102", "WS-102": "WS-102", "na": None}),
    (ids.iam_hostname, {"ws_102.corp.local": "WS-102", "unknown": None}),
    (ids.endpoint_hostname, {"WS_10202.CORP.LOCAL": "ws-10202.corp.local"}),
    (ids.endpoint_host_key, {"WS_10202.CORP.LOCAL": "ws-10202", " ": None}),
    (ids.firewall_host_key, {"GW_1.corp.local": "gw-1", "unknown": "unknown"}),
    (ids.link_hostname, {"ws-1.corp.local": "ws-1", "": None}),
    (lambda c: ids.link_hostname(c, compat=True), {"ws-1.corp.local": "ws-1."}),
    (ids.identity_device_id, {"dev - 12 3": "DEV123", "null": None}),
    (ids.identity_username, {" Ann ": "ann", "N/A": None}),
    (ids.endpoint_label, {"a  b\tc": "a b c", "unknown": None}),
    (ids.risk_key, {"nan": None, "12": "EMP12", "emp1": "EMP1", "<NA>": None}),
    (ids.queue_key, {"12": "EMP12", " x ": "X"}),
    (lambda c: cat.identity_category(c, cat.IDENTITY_DEPARTMENTS),
     {"hr dept": "Human Resources", "HR DEPT": None, "none": None}),
    (lambda c: cat.iam_category(c, cat.IAM_DEPARTMENTS), {"ops": "Operations", "hr dept": "HR DEPT"}),
    (lambda c: cat.identity_category(c, cat.IDENTITY_STATUSES),
     {"LWP": "Inactive", "OOO": "On Leave", "Live": "Active", "x": None}),
    (lambda c: cat.identity_category(c, cat.IDENTITY_LOCATIONS),
     {"Head_Office": "Head Office", "work from home": "Work From Home", "head_office": None}),
    (lambda c: cat.iam_category(c, cat.IAM_EVENT_TYPES),
     {"auth_failed": "LOGIN_FAILURE", "token_refresh": "TOKEN_REFRESH", "unknown": None}),
    (lambda c: cat.endpoint_category(c, cat.ENDPOINT_SEVERITIES),
     {"p1": "Critical", "MAJOR": "High", "zzz": None, "N/A": None}),
    (lambda c: cat.endpoint_category(c, cat.ENDPOINT_STATUSES), {"fp": "Closed", "wip": "In Progress"}),
    (cat.iam_mfa_passed, {"Yes": True, "fail": False, "maybe": None, None: None}),
    (cat.iam_risk_level, {"high": "HIGH", "78/100": None}),
    (cat.iam_geo, {"in": "INDIA", "unknown": "UNKNOWN", "n/a": None, "Goa": "GOA"}),
    (net.iam_score, {"78/100": 78.0, "101": None, "high": None, "nan": None, "78 / 100": 78.0,
                     "0": 0.0, "-1": None, "1d": None}),
    (net.ip_status, {
        None: "MISSING", " ": "MISSING", "unknown": "UNKNOWN", "10.0.0.1": "VALID_PRIVATE",
        "198.18.0.1": "VALID_PRIVATE", "100.64.0.1": "VALID_PUBLIC", "8.8.8.8": "VALID_PUBLIC",
        "192.0.0.9": "VALID_PUBLIC", "192.0.0.8": "VALID_PRIVATE", "240.0.0.1": "VALID_PRIVATE",
        "fe80::1": "VALID_OTHER", "::": "VALID_OTHER", "::ffff:1.2.3.4": "VALID_OTHER",
        "1:2:3:4:5:6:7:8": "VALID_OTHER", "1:2:3:4:5:6:7::": "VALID_OTHER",
        "1:2:3:4:5:6:7": "MALFORMED", "1::2::3": "MALFORMED", "12345::": "MALFORMED",
        "192.168.01.1": "MALFORMED", "10.0.0.256": "MALFORMED", "10.0.0": "MALFORMED"}),
    (net.ip_valid, {"8.8.8.8": True, "999.1.1.1": False, "": None, None: None}),
    (net.port, {"80": 80, "80.0": 80, "65536": None, "-1": None, "80.5": None, "abc": None,
                "NaN": None, "1d": None, "65535": 65535}),
    (net.byte_count, {"1,024": 1024, "1.5 KB": 1536, "2mb": 2097152, "2.5": 2, "3.5": 4, "-5": None,
                      "5 TB": None, "1 gb": 1073741824}),
    (lambda c: cat.firewall_category(c, cat.FIREWALL_PROTOCOLS, "OTHER"),
     {"tcp/6": "TCP", "17": "UDP", "gre": "OTHER", "": None}),
    (lambda c: cat.firewall_category(c, cat.FIREWALL_ACTIONS, "OTHER"),
     {"permit": "ALLOW", "drop": "DENY", "x": "OTHER", " ": None}),
    (lambda c: cat.firewall_category(c, cat.FIREWALL_COUNTRIES),
     {"india": "IN", "Germany": None, "unknown": "UNKNOWN"}),
    (cat.firewall_threat_flag, {"YES": True, "0": False, "maybe": None}),
    (ids.firewall_session_id, {"sid-123456": "SID123456", "SID-12": "SID-12"}),
    (cat.iam_category, {"sid-123456": "SID-123456", "unknown": None}),
    (cat.sha256_valid, {"a" * 64: True, "a" * 63: False, "unknown": None}),
    (times.mixed_timestamp, {
        "1700000000": at("2023-11-14 22:13:20"), "05/01/2024": at("2024-01-05"),
        "01/25/2024": at("2024-01-25"), "5-Jan-2024": at("2024-01-05"),
        "05-JAN-2024 10:11:12": at("2024-01-05 10:11:12"),
        "01-25-2024 01:02:03 PM": at("2024-01-25 13:02:03"),
        "01-25-2024 12:02:03 am": at("2024-01-25 00:02:03"),
        "13-05-2024 01:00:00 PM": at("2024-05-13 13:00"), "2024-01-25garbage": None,
        "2024-01-25T01:02:03": at("2024-01-25 01:02:03"), "2024/02/30": None,
        "2024-01-25 01:02:03.5": at("2024-01-25 01:02:03.5"), "5/1/2024": at("2024-05-01"),
        "13-05-2024": at("2024-05-13"), "": None, "soon": None}),
    (times.identity_timestamp, {"Not Available": None, "2024-01-05": at("2024-01-05")}),
    (times.endpoint_timestamp, {
        "1700000000.0": at("2023-11-14 22:13:20"), "5/1/2024": at("2024-01-05"),
        "01/25/2024": at("2024-01-25"), "2024-01-25T01:02": None, "2024-01-25 01:02": None,
        "25-Jan-2024 10:30": at("2024-01-25 10:30"), "01-25-2024 1:02 pm": at("2024-01-25 13:02")}),
    (times.firewall_timestamp, {
        "25/01/2024 10:30": at("2024-01-25 10:30"), "01/25/2024": None,
        "01-25-2024 01:02:03 PM": at("2024-01-25 13:02:03"), "01-25-2024 01:02:03 pm": None,
        "25-Jan-2024 10:30:00": at("2024-01-25 10:30"), "2024/01/25": at("2024-01-25"),
        "25/01/2024 10:30:00": None, "1700000000": at("2023-11-14 22:13:20")}),
]


@pytest.mark.parametrize("rule, table", CASES)
def test_rule(spark, rule, table):
    assert applied(spark, rule, list(table)) == list(table.values())
