"""Rules that choose a pattern by a character give what trying all patterns gives."""

from datetime import datetime

from pyspark.sql import functions as F

from helpers import applied

from tracewarden.functions import identifiers, network, timestamps


def test_firewall_times_by_place(spark):
    texts = ["2024-01-05 10:11:12", "2024-01-05T10:11:12", "05/01/2024", "05/01/2024 10:11", "05-jan-2024 10:11:12", "01-25-2024 12:00:00 AM",
             "01-25-2024 12:30:00 PM", "01-25-2024 13:00:00 PM", "01-25-2024 00:10:00 AM", "01-25-2024 01:00:00 pm", "2024/01/05", "1704067200",
             "05-Xyz-2024 10:11:12", "31/02/2024", "2024-01-05", "01/0-2024", "", None]
    day = datetime(2024, 1, 5, 10, 11, 12)
    assert applied(spark, timestamps.firewall_timestamp, texts) == [
        day, day, datetime(2024, 1, 5), datetime(2024, 1, 5, 10, 11), day, datetime(2024, 1, 25), datetime(2024, 1, 25, 12, 30), None, None,
        None, datetime(2024, 1, 5), datetime(2024, 1, 1), None, None, None, None, None, None]


def test_sizes_hosts_and_sessions(spark):
    assert applied(spark, network.byte_count, ["1,024", "2.5 KB", "3mb", "5 TB", "-0", "-1", "0.5", "KB", "12\tkB", "1 2", "99999999999999 GB", None]) == [
        1024, 2560, 3 * 1024**2, None, 0, None, 0, None, 12 * 1024, None, None, None]
    assert applied(spark, identifiers.firewall_host_key, ["LPT_1.corp.local", ".corp.local", "a.corp.local.corp.local", "corp.local", None]) == [
        "lpt-1", "", "a.corp.local", "corp.local", None]
    assert applied(spark, identifiers.firewall_session_id, ["sid-123456", "SID-1234567", "sid-12", None]) == ["SID123456", "SID-1234567", "SID-12", None]
    assert applied(spark, network.ip_valid, ["10.0.0.1", "::1", "1.2.3", "::ffff:1.2.3.4", "a:b", "", None]) == [True, True, False, True, False, None, None]


def test_families_are_asked_by_one_character(spark):
    """Before, every text of another family ran into all patterns: two of each for one that fits."""
    text = str(timestamps.firewall_timestamp(F.col("v")))
    assert text.count("regexp_replace") == 0 and text.count("regexp_extract") == 0
    size = str(network.byte_count(F.col("v")))
    assert "regexp_extract" not in size
