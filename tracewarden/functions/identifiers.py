"""Identifier rules: users, hosts, devices, sessions and the cross-source keys.

Source rules take stripped text (see ``text.stripped``); the cross-source keys strip on
their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import null_if_in, strip

# Tokens each source treats as missing.
IDENTITY_ID_TOKENS = ("", "NAN", "NONE", "NULL", "NA")
IDENTITY_NAME_TOKENS = ("", "nan", "none", "null", "na", "n/a")
IAM_TOKENS = ("", "NA", "N/A", "NONE", "NULL", "UNKNOWN")
ENDPOINT_TOKENS = ("", "NA", "N/A", "NONE", "NULL", "NAN", "NOT AVAILABLE", "UNKNOWN")
RISK_KEY_TOKENS = ("", "NAN", "NONE", "NULL", "NA", "<NA>")

DOMAIN = ".corp.local"
DOMAIN_SUFFIX = r"\.corp\.local$"


def _employee_id(c: Column) -> Column:
    """All-digit ids belong to the EMP series."""
    return F.when(c.rlike(r"^[0-9]+$"), F.concat(F.lit("EMP"), c)).otherwise(c)


def _alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Z0-9]", "")


# --- identity master -------------------------------------------------------------

def identity_user_id(c: Column) -> Column:
    compact = _alphanumeric(F.upper(c))
    return _employee_id(null_if_in(compact, IDENTITY_ID_TOKENS))


def identity_username(c: Column) -> Column:
    return null_if_in(F.lower(c), IDENTITY_NAME_TOKENS)


def _short_upper_host(c: Column) -> Column:
    return F.translate(F.regexp_replace(c, r"\.CORP\.LOCAL$", ""), "_", "-")


def _compact_device(c: Column) -> Column:
    return F.regexp_replace(c, r"[\s-]+", "")


def identity_hostname(c: Column) -> Column:
    return _short_upper_host(null_if_in(F.upper(c), IDENTITY_ID_TOKENS))


def identity_device_id(c: Column) -> Column:
    return _compact_device(null_if_in(F.upper(c), IDENTITY_ID_TOKENS))


# --- IAM audit trail ---------------------------------------------------------------

def iam_text(c: Column) -> Column:
    return null_if_in(c, IAM_TOKENS, F.upper(c))


def iam_user_id(c: Column) -> Column:
    compact = _alphanumeric(F.upper(iam_text(c)))
    return _employee_id(null_if_in(compact, ("",)))


def iam_hostname(c: Column) -> Column:
    return _short_upper_host(F.upper(iam_text(c)))


def iam_device_id(c: Column) -> Column:
    return _compact_device(F.upper(iam_text(c)))


# --- endpoint alerts ---------------------------------------------------------------

def endpoint_text(c: Column) -> Column:
    return null_if_in(c, ENDPOINT_TOKENS, F.upper(c))


def endpoint_label(c: Column) -> Column:
    return F.trim(F.regexp_replace(endpoint_text(c), r"\s+", " "))


def endpoint_user_id(c: Column) -> Column:
    compact = _alphanumeric(F.upper(endpoint_text(c)))
    return null_if_in(_employee_id(compact), ("",))


def endpoint_hostname(c: Column) -> Column:
    """Full lower-case name; the domain suffix stays."""
    return F.translate(F.lower(endpoint_text(c)), "_", "-")


def endpoint_host_key(c: Column) -> Column:
    return null_if_in(F.regexp_replace(endpoint_hostname(c), DOMAIN_SUFFIX, ""), ("",))


# --- firewall logs -----------------------------------------------------------------

def firewall_hostname(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("_"), F.lit("-"))


def firewall_host_key(c: Column) -> Column:
    """Stripped text ends where its pattern would: the suffix is cut by its length."""
    host = firewall_hostname(c)
    return F.when(host.endswith(DOMAIN), F.substr(host, F.lit(1), F.length(host) - len(DOMAIN))).otherwise(host)


def firewall_session_id(c: Column) -> Column:
    text = F.upper(c)
    return F.when(text.rlike(r"^SID-\d{6}$"), F.replace(text, F.lit("-"), F.lit(""))).otherwise(text)


# --- cross-source keys ---------------------------------------------------------------

def link_key(c: Column) -> Column:
    """Key form for linkage reports and detections."""
    return null_if_in(F.upper(strip(c)), ("",))


def risk_key(c: Column) -> Column:
    return _employee_id(null_if_in(F.upper(strip(c)), RISK_KEY_TOKENS))


def queue_key(c: Column) -> Column:
    return _employee_id(F.upper(strip(c)))


def link_hostname(c: Column, compat: bool = False) -> Column:
    """Host key for cross-source comparison.

    ``compat`` leaves the dot in front of the removed domain suffix, as the published
    linkage and detection reports were computed.
    """
    text = F.translate(F.lower(strip(c)), "_", "-")
    return null_if_in(F.regexp_replace(text, DOMAIN_SUFFIX, "." if compat else ""), ("",))
