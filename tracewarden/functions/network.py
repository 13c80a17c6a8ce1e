"""Network fields: addresses, ports, byte counts, scores. Input is stripped text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import IAM_TOKENS, iam_text

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4_BODY = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
IPV4 = rf"^{_IPV4_BODY}$"


def _ipv6_pattern() -> str:
    """All spellings of eight 16-bit groups with at most one ``::`` and an IPv4 tail."""
    group = "[0-9A-Fa-f]{1,4}"
    forms = [rf"(?:{group}:){{7}}{group}", rf"(?:{group}:){{6}}{_IPV4_BODY}"]
    for left in range(8):
        head = rf"{group}(?::{group}){{{left - 1}}}::" if left else "::"
        room = 7 - left
        tails = [rf"{group}(?::{group}){{0,{room - 1}}}"] if room else []
        if room >= 2:
            tails.append(rf"(?:{group}:){{0,{room - 2}}}{_IPV4_BODY}")
        forms.append(head + (rf"(?:{'|'.join(tails)})?" if tails else ""))
    return rf"^(?:{'|'.join(forms)})(?:%[^%/]+)?$"


IPV6 = _ipv6_pattern()

# IPv4 networks that are not globally reachable, as address prefixes:
# 0/8 10/8 127/8, 169.254/16, 172.16/12, 192.0.0/24 192.0.2/24, 192.168/16, 198.18/15,
# 198.51.100/24, 203.0.113/24, 240/4.
PRIVATE_IPV4 = (
    r"^(?:(?:0|10|127|24\d|25[0-5])|169\.254|172\.(?:1[6-9]|2\d|3[01])|192\.0\.[02]|192\.168"
    r"|198\.1[89]|198\.51\.100|203\.0\.113)\."
)
# Addresses inside 192.0.0.0/24 that are reachable.
REACHABLE_IPV4 = ("192.0.0.9", "192.0.0.10")


def _colon(c: Column) -> Column:
    """Every IPv6 text has a colon and no IPv4 text has one, so one of the two patterns is enough."""
    return c.contains(":")


def is_private_ipv4(c: Column) -> Column:
    return c.rlike(PRIVATE_IPV4) & ~c.isin(*REACHABLE_IPV4)


def ip_status(c: Column) -> Column:
    return (
        F.when(c.isNull() | (c == ""), "MISSING")
        .when(F.upper(c).isin(*IAM_TOKENS), "UNKNOWN")
        .when(c.rlike(IPV4), F.when(is_private_ipv4(c), "VALID_PRIVATE").otherwise("VALID_PUBLIC"))
        .when(_colon(c) & c.rlike(IPV6), "VALID_OTHER")
        .otherwise("MALFORMED")
    )


def source_ip(c: Column) -> Column:
    """Malformed text is kept for the analyst."""
    return iam_text(c)


def ip_valid(c: Column) -> Column:
    """True or false, null when blank."""
    return F.when(c != "", F.when(_colon(c), c.rlike(IPV6)).otherwise(c.rlike(IPV4)))


_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def finite(text: Column) -> Column:
    """Plain decimal text as double; Java-only spellings such as ``1d`` or ``NaN`` are null."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def port(c: Column) -> Column:
    return whole_port(finite(c))


def whole_port(number: Column) -> Column:
    return F.when(number.between(0, 65535) & (number % 1 == 0), number.cast("int"))


def field_status(raw: Column, value: Column) -> Column:
    """How a raw text became ``value``: missing, invalid or valid."""
    return (
        F.when(F.coalesce(raw, F.lit("")) == "", "missing")
        .when(value.isNull(), "invalid")
        .otherwise("valid")
    )


_BYTES = r"^[-+]?\d+(?:\.\d+)?\s*(?:[KkMmGg][Bb])?$"
# Bytes per unit.
UNIT_BYTES = {"KB": 1024.0, "MB": 1024.0**2, "GB": 1024.0**3}


def byte_count(raw: Column) -> Column:
    c = F.replace(raw, F.lit(","), F.lit(""))
    unit = F.upper(F.right(c, F.lit(2)))
    number = F.trim(F.substr(c, F.lit(1), F.length(c) - 2)).try_cast("double")
    size = c.try_cast("double")
    for name, scale in UNIT_BYTES.items():
        size = F.when(unit == name, number * scale).otherwise(size)
    # rint() rounds the binary double half to even
    whole = F.rint(size).try_cast("bigint")
    # the pattern is tried once; only "-0" and what rounds to it are zero with a sign
    return F.when(c.rlike(_BYTES), F.when(size >= 0, whole))


def iam_score(c: Column) -> Column:
    """``78/100`` or a plain number, kept only inside 0..100."""
    ratio = r"^(\d+(?:\.\d+)?)\s*/\s*100$"
    number = F.when(c.rlike(ratio), F.regexp_extract(c, ratio, 1).try_cast("double")).otherwise(
        finite(c)
    )
    return F.when(number.between(0, 100), number)
