"""Categorical rules. The maps are fixed values: each source's spelling -> canonical value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import IDENTITY_NAME_TOKENS, endpoint_text, iam_text
from .text import lookup, lookup_or_same, null_if_in


def _spellings(groups: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {spelling: value for value, spellings in groups.items() for spelling in spellings}


# --- fixed values: identity master (case-sensitive) -----------------------------------
IDENTITY_DEPARTMENTS = _spellings({
    "Finance": ("Accounts", "FINANCE", "Fin", "Finance", "finance dept"),
    "Human Resources": ("HR", "Human Resource", "Human Resources", "hr dept"),
    "IT": ("IT", "IT Dept", "IT Support", "Information Technology", "information tech"),
    "Legal": ("LEGAL", "Legal", "Legal Dept", "legal"),
    "Marketing": ("MKT", "Marketing", "Mktg", "marketing dept"),
    "Operations": ("OPERATIONS", "Operations", "Ops", "Ops Team", "operations dept"),
    "Procurement": ("PURCH", "Procurement", "Purchase", "procurement team"),
    "R&D": ("R&D", "RD", "Research and Development", "RnD"),
    "Sales": ("SALES", "Sales", "Business Sales", "sales dept", "sales team"),
    "Customer Support": ("CS", "Customer Support", "Support", "customer care", "Call Center"),
    "Supply Chain": ("Supply Chain",),
    "People": ("People Team",),
    "Compliance": ("Compliance",),
    "Brand": ("Brand Team",),
    "Innovation": ("Innovation",),
})

IDENTITY_LOCATIONS = _spellings({
    "Branch Office": ("BRANCH OFFICE", "Branch Office", "Branch_Office", "branch office"),
    "Data Center": ("DATA CENTER", "Data Center", "Data_Center", "data center"),
    "Head Office": ("HEAD OFFICE", "Head Office", "Head_Office", "head office"),
    "Regional Office": ("REGIONAL OFFICE", "Regional Office", "Regional_Office", "regional office"),
    "Remote": ("REMOTE", "Remote", "remote"),
    "Warehouse": ("WAREHOUSE", "Warehouse", "warehouse"),
    "Work From Home": ("WORK FROM HOME", "Work From Home", "Work_From_Home", "work from home"),
})

IDENTITY_STATUSES = _spellings({
    "Active": ("A", "ACTIVE", "Active", "Enabled", "Live", "Working"),
    "Disabled": ("Blocked", "D", "DISABLED", "Deactivated", "Disabled"),
    "Inactive": ("Exited", "L", "LEFT", "Left", "LWP", "Leave", "Resigned", "Terminated"),
    "On Leave": ("ON_LEAVE", "On Leave", "OOO"),
})

# --- fixed values: IAM audit trail (upper-cased input) ---------------------------------
IAM_DEPARTMENTS = _spellings({
    "IT": ("IT", "INFORMATION TECHNOLOGY", "IT DEPT"),
    "Human Resources": ("HR", "HUMAN RESOURCES", "HUMAN RESOURCE"),
    "Finance": ("FINANCE", "FIN"),
    "Operations": ("OPERATIONS", "OPS", "OPS TEAM", "OPERATIONS DEPT"),
    "Sales": ("SALES",),
    "Marketing": ("MARKETING", "MKT"),
    "Legal": ("LEGAL",),
    "Procurement": ("PROCUREMENT",),
    "Customer Support": ("CUSTOMER SUPPORT", "CUSTOMER SERVICE"),
    "Supply Chain": ("SUPPLY CHAIN",),
    "R&D": ("R&D", "RESEARCH AND DEVELOPMENT"),
    "Compliance": ("COMPLIANCE",),
    "People": ("PEOPLE",),
    "Brand": ("BRAND",),
    "Innovation": ("INNOVATION",),
})

IAM_EVENT_TYPES = _spellings({
    "LOGIN_SUCCESS": ("LOGIN_SUCCESS", "AUTH_SUCCESS", "SSO_SUCCESS", "LOGIN", "LOGON_SUCCESS"),
    "LOGIN_FAILURE": (
        "LOGIN_FAILURE", "AUTH_FAILURE", "SSO_FAILURE", "LOGIN_FAILED", "AUTH_FAILED",
    ),
    "MFA_FAILURE": ("MFA_FAILURE", "MFA_FAILED"),
    "ACCOUNT_LOCK": ("ACCOUNT_LOCK", "ACCOUNT_LOCKED"),
    "ACCOUNT_UNLOCK": ("ACCOUNT_UNLOCK", "ACCOUNT_UNLOCKED"),
    "DEVICE_REGISTERED": ("DEVICE_REGISTERED", "DEVICE_REGISTRATION"),
    "MFA_ENROLLMENT": ("MFA_ENROLLMENT", "MFA_ENROLLED"),
    "PASSWORD_RESET": ("PASSWORD_RESET", "PASSWORD_CHANGED"),
    "PRIVILEGE_ESCALATION_REQUEST": ("PRIVILEGE_ESCALATION_REQUEST", "PRIVILEGE_ESCALATION"),
    "SESSION_TERMINATED": ("SESSION_TERMINATED", "SESSION_END"),
})

IAM_FAILURE_REASONS = _spellings({
    "INVALID_CREDENTIALS": ("INVALID CREDENTIALS",),
    "TIMEOUT": ("TIMEOUT",),
    "UNKNOWN_USER": ("UNKNOWN USER",),
    "BAD_TOKEN": ("BAD TOKEN",),
    "ACCOUNT_LOCKED": ("ACCOUNT LOCKED",),
    "WRONG_PASSWORD": ("WRONG_PASSWORD", "WRONG PASSWORD"),
    "OTP_EXPIRED": ("OTP EXPIRED",),
    "MFA_FAILED": ("MFA FAILED",),
    "EXPIRED_PASSWORD": ("EXPIRED PASSWORD",),
})

IAM_PASSED = ("TRUE", "YES", "Y", "1", "PASSED", "PASS")
IAM_NOT_PASSED = ("FALSE", "NO", "N", "0", "FAILED", "FAIL")
IAM_LEVELS = ("LOW", "MEDIUM", "HIGH")
IAM_GEO_TOKENS = ("", "NONE", "N/A", "NA")
IAM_PLACES = _spellings({
    "INDIA": ("IN", "INDIA", "IND"),
    "PUNJAB": ("PB", "PUNJAB"),
    "DELHI": ("DL", "DELHI"),
})

# --- fixed values: endpoint alerts (upper-cased input) ---------------------------------
ENDPOINT_SEVERITIES = _spellings({
    "Critical": ("P1", "S1", "CRIT", "CRITICAL", "SEVERE"),
    "High": ("P2", "S2", "H", "HIGH", "MAJOR"),
    "Medium": ("P3", "S3", "MEDIUM", "MODERATE", "M"),
    "Low": ("P4", "S4", "LOW", "MINOR", "L"),
})
ENDPOINT_STATUSES = _spellings({
    "New": ("NEW", "N"),
    "Open": ("OPEN", "O", "ACTIVE"),
    "In Progress": ("IN_PROGRESS", "IN PROGRESS", "WIP", "INVESTIGATING"),
    "Resolved": ("RESOLVED", "R"),
    "Closed": ("CLOSED", "C", "NOT MALICIOUS", "FALSE_POSITIVE", "FALSE POSITIVE", "FP"),
    "Unassigned": ("UNASSIGNED", "U"),
})
ENDPOINT_CRITICALITIES = _spellings({
    "Critical": ("CRITICAL", "C", "P1"),
    "High": ("HIGH", "H", "P2"),
    "Medium": ("MEDIUM", "M", "P3"),
    "Low": ("LOW", "L", "P4"),
})
ALLOWED_LEVELS = ("Critical", "High", "Medium", "Low")
ALLOWED_STATUSES = ("New", "Open", "In Progress", "Resolved", "Closed", "Unassigned")
UNRESOLVED_STATUSES = ("New", "Open", "In Progress", "Unassigned")

# --- fixed values: firewall logs (upper-cased input) -----------------------------------
FIREWALL_PROTOCOLS = _spellings({
    "TCP": ("TCP", "TCP/6", "6"), "UDP": ("UDP", "UDP/17", "17"), "ICMP": ("ICMP", "1"),
})
FIREWALL_ACTIONS = _spellings({
    "ALLOW": ("ALLOW", "PERMIT", "PASS"), "DENY": ("DENY", "DROP", "BLOCK"),
})
FIREWALL_COUNTRIES = _spellings({
    "US": ("US", "UNITED STATES"), "IN": ("IN", "IND", "INDIA"), "RU": ("RU", "RUSSIA"),
    "CN": ("CN", "CHINA"), "UNKNOWN": ("UNKNOWN",),
})
FIREWALL_TRUE = ("true", "yes", "y", "1")
FIREWALL_FALSE = ("false", "no", "n", "0")


# --- rules (stripped input) -------------------------------------------------------------------------------

def identity_category(c: Column, mapping: dict[str, str]) -> Column:
    """Case-sensitive lookup; unmapped is null."""
    return lookup(null_if_in(c, IDENTITY_NAME_TOKENS, F.lower(c)), mapping)


def iam_category(c: Column, mapping: dict[str, str] | None = None) -> Column:
    """Upper-cased lookup; unmapped passes through in upper case."""
    text = F.upper(iam_text(c))
    return lookup_or_same(text, mapping) if mapping else text


def iam_mfa_passed(c: Column) -> Column:
    text = F.upper(c)
    return F.when(text.isin(*IAM_PASSED), True).when(text.isin(*IAM_NOT_PASSED), False)


def iam_risk_level(c: Column) -> Column:
    text = F.upper(c)
    return F.when(text.isin(*IAM_LEVELS), text)


def iam_geo(c: Column) -> Column:
    return lookup_or_same(null_if_in(F.upper(c), IAM_GEO_TOKENS), IAM_PLACES)


def endpoint_category(c: Column, mapping: dict[str, str]) -> Column:
    return lookup(F.upper(endpoint_text(c)), mapping)


def sha256_valid(c: Column) -> Column:
    """Null when missing."""
    return endpoint_text(c).rlike(r"^[0-9A-Fa-f]{64}$")


def firewall_category(c: Column, mapping: dict[str, str], other: str | None = None) -> Column:
    """Upper-cased lookup; blank is null, unmapped is ``other``."""
    text = null_if_in(F.upper(c), ("",))
    value = lookup(text, mapping)
    return F.when(text.isNotNull(), F.coalesce(value, F.lit(other))) if other else value


def firewall_threat_flag(c: Column) -> Column:
    text = F.lower(c)
    return F.when(text.isin(*FIREWALL_TRUE), True).when(text.isin(*FIREWALL_FALSE), False)
