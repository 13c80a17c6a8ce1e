"""Text basics shared by all field rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters removed around a value (Unicode whitespace and the
# ASCII separators); Spark's own trim() removes only the space character.
WHITESPACE = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts a delimited or spreadsheet scan reads as missing (exact match).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def stripped(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """A stage of its own, so that every field rule reads the stripped text computed once."""
    wanted = set(columns)
    return df.select(*[strip(F.col(n)).alias(n) if n in wanted else F.col(n) for n in df.columns])


def null_if_in(c: Column, tokens: Sequence[str], folded: Column | None = None) -> Column:
    """``c``, or null where ``folded`` (default ``c``) is one of ``tokens``."""
    if folded is None and len(tokens) == 1:
        return F.nullif(c, F.lit(tokens[0]))
    probe = c if folded is None else folded
    return F.when(~probe.isin(*tokens), c)


def null_token(c: Column) -> Column:
    """The scan-level missing-value rule for CSV and spreadsheet exports."""
    return null_if_in(c, NULL_TOKENS)


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A constant map, built from one SQL literal."""
    quoted = ["'" + item.replace("'", "\\'") + "'" for entry in mapping.items() for item in entry]
    return F.expr(f"map({', '.join(quoted)})")


def lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Exact lookup; null for null or unmapped input."""
    return F.try_element_at(literal_map(mapping), c)


def lookup_or_same(c: Column, mapping: Mapping[str, str]) -> Column:
    return F.coalesce(lookup(c, mapping), c)


def as_flag(c: Column) -> Column:
    """A comparison used as a flag: unknown counts as false."""
    return F.coalesce(c, F.lit(False))
