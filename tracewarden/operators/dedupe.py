"""Exact duplicates, duplicate keys and the evidence about them.

Everything is a grouping with map-side combine: copies of one row, or rows of one key,
collapse before the shuffle, so a row or key that fills a third of the table costs one
partial result per input split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"
# time fields of a row that hold a text no date family reads
UNPARSED = "_unparsed"


def distinct_with_copies(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per distinct row (nulls equal) plus how often it occurred."""
    columns = columns or df.columns
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))


def _digest(columns: list[str]) -> Column:
    """128 bits of the SHA-256 of text columns; their lengths tell apart where one ends, and null from empty."""
    fields = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.unhex(F.substring(F.sha2(F.concat(*fields), 256), 1, 32))


def distinct_part(df: DataFrame, kept: list[str]) -> DataFrame:
    """The ``kept`` columns of ``distinct_with_copies(df)``, as many rows.

    Text columns that are not kept travel as one digest, so a reader of a few columns never
    shuffles whole rows. One or two such columns are no longer than a digest and stay as they are.
    """
    text = {name for name, kind in df.dtypes if kind == "string"}
    whole = [c for c in df.columns if c in kept or c not in text]
    rest = [c for c in df.columns if c not in whole]
    if len(rest) <= 2:
        return distinct_with_copies(df).select(*kept, COPIES)
    rows = df.select(*whole, _digest(rest).alias("_rest"))
    return distinct_with_copies(rows).select(*kept, COPIES)


def drop_exact_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def duplicate_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """rows, distinct_rows, duplicate_rows in one pass."""
    return distinct_with_copies(df, columns).agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicate_rows"),
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))


def duplicate_key_summary(df: DataFrame, key: str) -> DataFrame:
    """Rows in any duplicate-key group, extra rows beyond the first, and distinct non-null keys.

    Null keys count as one equal group for the first two figures.
    """
    n = F.col("key_rows")
    return key_counts(df, key).agg(
        F.coalesce(F.sum(F.when(n > 1, n).otherwise(0)), F.lit(0)).alias("rows_in_duplicate_groups"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_duplicate_rows"),
        F.count(key).alias("distinct_keys"),
    )


def join_null_safe(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on one key where null equals null, as an equi-join on (is null, value)."""
    return left.join(right.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), how)


def key_evidence(rows: DataFrame, key: str) -> DataFrame:
    """Per key, over rows made distinct by ``distinct_with_copies``.

    ``key_repeats``: several different rows carry the key.
    ``key_conflicts``: in the raw rows the key repeats, and some row of it occurred once.
    """
    return rows.groupBy(key).agg(
        (F.count(F.lit(1)) > 1).alias("key_repeats"),
        ((F.sum(COPIES) > 1) & (F.min(COPIES) == 1)).alias("key_conflicts"),
    )


def flag_duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Add ``key_repeats`` and ``key_conflicts`` to each row.

    Only keys with evidence travel to the join; a hot key is split by AQE's skew join, since
    nothing after the join needs the rows grouped by key again.
    """
    evidence = key_evidence(rows, key).where("key_repeats OR key_conflicts")
    joined = join_null_safe(rows, evidence, key, "left").drop("_key")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(False)) for name in ("key_repeats", "key_conflicts")}
    )


def first_per_key(df: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """The first row of each key in a total order (all columns by default)."""
    order = order or [F.col(name) for name in df.columns if name != key]
    ranked = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(n) for n in df.columns]).alias("row"))
    return df.groupBy(key).agg(F.min(ranked)["row"].alias("row")).select(
        *[F.col(f"row.{n}").alias(n) for n in df.columns]
    )
