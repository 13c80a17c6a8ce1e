"""Raw scans and input contracts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_token
from ..schemas import RAW_COLUMNS, text_schema


def missing_columns(df: DataFrame, table: str) -> list[str]:
    return [name for name in RAW_COLUMNS[table] if name not in df.columns]


def unexpected_columns(df: DataFrame, table: str) -> list[str]:
    return [name for name in df.columns if name not in RAW_COLUMNS[table] and name != MALFORMED]


def require_columns(df: DataFrame, table: str) -> DataFrame:
    """Fail before any job runs when a required column is absent."""
    missing = missing_columns(df, table)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def expected_only(df: DataFrame, table: str) -> DataFrame:
    return require_columns(df, table).select(*RAW_COLUMNS[table])


def with_null_tokens(df: DataFrame) -> DataFrame:
    """Apply the missing-value rule of delimited and spreadsheet scans to text columns."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(*[null_token(F.col(n)).alias(n) if n in text else F.col(n) for n in df.columns])


def _all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).cast("string") for name in df.columns])


def header_groups(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> the files under it. One line of each file is read, by the driver that lists them anyway."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> str:
        where = jvm.org.apache.hadoop.fs.Path(name)
        stream, codec = where.getFileSystem(conf).open(where), codecs.getCodec(where)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return (reader.readLine() or "").lstrip("\ufeff")
        finally:
            reader.close()

    names = [r["path"] for r in spark.read.format("binaryFile").load(path).where("length > 0").select("path").collect()]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for name, line in zip(names, pool.map(first_line, names)):
            groups.setdefault(line, []).append(name)
    return groups


def scan_csv(
    spark: SparkSession, path: str, table: str, multi_line: bool | None = None
) -> DataFrame:
    """Identity, endpoint and firewall exports.

    The header decides the columns, so an absent column is reported and an extra one is
    visible to the caller; every column is text. Files that order their columns differently, or have
    columns of their own, are read group by group and joined by name; each group must have the required
    columns. ``multi_line`` lets quoted fields hold line breaks but keeps a file in one task; by default it is off for
    firewall logs, whose machine-written fields have none, so that large files are split.
    """
    breaks = table != "firewall" if multi_line is None else multi_line
    # without enforceSchema a file whose header differs from its group's is an error
    reader = (spark.read.option("header", True).option("escape", '"').option("multiLine", breaks)
              .option("enforceSchema", False))
    groups = header_groups(spark, path)
    parts = [require_columns(reader.csv(files), table) for files in groups.values()] if len(groups) > 1 else [
        require_columns(reader.csv(path), table)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return with_null_tokens(result)


MALFORMED = "_malformed"


def scan_json(spark: SparkSession, path: str, table: str = "iam", lines: bool = False) -> DataFrame:
    """IAM export: an array of records, or one record per line for splittable input.

    No file is looked at beforehand: the expected columns are read as text, and a record that is no
    JSON is kept in ``_malformed``. Whether a column is absent shows while the rows are first used, see
    ``Contract``.
    """
    schema = T.StructType([*text_schema(table), T.StructField(MALFORMED, T.StringType())])
    return (spark.read.options(multiLine=not lines, primitivesAsString=True, columnNameOfCorruptRecord=MALFORMED)
            .schema(schema).json(path))


class Contract:
    """Counts, while a raw table is first used, what its contract asks: values per expected column
    and malformed records. ``watched`` is the table to use, ``check`` judges once that use has ended."""

    def __init__(self, raw: DataFrame, table: str):
        self.table, self.seen = table, Observation()
        self.columns = [c for c in RAW_COLUMNS[table] if c in raw.columns]
        counts = [F.count(c).alias(c) for c in self.columns]
        if MALFORMED in raw.columns:
            counts.append(F.count(MALFORMED).alias(MALFORMED))
        self.watched = raw.observe(self.seen, F.count(F.lit(1)).alias("_rows"), *counts)

    def check(self) -> int:
        """The malformed records; an error if a column of a read-as-asked table held no value at all."""
        found = self.seen.get
        malformed = found.get(MALFORMED)
        if malformed is not None and (found["_rows"] or 0) > 0:
            absent = [c for c in self.columns if not found[c]]
            if absent:
                raise ValueError(f"Missing required columns: {absent}")
        return malformed or 0


def scan_json_lines(spark: SparkSession, path: str, table: str = "iam") -> DataFrame:
    return scan_json(spark, path, table, lines=True)


def scan_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Parquet export of a raw table; columns become text, under the missing-value rule of CSV."""
    df = _all_text(require_columns(spark.read.parquet(path), table))
    return df if table == "iam" else with_null_tokens(df)


SCANS = {
    "csv": scan_csv, "json": scan_json, "jsonl": scan_json_lines, "parquet": scan_parquet,
}


def scan(spark: SparkSession, table: str, path: str, kind: str, options: dict | None = None) -> DataFrame:
    """``options``: further arguments of the kind's scan, such as ``multi_line``."""
    return SCANS[kind](spark, path, table, **(options or {}))


def check_raw_inputs(spark: SparkSession, inputs: dict[str, tuple]) -> None:
    """``inputs``: table -> (path, kind[, options]). Resolves every path and, but for JSON, the columns; reads no rows."""
    problems = []
    for table in RAW_COLUMNS:
        if table not in inputs:
            problems.append(f"{table}: no input given")
            continue
        try:
            scan(spark, table, *inputs[table])
        except Exception as error:  # noqa: BLE001 - every cause is reported together
            problems.append(f"{table}: {type(error).__name__}: {str(error).splitlines()[0]}")
    if problems:
        raise FileNotFoundError("Raw inputs not usable: " + "; ".join(problems))
