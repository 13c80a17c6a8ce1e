"""Published tables: writing, reading back and the output contract."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PUBLISHED


MANIFEST = "_manifest.json"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, folder: str, name: str) -> dict | None:
    """What the last finished run of a dataset has committed; None if none has."""
    _, path, fs = _file_system(spark, f"{folder}/{name}/{MANIFEST}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, folder: str, name: str, entry: dict) -> None:
    """Put the manifest in place by one rename over the former one."""
    hadoop, path, fs = _file_system(spark, f"{folder}/{name}/{MANIFEST}")
    draft = hadoop.Path(f"{folder}/{name}/_{entry['run']}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    overwrite = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(overwrite, 1)
    options[0] = overwrite.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(draft), fs.makeQualified(path), options)


def publish(
    df: DataFrame, folder: str, name: str, kind: str = "parquet", accept: Callable[[], object] | None = None
) -> DataFrame:
    """Write one dataset and return a fresh scan of it, so later stages start from the table.

    The rows go to a folder of their own run; only then a manifest names that run, with its rows
    and schema. Readers follow the manifest, so a run that broke off is never read, and a reader of the former run is
    not disturbed: runs before the former one are deleted. The shuffle files of the write are deleted when it ends, so
    the disk a job needs is that of its largest step, not the sum of them.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    former = manifest(spark, folder, name)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    path = f"{folder}/{name}/run-{run}"
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        if kind == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    if accept:
        accept()
    schema = df.schema.json()
    _commit(spark, folder, name, {
        "run": run, "kind": kind, "rows": seen.get["rows"] or 0, "schema": schema,
        "schema_sha256": hashlib.sha256(schema.encode()).hexdigest(), "former": former and former["run"]})
    if former and former["former"]:
        _, old, fs = _file_system(spark, f"{folder}/{name}/run-{former['former']}")
        fs.delete(old, True)
    return read(spark, folder, name, kind)


def read(
    spark: SparkSession,
    folder: str,
    name: str,
    kind: str = "parquet",
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """The last finished run of a dataset (CSV: all columns as text)."""
    entry = manifest(spark, folder, name)
    if entry is None:
        raise FileNotFoundError(f"{name} is not published in {folder}")
    path = f"{folder}/{name}/run-{entry['run']}"
    if kind == "csv":
        names = T.StructType.fromJson(json.loads(entry["schema"])).names
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.option("header", True).schema(schema).csv(path)
    else:
        df = spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(path)
    return df.select(*columns) if columns else df


def verify_outputs(spark: SparkSession, folder: str, names: Iterable[str] = PUBLISHED) -> DataFrame:
    """One row per expected dataset: name, exists, rows, as the manifests state them; no data is read."""
    found = [(name, manifest(spark, folder, name)) for name in names]
    return spark.createDataFrame(
        [(name, entry is not None, entry["rows"] if entry else 0) for name, entry in found],
        "name string, exists boolean, rows bigint")


def require_outputs(spark: SparkSession, folder: str) -> None:
    report = verify_outputs(spark, folder)
    missing = [row["name"] for row in report.where(~F.col("exists")).select("name").collect()]
    if missing:
        raise FileNotFoundError(f"Expected outputs are missing: {missing}")


def inputs_stamp(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and times of a folder's entries: another one once a table changes."""
    _, path, fs = _file_system(spark, folder)
    entries = sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in fs.listStatus(path))
    return hashlib.sha256(repr(entries).encode()).hexdigest()[:16]
