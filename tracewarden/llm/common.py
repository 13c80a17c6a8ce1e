"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracewarden.session import ensure_checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return [v or "" for v in batch.column(name).to_pylist()]


def map_batches(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Map Arrow batches; make() runs once per task and returns batch -> dict of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            # a few hundred rows at a time keep a run of very long texts small in memory
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = step(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                     else columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, make: Callable) -> DataFrame:
    """Filter whole rows, whatever their columns, by a batch -> list of booleans made once per task."""

    def run(batches):
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield part.filter(pa.array(step(part), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a Parquet table below the shared checkpoint folder, and the folder of that table."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discarded(spark: SparkSession, folder: str) -> None:
    """Delete a table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables of a running job, written below the shared checkpoint folder and deleted when the block ends.
    Within the block each query deletes its shuffle files when it ends: later ones read the tables. No side of a join is
    broadcast there: a search asks for hundreds of joins, and the driver would build each small side in its own memory."""

    HELD = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []
        self.before = {name: spark.conf.get(name) for name in self.HELD}

    def table(self, df: DataFrame) -> DataFrame:
        rows, folder = written(df)
        self.folders.append(folder)
        return rows

    def __enter__(self) -> Scratch:
        for name, value in self.HELD.items():
            self.spark.conf.set(name, value)
        return self

    def __exit__(self, *failure) -> None:
        for name, value in self.before.items():
            self.spark.conf.set(name, value)
        for folder in self.folders:
            discarded(self.spark, folder)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node reachable.

    Large-star and small-star rounds, each a written table that the next one replaces; the stars of
    hot nodes are aggregated with a map-side minimum and joined, never gathered.
    """
    spark = edges.sparkSession

    def round_of(df):
        # count and checksum of the pairs, taken while they are written: equal before and after a round once nothing changes
        seen = Observation()
        rows, place = written(df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                                         F.bit_xor(F.xxhash64("b", "a")).alias("y")))
        return rows, place, seen.get

    pairs, folder, known = round_of(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                                    .where("a < b").distinct())
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").where("b != m")
                 .select(F.col("m").alias("a"), "b").distinct())
        small_low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(small_low, "b").select("m", "a", "b"))
        following, place, state = round_of(
            small.select(F.col("m").alias("a"), "b")
            .union(small.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct())
        discarded(spark, folder)
        pairs, folder, before, known = following, place, known, state
        if known == before:
            break
    else:
        raise RuntimeError("components did not settle")
    leaf = pairs.groupBy("b").agg(F.min("a").alias("component"))
    found, _ = written(leaf.select(F.col("b").alias("node"), "component")
                       .union(leaf.select(F.col("component").alias("node"), "component").distinct()))
    discarded(spark, folder)
    return found
