"""Mixing sources to target weights by Pareto order sampling.

Each source's target is target / size expected copies of each of its documents. The whole part
is certain; the rest is a fixed-size sample: documents ranked by their random odds over their
inclusion odds, taken in that order until the remaining words are used up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import saved
from tracewarden.llm.flat_words import SPACE_WORDS, Spans, flat, pieces

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BUCKETS = 1024
BROADCAST_SOURCES = 10_000
SEED = 17


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: key, source_size and target (weights shared out under the caps).

    The table has a row per source, not per document; ordering it is the only global window.
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy("key")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    capped = (sources
              .withColumn("place", F.row_number().over(order))
              .withColumn("weight", F.get(weights, (F.col("place") - 1) % len(WEIGHTS)))
              .withColumn("cap", F.col("source_size") * float(MOST_COPIES))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (capped
              .withColumn("total", F.sum("source_size").over(every).cast("double"))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(onward))
              # the water level is reached at the first source that its cap does not hold back
              .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "place", "level")))
                          .over(every)["level"]))
    return levels.select("key", "source_size",
                         F.least(F.col("weight") * F.col("level"), F.col("cap")).alias("target"))


def _drawn(docs: DataFrame, seed: int, columns: list[str]) -> DataFrame:
    """row (the columns), key of the source, uniform draw u, and tie (a hash of the text)."""
    draw = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 12), 16, 10)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source")).alias("key"),
        ((draw.cast("double") + 0.5) / 2.0 ** 48).alias("u"), F.xxhash64("text").alias("tie"), "text")


def _sized(drawn: DataFrame) -> DataFrame:
    """The number of words in place of the text."""
    from pyspark.sql.types import LongType, StructType

    schema = StructType([f for f in drawn.schema if f.name != "text"]).add("size", LongType())

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            sizes = [Spans(*flat(piece), SPACE_WORDS).counts for piece in pieces(batch.column(at))]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(sizes or [[]]), pa.int64())], names=[*names, "size"])

    return drawn.mapInArrow(run, schema)


def _rank_value(u, chance):
    """The draw's odds over the inclusion odds, brought back to 0..1."""
    odds = (u / (1 - u)) / (chance / (1 - chance))
    return F.when(chance > 0, odds / (1 + odds)).otherwise(F.lit(1.0))


def source_cuts(sized: DataFrame) -> DataFrame:
    """One row per source: sizes, target, whole copies and the last rank that gets one copy more.

    In rank order a document is taken when its middle lies inside the remaining words; all after
    the first one left out are left out too, so one cut per source tells the sample.
    """
    targets = source_targets(sized).withColumn(
        "copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    targets = saved(targets.select(
        "key", "source_size", "target", F.floor("copies").alias("whole"), (F.col("copies") - F.floor("copies")).alias("chance"),
        (F.col("target") - F.floor("copies") * F.col("source_size")).alias("rest")))
    ranked = (_with_sources(sized, targets).where("chance > 0").withColumn("rank_value", _rank_value(F.col("u"), F.col("chance")))
              .withColumn("bucket", F.least(F.floor(F.col("rank_value") * BUCKETS), F.lit(BUCKETS - 1))))
    sums = ranked.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("key").orderBy("bucket")
    edges = (sums.withColumn("upto", F.sum("words").over(upto)).withColumn("before", F.col("upto") - F.col("words"))
             .join(targets.select("key", "rest"), "key"))
    # the bucket in which the remaining words run out; all buckets before it are taken whole
    edge = saved(edges.where("upto > rest").groupBy("key").agg(F.min("bucket").alias("bucket"), F.min("before").alias("before")))
    inside = (ranked.join(edge, ["key", "bucket"]).groupBy("key", "bucket", "before", "rest", "rank_value", "tie").agg(F.sum("size").alias("size")))
    earlier = Window.partitionBy("key").orderBy("rank_value", "tie").rowsBetween(Window.unboundedPreceding, -1)
    last = (inside.withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
            .where(F.col("ahead") + F.col("size") / 2 <= F.col("rest"))
            .groupBy("key").agg(F.max(F.struct("rank_value", "tie")).alias("last")))
    return saved(targets.join(edge.select("key", "bucket"), "key", "left").join(last, "key", "left").select(
        "key", "source_size", "target", "whole", "chance",
        F.coalesce("last", F.struct((F.coalesce(F.col("bucket") / BUCKETS, F.lit(2.0))).alias("rank_value"),
                                    F.lit(-2 ** 63).cast("long").alias("tie"))).alias("last")))


def _with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join the table of sources, broadcast where its counted rows are few."""
    few = sources.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if few else sources, "key")


def _copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    place = F.struct(_rank_value(F.col("u"), F.col("chance")).alias("rank_value"), F.col("tie"))
    extra = (F.col("chance") > 0) & (place <= F.col("last"))
    return _with_sources(rows, cuts).withColumn("copies", F.col("whole") + extra.cast("long"))


def pareto_mix(docs: DataFrame, seed: int = SEED, columns: list[str] | None = None) -> DataFrame:
    """The rows (or some columns of them) with size, source_size, target, copies and taken added.

    Null sources form the last source; null or empty texts have size 0 and take 0 words. Rows equal
    in id, text and source are taken together or not at all; ids may repeat. An empty table gives
    an empty result.
    """
    narrow = saved(_sized(_drawn(docs, seed, columns or ["doc_id"])))
    cuts = source_cuts(narrow)
    rows = narrow if columns else _sized(_drawn(docs, seed, docs.columns))
    return _copies(rows, cuts).select(
        "row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each repeated as often as it was taken."""
    cuts = source_cuts(saved(_sized(_drawn(docs, seed, ["doc_id"]))))
    taken = _copies(_drawn(docs, seed, docs.columns).drop("text"), cuts).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
