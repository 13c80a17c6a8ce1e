"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 1..n in the given total order.

    Rows are range-partitioned and sorted in parallel; the sorted rows are checkpointed so
    that the partition sizes and the rows come from the same layout, and each partition adds
    the total size of the partitions before it. Only those sizes, one row per partition, go
    through one task and a broadcast.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()})
        .checkpoint()
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = F.col("_seq") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within + 1)
        .drop("_part", "_seq", "_before")
    )
