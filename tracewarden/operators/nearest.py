"""Closest pair in time between two kinds of events, without forming the pairs.

The closest left/right pair of a group lies next to each other once the group's events are
ordered by time: any event strictly between the two would be closer to one of them. So it is
enough to compare neighbours.

Scale: events are first collapsed to one row per (group, time) with map-side combine. Order is
then taken in two levels, neighbours inside one (group, day) and across the day edges, where a
day contributes only its first and last row. A group that holds a third of all events is thus
spread over its days, and one task sees at most the distinct times of one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _gap(left: Column, right: Column, info: Column) -> Column:
    """A candidate pair; ordered by distance, left time, right time, then right-side facts."""
    return F.struct(F.abs(left - right).alias("gap_us"), left.alias("left_us"),
                    right.alias("right_us"), info.alias("right_info"))


def _candidates(earlier: Column, later: Column) -> list[Column]:
    return [
        F.when(earlier["has_left"] & later["has_right"],
               _gap(earlier["us"], later["us"], later["right_info"])),
        F.when(earlier["has_right"] & later["has_left"],
               _gap(later["us"], earlier["us"], earlier["right_info"])),
    ]


def closest_pairs(
    events: DataFrame,
    keys: list[str],
    time_us: Column,
    is_left: Column,
    is_right: Column,
    right_info: Column | None = None,
    max_gap_us: int | None = None,
) -> DataFrame:
    """Per group: ``gap_us``, ``left_us``, ``right_us`` and ``right_info`` of the closest pair.

    An event may be on both sides; it then pairs with itself at distance zero. Among pairs of
    equal distance the one with the smallest left time, right time and right facts is kept.
    Groups without a pair (within ``max_gap_us``, if given) are absent.
    """
    sides = [F.max(is_left).alias("has_left"), F.max(is_right).alias("has_right")]
    if right_info is not None:
        sides.append(F.min(F.when(is_right, right_info)).alias("right_info"))
    collapsed = (
        events.where(time_us.isNotNull()).where(is_left | is_right)
        .groupBy(*keys, time_us.alias("us")).agg(*sides)
    )
    if right_info is None:  # without right-side facts the grouping stays a hash aggregation
        collapsed = collapsed.withColumn("right_info", F.lit(None).cast("string"))
    moments = (
        collapsed
        .withColumn("day", F.floor(F.col("us") / DAY_MICROS))
        .withColumn("event", F.struct("us", "has_left", "has_right", "right_info"))
    )
    event = F.col("event")
    alone = F.when(event["has_left"] & event["has_right"],
                   _gap(event["us"], event["us"], event["right_info"]))

    in_day = Window.partitionBy(*keys, "day").orderBy("us")
    before = F.lag("event").over(in_day)
    within = (
        moments.withColumn("before", before)
        .withColumn("best", F.array_min(F.array(alone, *_candidates(F.col("before"), event))))
        .groupBy(*keys, "day")
        .agg(F.min("best").alias("best"),
             F.min_by("event", "us").alias("first"), F.max_by("event", "us").alias("last"))
    )
    by_day = Window.partitionBy(*keys).orderBy("day")
    pairs = (
        within.withColumn("before", F.lag("last").over(by_day))
        .withColumn("best", F.array_min(F.array(F.col("best"), *_candidates(F.col("before"), F.col("first")))))
        .groupBy(*keys).agg(F.min("best").alias("best"))
        .where("best IS NOT NULL")
    )
    if max_gap_us is not None:
        pairs = pairs.where(F.col("best.gap_us") <= max_gap_us)
    return pairs.select(*keys, "best.*")
