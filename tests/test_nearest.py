"""Closest pairs against brute force, with one group holding a third of all rows."""

import random
import statistics

from pyspark.sql import functions as F

from tracewarden.operators.nearest import DAY_MICROS, closest_pairs
from tracewarden.operators.pair_median import median_gaps


def brute(rows, limit=None):
    best = {}
    for group, us, left, _, _ in rows:
        if us is None or not left:
            continue
        for other, us2, _, right, tag in rows:
            if other == group and us2 is not None and right:
                pair = (abs(us - us2), us, us2, tag)
                if limit is None or pair[0] <= limit:
                    best[group] = min(best.get(group, pair), pair)
    return best


def found(spark, rows, limit=None):
    df = spark.createDataFrame(rows, "g string, us long, l boolean, r boolean, tag string")
    out = closest_pairs(df, ["g"], F.col("us"), F.col("l"), F.col("r"), F.col("tag"), limit)
    return {r["g"]: (r["gap_us"], r["left_us"], r["right_us"], r["right_info"]) for r in out.collect()}


def test_random_against_brute_force(spark):
    rng = random.Random(5)
    for span in (50, 20 * DAY_MICROS):
        rows = []
        for i in range(600):
            group = "hot" if i % 3 == 0 else f"g{rng.randrange(60)}"
            us = None if rng.random() < 0.05 else rng.randrange(span)
            rows.append((group, us, rng.random() < 0.3, rng.random() < 0.3, f"t{rng.randrange(9)}"))
        assert found(spark, rows) == brute(rows)
        assert found(spark, rows, DAY_MICROS // 20) == brute(rows, DAY_MICROS // 20)


def test_day_edges_and_self_pair(spark):
    d = DAY_MICROS
    rows = [("edge", d - 1, True, False, "a"), ("edge", d, False, True, "b"),
            ("skip", 0, True, False, "a"), ("skip", 5 * d, False, True, "b"),
            ("self", 7, True, True, "s"), ("none", 1, True, False, "n")]
    got = found(spark, rows)
    assert got["edge"] == (1, d - 1, d, "b") and got["skip"][0] == 5 * d
    assert got["self"] == (0, 7, 7, "s") and "none" not in got
    assert set(found(spark, rows, d)) == {"edge", "self"}


def test_limit_is_inclusive(spark):
    rows = [("in", 0, True, False, "x"), ("in", DAY_MICROS, False, True, "x"),
            ("out", 0, True, False, "x"), ("out", DAY_MICROS + 1, False, True, "x"),
            ("before", DAY_MICROS, True, False, "x"), ("before", 0, False, True, "x")]
    assert set(found(spark, rows, DAY_MICROS)) == {"in", "before"}


def test_median_against_brute_force(spark):
    rng = random.Random(11)
    for span, step in ((40 * 1_000_000, 1), (9 * DAY_MICROS, 1_000_000)):
        rows = [("hot" if i % 3 == 0 else f"g{rng.randrange(40)}", rng.randrange(0, span, step), rng.random() < 0.5)
                for i in range(300)]
        want = {}
        for group in {g for g, _, _ in rows}:
            sides = [[us for g, us, left in rows if g == group and left is side] for side in (True, False)]
            gaps = [abs(a - b) for a in sides[0] for b in sides[1]]
            if gaps:
                want[group] = statistics.median(gaps)
        df = spark.createDataFrame(rows, "g string, us long, l boolean")
        out = median_gaps(df, ["g"], F.col("us"), F.col("l"), ~F.col("l"))
        assert {r["g"]: r["median_us"] for r in out.collect()} == want


def test_median_of_a_hot_day(spark):
    """One group with all its events on one day, next to groups that are found in the first rounds."""
    rows = spark.range(6000).select(
        F.lit("hot").alias("g"), (F.col("id") * 14_400_000 + F.pmod(F.col("id") * 7919, F.lit(1000))).alias("us"), (F.col("id") % 4 == 0).alias("l"))
    small = [("one", 5, True), ("one", 5, False), ("two", 0, True), ("two", 7, False), ("two", 9, False)]
    df = rows.unionByName(spark.createDataFrame(small, "g string, us long, l boolean"))
    by = {}
    for r in rows.collect():
        by.setdefault(r["l"], []).append(r["us"])
    import numpy as np
    gaps = np.abs(np.array(by[True])[:, None] - np.array(by[False])[None, :])
    got = {r["g"]: r["median_us"] for r in median_gaps(df, ["g"], F.col("us"), F.col("l"), ~F.col("l")).collect()}
    assert got == {"hot": float(np.median(gaps)), "one": 0.0, "two": 8.0}


def test_medians_of_few_and_of_many_pairs_agree(spark, monkeypatch):
    from itertools import product
    from random import Random
    from statistics import median

    from tracewarden.operators import pair_median

    draw = Random(7)
    rows = [(f"S{s}", draw.randrange(0, 10**9) * 1_000_000 // (1 + s % 2 * 999), draw.random() < 0.4)
            for s in range(12) for _ in range(1 + s * 3)]
    rows += [("EMPTY", None, True), ("EMPTY", 5, False), ("TWICE", 7, True), ("TWICE", 7, True), ("TWICE", 9, False), ("TWICE", 7, False)]
    sides = {}
    for key, us, left in rows:
        if us is not None:
            sides.setdefault(key, ([], []))[0 if left else 1].append(us)
    expected = {k: median(abs(a - b) for a, b in product(*both)) for k, both in sides.items() if all(both)}
    events = spark.createDataFrame(rows, "k string, us bigint, is_left boolean")
    asked = (events, ["k"], F.col("us"), F.col("is_left"), ~F.col("is_left"))
    for few in (0, 40, pair_median.FEW_PAIRS):
        assert {r["k"]: r["median_us"] for r in pair_median.median_gaps(*asked, few_pairs=few).collect()} == expected
    # groups of few pairs do not enter the rounds of the search
    monkeypatch.setattr(pair_median, "_pairs_within", None)
    assert {r["k"]: r["median_us"] for r in pair_median.median_gaps(*asked).collect()} == expected
