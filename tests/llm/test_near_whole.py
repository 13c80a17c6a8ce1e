"""Near-duplicates against brute force where groups are large, similarities low or ids odd."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tracewarden.llm import chosen_path
from tracewarden.llm.common import Scratch

DOCS = "doc_id long, text string"


def sets_of(texts):
    out = []
    for t in texts:
        w = t.split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    return out


def brute(texts, percent):
    """Smallest index reachable by links of at least the similarity."""
    names = {g: k for k, g in enumerate({g for s in sets_of(texts) for g in s})}
    x = np.zeros((len(texts), len(names)), np.float32)
    for row, s in zip(x, sets_of(texts)):
        row[[names[g] for g in s]] = 1
    common = (x @ x.T).astype(int)
    size = common.diagonal()
    link = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    best = np.arange(len(texts))
    while True:
        new = np.where(link, best[None, :], len(texts)).min(axis=1)
        if (new == best).all():
            return best.tolist()
        best = new


def changed(rng, words, low, high):
    """A copy with some words in a row replaced: k replaced words cost k + 4 shingles."""
    copy, k = list(words), int(rng.integers(low, high))
    at = int(rng.integers(5, len(words) - k - 5))
    copy[at:at + k] = [f"new{x}" for x in rng.integers(0, 10 ** 9, k)]
    return copy


def test_pipeline_stage_links_from_80_percent(spark):
    rng = np.random.default_rng(8)
    texts = []
    for group in range(40):
        base = [f"g{group}w{x}" for x in rng.integers(0, 10 ** 9, 104)]
        # similarity (100 - c) / (100 + c) of c changed shingles: 0.80 to 0.85 for 9 to 11, less from 12 on
        texts += [" ".join(base), " ".join(changed(rng, base, 5, 10))]
    want = {i for i, c in enumerate(brute(texts, 80)) if i == c}
    assert len(want) < len({i for i, c in enumerate(brute(texts, 85)) if i == c})
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    assert {r.doc_id for r in corpus_pipeline.dedup_stage(spark, df, "").collect()} == want


def test_refused_attachments_keep_their_links(spark):
    """Hundreds of texts just below the similarity to the first one, each linked by one that is above it."""
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in range(404)]
    texts = [" ".join(base)]
    for k in range(400):
        # y changes a few words at the end, x those and a run in front: x is at 0.848 to the base, 0.852 to y
        y, x = list(base), list(base)
        y[-1] = x[-1] = f"end{k}"
        run = 28
        at = int(rng.integers(5, 360))
        x[at:at + run] = [f"new{k}x{i}" for i in range(run)]
        texts += [" ".join(y), " ".join(x)]
    got = chosen_path.near_documents(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    want = brute(texts, 85)
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_large_group_of_similarities_between_80_and_90(spark):
    rng = np.random.default_rng(10)
    base = [f"w{x}" for x in range(204)]
    texts = [" ".join(base)] + [" ".join(changed(rng, base, 1, 24)) for _ in range(400)]
    got = chosen_path.near_documents(spark.createDataFrame(list(enumerate(texts)), DOCS), 80).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(brute(texts, 80)))


def test_null_and_equal_ids_keep_their_texts(spark):
    a, b, c, d = ("".join(f"{x}{i} " for i in range(120)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b + "more"), (3, c), (3, d), (3, d), (-5, c + "more"), (None, ""), (7, "")]
    df = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.text) for r in chosen_path.distinct_documents(df).collect()}
    either = got & {(None, b), (None, b + "more")}
    assert len(either) == 1
    assert got - either == {(None, a), (-5, c + "more"), (3, d), (None, ""), (7, "")}
    assert chosen_path.distinct_documents(df).count() == 6
    near = {(r.doc_id, r.component_id, r.kept) for r in chosen_path.near_documents(df).collect()}
    assert (3, -5, False) in near and (3, 3, True) in near and (-5, -5, True) in near and (7, 7, True) in near


def test_clashing_columns_and_equal_rows(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a, "x", "b"), (1, a, "y", "a"), (2, a + " more", "z", "c"), (3, None, None, None)]
    df = spark.createDataFrame(rows, DOCS + ", row_key string, node string")
    runs = [chosen_path.distinct_documents(df.repartition(n)) for n in (1, 4)]
    assert runs[0].columns == df.columns
    first, second = (sorted(map(tuple, r.collect()), key=str) for r in runs)
    assert first == second and len(first) == 2 and (3, None, None, None) in first


def test_differences_from_the_hub_are_exact(spark):
    """Every link between members of different components, against all pairs of sets."""
    rng = np.random.default_rng(12)
    base = [f"w{x}" for x in range(204)]
    texts = [" ".join(base)] + [" ".join(changed(rng, base, 1, 24)) for _ in range(150)]
    # pairs that share a change which is too large for the hub
    for _ in range(40):
        far = changed(rng, base, 26, 40)
        texts += [" ".join(far), " ".join(far[:-1] + ["end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    reps = docs.select(F.col("doc_id").alias("id"), chosen_path._row_key().alias("row_key"))
    members = docs.select(F.lit(0).cast("long").alias("hub"), F.col("doc_id").alias("id"), F.col("doc_id").alias("comp"))
    with Scratch(spark) as scratch:
        got = {(r.a, r.b) for r in chosen_path._through_hub(members, docs, reps, 85, scratch).collect()}
    sets = sets_of(texts)
    want = {(i, j) for j in range(len(sets)) for i in range(j)
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert got <= want
    linked = {i for p in got if 0 in p for i in p}
    # what is not found links two texts that are both linked with the hub
    assert all(i in linked and j in linked for i, j in want - got)
    assert {p for p in want if not (p[0] in linked and p[1] in linked)} <= got


def test_estimates_are_taken_where_members_meet_their_hub(spark):
    """Pairs that are not similar enough leave no rows of the join, those that are leave one each."""
    sigs = {1: [1] * 64, 2: [1] * 60 + [2] * 4, 3: [3] * 64, 4: [1] * 40 + [4] * 24}
    schema = "node long, id long, comp long, members long, sig array<smallint>"
    large = spark.createDataFrame([(7, i, i, 9, s) for i, s in sigs.items()], schema)
    hubs = chosen_path._hubs(large, None, 0)
    assert {"hub", "hub_sig"} <= set(hubs.columns)
    hub = spark.createDataFrame([(7, 0, 1, 1, sigs[1])], "node long, place int, hub long, hub_comp long, hub_sig array<smallint>")
    got = chosen_path._near_hubs(large, hub, "id != hub and comp != hub_comp", 0.6)
    assert {tuple(r) for r in got.collect()} == {(1, 2, 60 / 64), (1, 4, 40 / 64)}


def test_search_broadcasts_nothing(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    left, right = spark.range(50).withColumn("x", F.lit(1)), spark.range(20).withColumn("y", F.lit(2))
    with Scratch(spark) as scratch:
        a, b = scratch.table(left), scratch.table(right)
        joined = a.join(b, "id")
        assert joined.count() == 20
        assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(name) == before
