"""Recall of the vector index where different vectors crowd in one cluster."""

import numpy as np
import pytest

from tracewarden.llm import itq_dedup


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def recall(index, x, y):
    """Share of the pairs that meet in a table and pass the radius."""
    (keys_x, code_x), (keys_y, code_y) = index.entries(x), index.entries(y)
    near = np.array([bin(int(v) & (2 ** 64 - 1)).count("1") <= index.radius for v in code_x ^ code_y])
    share = ((keys_x == keys_y).any(axis=1) & near).mean()
    print("recall", share, "bits", index.bits, "tables", index.tables, "radius", index.radius)
    return share


@pytest.mark.parametrize("n", [12_000, 600_000])
def test_recall_in_a_hot_cluster(n):
    rng = np.random.default_rng(3)
    centre = unit(rng.normal(size=(1, 64)))

    def cluster(rows):
        side = rng.normal(size=(rows, 64))
        side = unit(side - (side @ centre.T) * centre)
        return 0.975 * centre + np.sqrt(1 - 0.975 ** 2) * side

    sample = np.vstack([unit(rng.normal(size=(1400, 64))), cluster(700)])
    index = itq_dedup.Index(sample, n, itq_dedup.THRESHOLD, itq_dedup.RECALL)
    fresh = cluster(400)
    a, b = np.nonzero(np.triu(fresh @ fresh.T >= itq_dedup.THRESHOLD, 1))
    assert len(a) > 1000 and recall(index, fresh[a], fresh[b]) >= 0.9
    # partners of the cluster's vectors at the threshold itself
    noise = rng.normal(size=fresh.shape)
    noise = unit(noise - (noise * fresh).sum(axis=1, keepdims=True) * fresh)
    assert recall(index, fresh, 0.9501 * fresh + np.sqrt(1 - 0.9501 ** 2) * noise) >= 0.9


def test_null_and_equal_ids_lead_on(spark):
    def at(degrees, turn=0):
        v = np.zeros(8)
        v[turn], v[turn + 1] = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
        return v.tolist()
    # 1 - null - 2 is a chain (15 degrees a step); 3 and 9 each meet another vector of id 5
    rows = [(1, at(0)), (None, at(15)), (2, at(30)), (3, at(0, 2)), (5, at(10, 2)), (5, at(0, 4)), (9, at(10, 4)), (7, None)]
    # others, so that there is something to learn a rotation from
    rng = np.random.default_rng(31)
    rows += [(100 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8))) if (unit(v[None]) @ unit(np.array(
        [r[1] for r in rows[:7]])).T).max() < 0.9]
    got = itq_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.999).where(
        "vec_id < 100 or vec_id is null").collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component_id, r.n_links) for r in got) == [
        (False, 1, 1, 1), (False, 2, 1, 1), (False, 3, 3, 1), (False, 5, 3, 1), (False, 5, 5, 1), (False, 7, 7, 0),
        (False, 9, 5, 1), (True, 0, 1, 2)]
