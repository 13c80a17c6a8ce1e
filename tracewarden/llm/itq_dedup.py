"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Rotations are learnt on a bounded sample (principal axes, then alternating codes and Procrustes
rotations) with a median offset per bit, so bits are balanced. Their bits are cut into substrings
of about log2(n) bits, one hash table each; vectors that agree in a substring and whose whole
codes are near in Hamming distance are compared by the cosine of the original vectors. The number of tables is
raised until pairs made at exactly the threshold, and the sample's own near pairs, are found at the
wanted rate; where the most tables do not reach it (medians cut through a tight cluster), substrings
are shortened until they do. Equal vectors are one entry with a count, so copies never multiply.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import components, map_batches, saved

THRESHOLD = 0.95
RECALL = 0.97
SAMPLE_ROWS = 4096
MOST_TABLES = 96
# the sample's own pairs count from so many on, and so many of them are looked at
FEW_PAIRS, MOST_PAIRS = 50, 4096


def matrix(values: list, width: int) -> np.ndarray:
    """Vectors as rows of float64, padded with zeros to one width; null or non-finite rows are zero."""
    out = np.zeros((len(values), width))
    for row, v in zip(out, values):
        if v is not None and len(v) and None not in v:
            row[:len(v)] = v
    out[~np.isfinite(out).all(axis=1)] = 0
    # scaled by the largest component first, so that no square overflows or vanishes
    top = np.abs(out).max(axis=1, keepdims=True, initial=0)
    out = np.divide(out, top, out=np.zeros_like(out), where=top > 0)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and bit offsets: minimise the distance between the projected data and its signs."""
    width = sample.shape[1]
    axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=True)[2] if len(sample) > 1 else np.eye(width)
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]
    data = sample @ axes.T
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(data @ rotation >= 0, 1.0, -1.0).T @ data)
        rotation = (u @ v).T
    whole = axes.T @ rotation
    return whole, np.median(sample @ whole, axis=0)


def near_pairs(sample: np.ndarray, threshold: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the sample's pairs at the threshold or above, a random part where they are many."""
    parts = []
    for at in range(0, len(sample), 256):
        x, y = np.nonzero(sample[at:at + 256] @ sample.T >= threshold)
        parts.append(np.stack([x + at, y])[:, x + at < y])
    pairs = np.hstack(parts)
    if pairs.shape[1] > MOST_PAIRS:
        pairs = pairs[:, rng.choice(pairs.shape[1], MOST_PAIRS, replace=False)]
    return pairs[0], pairs[1]


class Index:
    """Rotations, tables and the Hamming radius, all learnt from the sample."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float, recall: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.width = sample.shape[1]
        self.bits = min(30, max(6, math.ceil(math.log2(max(n, 2))) + 2))
        noise = rng.normal(size=sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        partner = threshold * sample + math.sqrt(1 - threshold ** 2) * noise
        x, y = near_pairs(sample, threshold, rng)
        self.rotations, self.tables = [], 0
        while True:
            self.rotations.append(learn_rotation(sample, seed + len(self.rotations)))
            codes = self.codes(sample)
            same = codes == self.codes(partner)
            # the average over all vectors must not hide the crowded ones
            kinds = [same] + ([codes[x] == codes[y], same[np.unique(np.append(x, y))]] if len(x) >= FEW_PAIRS else [])
            self.tables = min(same.shape[1] // self.bits, MOST_TABLES)
            if not self.tables:
                continue
            rate = self._rate(kinds)
            while rate[-1] < recall and self.tables == MOST_TABLES and self.bits > 1:
                self.bits -= 1
                rate = self._rate(kinds)
            if rate[-1] >= recall:
                self.tables = int(np.argmax(rate >= recall)) + 1
                break
            if self.tables == MOST_TABLES:
                raise ValueError(f"recall {rate[-1]:.3f} of near vectors is below {recall}")
        self.recall = float(rate[self.tables - 1])
        self.code_bits = min(64, same.shape[1])
        self.radius = max(int((~k[:, :self.code_bits]).sum(axis=1).max(initial=0)) for k in kinds)

    def _rate(self, kinds: list[np.ndarray]) -> np.ndarray:
        """Share of the pairs found by the first 1, 2, ... tables, of the kind found worst."""
        rates = []
        for same in kinds:
            found = same[:, :self.tables * self.bits].reshape(len(same), self.tables, self.bits).all(axis=2)
            rates.append(np.logical_or.accumulate(found, axis=1).mean(axis=0))
        return np.min(rates, axis=0)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return np.hstack([vectors @ r >= offset for r, offset in self.rotations])

    def entries(self, vectors: np.ndarray):
        """Table keys (one per table) and the short code of each vector."""
        bits = self.codes(vectors)
        parts = bits[:, :self.tables * self.bits].reshape(len(bits), self.tables, self.bits)
        keys = parts @ (1 << np.arange(self.bits)) + (np.arange(self.tables) << self.bits)
        short = np.zeros((len(bits), 64), np.uint8)
        short[:, :self.code_bits] = bits[:, :self.code_bits]
        return keys, np.packbits(short, axis=1).view(">i8")[:, 0]


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                 sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Null, empty, zero and non-finite vectors link with nothing; shorter vectors are compared as
    if padded with zeros. Repeated rows are vectors of their own; a null vec_id keeps a null
    component unless something smaller is linked. An empty table gives an empty result.
    """
    rows = embeddings.select("vec_id", "embedding")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(width, 1)

    def make_node():
        def step(batch):
            values = batch.column("embedding").to_pylist()
            unit = matrix(values, width)
            node = []
            for v, u in zip(values, unit):
                node.append(hashlib.blake2b(np.trim_zeros(np.array(v, float), "b").tobytes(), digest_size=16).digest()
                            if u.any() else None)
            return {"vec_id": batch.column("vec_id"), "node": node, "embedding": values}
        return step

    nodes = map_batches(rows, make_node, "vec_id long, node binary, embedding array<double>")
    ids = saved(nodes.select("vec_id", "node"))
    groups = ids.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = saved(groups)
    vectors = saved(nodes.where("node is not null").join(groups.select("node", "rep"), "node")
                    .where("vec_id <=> rep").select("node", "embedding").dropDuplicates(["node"]))
    n = groups.count()
    sample = vectors.orderBy(F.xxhash64("node")).limit(sample_rows).select("embedding").collect()
    if not sample:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    index = Index(matrix([r[0] for r in sample], width), n, threshold, recall)

    def make_entries():
        def step(batch):
            keys, code = index.entries(matrix(batch.column("embedding").to_pylist(), width))
            return {"node": batch.column("node"), "code": code.astype(np.int64), "keys": keys.tolist()}
        return step

    entries = map_batches(vectors, make_entries, "node binary, code long, keys array<long>").select(
        "node", "code", F.explode("keys").alias("key"))
    left = entries.select("key", F.col("node").alias("a"), F.col("code").alias("code_a"))
    right = entries.select("key", F.col("node").alias("b"), F.col("code").alias("code_b"))
    pairs = (left.join(right, "key").where("a < b")
             .where(F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= index.radius)
             .select("a", "b").distinct())

    def make_rerank():
        def step(batch):
            x, y = (matrix(batch.column(c).to_pylist(), width) for c in ("x", "y"))
            return {"a": batch.column("a"), "b": batch.column("b"), "cosine": (x * y).sum(axis=1)}
        return step

    candidates = (pairs.join(vectors.select(F.col("node").alias("a"), F.col("embedding").alias("x")), "a")
                  .join(vectors.select(F.col("node").alias("b"), F.col("embedding").alias("y")), "b"))
    links = saved(map_batches(candidates.select("a", "b", "x", "y"), make_rerank, "a binary, b binary, cosine double")
                  .where(F.col("cosine") >= threshold).select("a", "b"))
    both = links.union(links.select("b", "a"))
    degrees = (both.join(groups.select(F.col("node").alias("b"), "copies"), "b")
               .groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others")))
    # vectors are the nodes; ids, which may be null or repeat, only name the components
    named = groups.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    summary = (named.join(degrees, "node", "left").join(lowest, "component")
               .select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"))
    return ids.join(summary, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.expr("vec_id <=> component_id"))
