"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its hashed word vector beside the mean of its hashed character trigrams. Two
recurrences read a window of words, attention pools their states, and a text's score is the
highest of all its overlapping windows. Training repeats two steps: find the highest window of
each labelled text, then fit the network on those windows.
"""

from __future__ import annotations

import re
import zlib
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import keep_rows, map_batches, strings

WINDOW, STRIDE = 32, 24
WORD_ROWS, GRAM_ROWS, PART, HIDDEN = 4096, 2048, 12, 8
# the bounds of the training sample: labelled texts, and evenly spread windows of each
TRAIN_ROWS, TRAIN_WINDOWS = 3000, 16
EPOCHS, STEPS, BATCH, RATE, DECAY, DROPPED = 6, 160, 128, 0.02, 0.3, 0.2
# rows of the word and character tables that fewer training texts use (a share of 1/300 at least) stay zero
LEAST_TEXTS = 4
THRESHOLD = 0.7
CACHE_WORDS = 200_000
_WORDS = re.compile(r"[^\W_]+")


def _sigmoid(x):
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def word_rows(word: str) -> tuple[int, list[int]]:
    """Rows of the word table and of the character table."""
    marked = f"^{word}$"
    return (zlib.crc32(word.encode()) % WORD_ROWS,
            [zlib.crc32(marked[i:i + 3].encode()) % GRAM_ROWS for i in range(max(1, len(marked) - 2))])


def _crc_table() -> np.ndarray:
    """The byte table of the common 32-bit checksum, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def many_rows(words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """word_rows of many words: word rows, all rows of the character table, and how many each word has."""
    data = np.frombuffer("".join(f"^{w}$" for w in words).encode(), np.uint8)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    sizes = np.array([len(w) for w in words])
    heads = np.repeat(np.cumsum(sizes + 2) - sizes - 2, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begin, end = at[heads], np.append(at, len(data))[heads + 3]
    crc = np.full(len(heads), 0xFFFFFFFF, np.uint32)
    for i in range(int((end - begin).max(initial=0))):
        new = _CRC[(crc ^ data[np.minimum(begin + i, len(data) - 1)]) & np.uint32(255)] ^ (crc >> np.uint32(8))
        crc = np.where(begin + i < end, new, crc)
    return [zlib.crc32(w.encode()) % WORD_ROWS for w in words], ~crc % np.uint32(GRAM_ROWS), sizes


def words_of(text: str) -> list[str]:
    """Lower-case words; a run of one word counts once, as its length says nothing."""
    return [w for w, _ in groupby(_WORDS.findall(text.lower()))]


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        x = 2 * PART
        self.p = {"word": rng.normal(0, .3, (WORD_ROWS, PART)), "gram": rng.normal(0, .3, (GRAM_ROWS, PART)),
                  "wa": rng.normal(0, .4, (2 * HIDDEN, HIDDEN)), "va": rng.normal(0, .4, HIDDEN),
                  "wo": rng.normal(0, .4, 2 * HIDDEN), "bo": np.array(-1.0)}
        for d in "fb":
            self.p |= {f"w{d}": rng.normal(0, .3, (x, 3 * HIDDEN)), f"u{d}": rng.normal(0, .3, (HIDDEN, 3 * HIDDEN)),
                       f"b{d}": np.zeros(3 * HIDDEN)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, words: list[tuple[int, list[int]]]) -> np.ndarray:
        """One input row per word."""
        if not words:
            return np.zeros((0, 2 * PART), np.float32)
        return self.joined([w for w, _ in words], np.concatenate([g for _, g in words]), np.array([len(g) for _, g in words]))

    def joined(self, words: list[int], grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Word vectors beside the means of their character vectors."""
        sums = np.add.reduceat(self.p["gram"][grams], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
        return np.hstack([self.p["word"][words], sums / sizes[:, None]]).astype(np.float32)

    def _run(self, gate, mask, d, keep):
        """Hidden states (time, batch, hidden) of one direction from the projected inputs gate(t)."""
        n = HIDDEN
        u_zr, u_c = (np.ascontiguousarray(m) for m in np.split(self.p[f"u{d}"], [2 * n], axis=1))
        steps, batch = mask.shape[1], len(mask)
        full = mask.all(axis=0)
        h = np.zeros((batch, n), np.float32)
        states, tape = np.zeros((steps, batch, n), np.float32), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            g = gate(t)
            zr = _sigmoid(g[:, :2 * n] + h @ u_zr)
            z, r = zr[:, :n], zr[:, n:]
            c = np.tanh(g[:, 2 * n:] + (r * h) @ u_c)
            m = mask[:, t:t + 1]
            change = z * (c - h)
            new = h + (change if full[t] else m * change)
            if keep:
                tape.append((t, h, z, r, c, m))
            h = states[t] = new
        return states, tape

    def forward(self, gate_f, gate_b, mask, keep=False):
        """Score of each window; mask marks its real words (a window without words scores the bias)."""
        mask = mask.astype(np.float32)
        hf, tape_f = self._run(gate_f, mask, "f", keep)
        hb, tape_b = self._run(gate_b, mask, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        a = np.tanh(h @ self.p["wa"])
        e = (a @ self.p["va"]).T + (mask - 1) * 30
        w = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        w /= np.maximum(w.sum(axis=1, keepdims=True), 1e-9)
        pooled = (w.T[:, :, None] * h).sum(axis=0)
        score = _sigmoid(pooled @ self.p["wo"] + self.p["bo"])
        return score, (h, a, w, pooled, tape_f, tape_b)

    def gradients(self, x, mask, y, weight):
        """Loss gradients of the dense weights and of the input rows x (batch, time, input)."""
        n, p = HIDDEN, self.p
        gates = {d: x @ p[f"w{d}"] + p[f"b{d}"] for d in "fb"}
        score, (h, a, w, pooled, tape_f, tape_b) = self.forward(lambda t: gates["f"][:, t], lambda t: gates["b"][:, t], mask, keep=True)
        g = {}
        d_logit = (score - y) * weight
        g["wo"], g["bo"] = pooled.T @ d_logit, d_logit.sum()
        d_pool = d_logit[:, None] * p["wo"]
        d_h = w.T[:, :, None] * d_pool[None]
        d_w = np.einsum("tbh,bh->bt", h, d_pool)
        d_e = w * (d_w - (w * d_w).sum(axis=1, keepdims=True))
        g["va"] = np.einsum("bt,tbk->k", d_e, a)
        d_a = d_e.T[:, :, None] * p["va"] * (1 - a * a)
        g["wa"] = np.einsum("tbh,tbk->hk", h, d_a)
        d_h = d_h + d_a @ p["wa"].T
        d_x = np.zeros_like(x)
        for d, tape, part in (("f", tape_f, d_h[:, :, :n]), ("b", tape_b, d_h[:, :, n:])):
            u, carry, gu = p[f"u{d}"], np.zeros((len(x), n), np.float32), np.zeros_like(p[f"u{d}"])
            d_gates = np.zeros_like(gates[d])
            for t, before, z, r, c, m in reversed(tape):
                dh = carry + part[t]
                live = dh * m
                d_c = live * z * (1 - c * c)
                d_rh = d_c @ u[:, 2 * n:].T
                d_z = live * (c - before) * z * (1 - z)
                d_r = d_rh * before * r * (1 - r)
                d_zr = np.hstack([d_z, d_r])
                carry = dh - live * z + d_rh * r + d_zr @ u[:, :2 * n].T
                gu[:, :2 * n] += before.T @ d_zr
                gu[:, 2 * n:] += (r * before).T @ d_c
                d_gates[:, t] = np.hstack([d_zr, d_c])
            flat = d_gates.reshape(-1, 3 * n)
            g[f"u{d}"], g[f"b{d}"] = gu, flat.sum(axis=0)
            g[f"w{d}"] = x.reshape(-1, x.shape[2]).T @ flat
            d_x += d_gates @ p[f"w{d}"].T
        return g, d_x, score


def windows_of(n: int) -> list[int]:
    """Starts of the overlapping windows that cover n words."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Scorer:
    """Scores whole texts; the projections of each distinct word are computed once and cached."""

    def __init__(self, network: Network, rows_of: dict | None = None):
        self.network, self.rows_of = network, rows_of or {}
        self.reset()

    def reset(self):
        self.number, self.fw, self.bw = {}, np.zeros((1, 3 * HIDDEN), np.float32), np.zeros((1, 3 * HIDDEN), np.float32)

    def _learn(self, words):
        new = [w for w in words if w not in self.number]
        if new:
            for i, w in enumerate(new):
                self.number[w] = len(self.fw) + i
            p = self.network.p
            known = all(w in self.rows_of for w in new)
            x = self.network.inputs([self.rows_of[w] for w in new]) if known else self.network.joined(*many_rows(new))
            self.fw = np.vstack([self.fw, x @ p["wf"] + p["bf"]])
            self.bw = np.vstack([self.bw, x @ p["wb"] + p["bb"]])

    def window_scores(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.reset()
        self._learn(dict.fromkeys(w for t in texts for w in t))
        starts, owner, flat = [], [], []
        for k, t in enumerate(texts):
            at = windows_of(len(t))
            starts += [len(flat) + s for s in at]
            owner += [k] * len(at)
            flat += [self.number[w] for w in t]
            if len(t) < WINDOW:
                flat += [0] * (WINDOW - len(t))
        ids, starts = np.array(flat, np.int32), np.array(starts, np.int64)
        scores = np.concatenate([self._score(ids[starts[i:i + 1024, None] + np.arange(WINDOW)])
                                 for i in range(0, len(starts), 1024)] or [np.zeros(0)])
        cut = np.searchsorted(owner, np.arange(1, len(texts)))
        return np.split(scores, cut)

    def _score(self, ids):
        by_time = np.ascontiguousarray(ids.T)
        return self.network.forward(lambda t: self.fw[by_time[t]], lambda t: self.bw[by_time[t]], ids > 0)[0]

    def scores(self, texts: list[str]) -> list[float]:
        out = []
        for at in range(0, len(texts), 64):
            words = [words_of(t) for t in texts[at:at + 64]]
            out += [float(s.max()) for s in self.window_scores(words)]
        return out


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 3) -> Network:
    network, rng = Network(seed), np.random.default_rng(seed)
    words, gathered = [], []
    for t in texts:
        found = words_of(t)
        starts = windows_of(len(found))
        if len(starts) > TRAIN_WINDOWS:
            starts = [starts[i] for i in np.linspace(0, len(starts) - 1, TRAIN_WINDOWS).astype(int)]
        gathered.append([found[s:s + WINDOW] for s in starts])
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        network.p["bo"] = np.float32(4.0 if len(y) and y[0] else -4.0)
        return network
    rate_pos = min(2.0, (len(y) - y.sum()) / y.sum())
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    rows_of = {w: word_rows(w) for w in {w for ws in gathered for win in ws for w in win}}
    # a row of few texts could only be learnt by heart
    used = {"word": np.zeros(WORD_ROWS), "gram": np.zeros(GRAM_ROWS)}
    for ws in gathered:
        mine = {w for win in ws for w in win}
        used["word"][list({rows_of[w][0] for w in mine})] += 1
        used["gram"][list({q for w in mine for q in rows_of[w][1]})] += 1
    live = {k: (v >= max(LEAST_TEXTS, len(y) / 300)).astype(np.float32)[:, None] for k, v in used.items()}
    for k, v in live.items():
        network.p[k] = network.p[k] * v
    step, batch = 0, min(BATCH, max(16, len(y) // 16))
    # a small sample is passed over more often, to the same number of steps
    epochs = max(epochs, -(-STEPS * batch // len(y)))
    for epoch in range(epochs):
        scorer = Scorer(network, rows_of)
        scorer._learn(rows_of)
        flat = [win for ws in gathered for win in ws]
        scores = np.concatenate([np.concatenate(scorer.window_scores(flat[i:i + 2048])) for i in range(0, len(flat), 2048)])
        words, at = [], 0
        for ws in gathered:
            words.append(ws[int(np.argmax(scores[at:at + len(ws)]))])
            at += len(ws)
        order = rng.permutation(len(words))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            distinct = {w: i for i, w in enumerate(dict.fromkeys(w for k in some for w in words[k]))}
            rows = [rows_of[w] for w in distinct]
            table = np.vstack([network.inputs(rows), np.zeros((1, 2 * PART), np.float32)])
            ids = np.full((len(some), WINDOW), len(distinct))
            for i, k in enumerate(some):
                ids[i, :len(words[k])] = [distinct[w] for w in words[k]]
            lost = (rng.random(ids.shape) < DROPPED) & (ids < len(distinct))
            lost[:, 0] = False
            ids[lost] = len(distinct)
            mask = ids < len(distinct)
            g, d_x, _ = network.gradients(table[ids], mask, y[some], np.where(y[some] > 0, rate_pos, 1.0).astype(np.float32) / len(some))
            d_table = np.zeros_like(table)
            np.add.at(d_table, ids[mask], d_x[mask])
            g["word"], g["gram"] = np.zeros_like(network.p["word"]), np.zeros_like(network.p["gram"])
            np.add.at(g["word"], [w for w, _ in rows], d_table[:-1, :PART])
            sizes = np.array([len(q) for _, q in rows])
            if len(rows):
                np.add.at(g["gram"], np.concatenate([q for _, q in rows]), np.repeat(d_table[:-1, PART:] / sizes[:, None], sizes, axis=0))
            step += 1
            for k in live:
                g[k] *= live[k]
            for k, v in g.items():
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                network.p[k] = (network.p[k] * (1 - RATE * DECAY) - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
                moments[k] = m, s
    return network


def held_out(doc_id):
    """Rows whose labels are never used for training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """Train on at most ``rows`` labelled texts, chosen by hash; the long tail of a text is sampled by windows."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic").orderBy("doc_id", "text").limit(rows).collect()
    return train([r["text"] for r in found], [r["toxic"] for r in found])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts have one empty window and get its score; a null doc_id is not held out.
    Repeated rows get equal scores; without labels of both kinds every score is constant; an empty
    table gives an empty result; other columns are not read.
    """
    network = fit(docs, labels)

    def make():
        scorer = Scorer(network)
        def step(batch):
            scores = scorer.scores(strings(batch, "text"))
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores,
                    "predicted": [int(s >= threshold) for s in scores]}
        return step

    return map_batches(docs.select("doc_id", "text", held_out("doc_id").alias("held_out")), make,
                       "doc_id long, held_out boolean, score double, predicted int")


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    network = fit(docs, labels)

    def make():
        scorer = Scorer(network)
        return lambda batch: [s < threshold for s in scorer.scores(strings(batch, "text"))]

    return keep_rows(docs, make)
