"""Corpus operators against brute force, exact round trips and odd input."""

import collections
import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracewarden.llm import (block_tree, chat_format, chosen_path, common, diagonal_votes, gated_toxicity, itq_dedup,
                             merge_rounds, pareto_mix, quality_cascade, queries, token_counts)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `row` string"
ODD = [None, "", " \n ", "a", "word " * 9000, "x" * 40000, "Ünï 'll don't <|endoftext|> ΣΑΣ é 12 !!\0<|startoftext|>", "Ünï"]


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", 0, "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    return token_counts.load(queries.vocabulary(queries.WORD_VOCABULARY))


def test_token_counts(spark, tokenizer):
    texts = ODD + ["one two " * 300 + "y" * 900 + " end of it" * 200]
    path = queries.vocabulary(queries.WORD_VOCABULARY)
    for chunk, overlap in ((1 << 15, 1 << 10), (200, 20)):
        out = token_counts.token_counts(docs(spark, texts), path, chunk=chunk, overlap=overlap).collect()
        assert {r.doc_id: r.n_tokens for r in out} == {
            i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_bpe_round_trip(spark, tokenizer):
    out = merge_rounds.bpe_round_trip(docs(spark, ODD + ["aaaa aaaaaaa ababab"]), queries.vocabulary(queries.WORD_VOCABULARY)).collect()
    for r in out:
        text = (ODD + ["aaaa aaaaaaa ababab"])[r.doc_id] or ""
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_quality_order_does_not_change_the_verdict(spark):
    texts = ["one two three " * 20, "### " * 40, " ".join(f"w{i}" for i in range(60)), "same line\n" * 30]
    for order in itertools.permutations(quality_cascade.RULES):
        found = [quality_cascade.first_rejection(quality_cascade.Text(t), order) is None for t in texts]
        assert found == [False, False, True, False]
    kept = quality_cascade.quality_filter(docs(spark, texts + ODD))
    assert kept.columns == docs(spark, texts).columns and [r.doc_id for r in kept.collect()] == [2]


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 24))
    rows = [*base, *(base[:30] + rng.normal(size=(30, 24)) * 0.2), *[base[0]] * 5]
    values = [[float(v) for v in r] for r in rows] + [None, [], [0.0] * 24, [math.nan] * 24, [None] * 24]
    got = itq_dedup.near_vectors(spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<float>")).collect()
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= itq_dedup.THRESHOLD).sum(axis=1) - 1
    assert sum(r.n_links for r in got) >= 0.9 * links.sum() > 0
    assert all(r.n_links <= links[r.vec_id] for r in got if r.vec_id < len(links))
    assert all(r.n_links == 0 and r.kept for r in got if r.vec_id >= len(links))


def _brute_components(texts):
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_near_documents(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(500)]
    base = [list(rng.choice(words, 120)) for _ in range(12)]
    texts = [" ".join(b) for b in base] + list(ODD) + ["short one", "SHORT one"]
    for k in range(90):
        copy = list(base[k % 3])
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            copy[at] = "changed"
        texts.append(" ".join(copy))
    got = chosen_path.near_documents(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _brute_components(texts)
    kept = chosen_path.distinct_documents(docs(spark, texts))
    assert kept.columns == docs(spark, texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, j) for j in range(101, 120)] + [(5, 5)]
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{j: 100 for j in range(100, 120)}}


def test_extraction(spark):
    page = ('<html><head><title>T</title></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy it</div><article><h1>A &amp; B</h1>'
            '<p>First  <b>bo</b>ld text<br>line<p>Second</article><div id="comments"><p>I say so</p></div><footer>&copy; us</footer></body>')
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<article><p>cut off <a hre"), (5, "u", "<div>" * 3000 + "a < b")]
    got = {r.page_id: r.text for r in block_tree.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "A & B\nFirst bold text line\nSecond"
    assert got[2] == got[3] == "" and got[4] == "cut off"


def test_mix(spark):
    rng = np.random.default_rng(4)
    texts = ["w " * int(n) for n in rng.integers(0, 60, 600)] + [None, ""]
    sources = [("a", "b", "c", None)[i % 4] for i in range(len(texts))]
    got = pareto_mix.pareto_mix(docs(spark, texts, sources)).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    sizes = collections.Counter()
    for r in got:
        assert r.taken <= 3 * r["size"] and r["size"] == len(WORD.findall(texts[r.doc_id] or ""))
        sizes[r.source] += r["size"]
    weight, target, open_ = {"a": 5, "b": 2, "c": 1, None: 5}, {}, {"a", "b", "c", None}
    while open_:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in over} if over else share
        open_ = open_ - over if over else set()
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(target[s]) and abs(sum(r.taken for r in mine) - target[s]) <= 60
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, pareto_mix.pareto_mix(docs(spark, texts, sources)).select(
        "row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()), key=str)


def test_toxicity_gradients():
    net = gated_toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(3, 5, 2 * gated_toxicity.PART)), np.array([[1] * 5, [1, 1, 0, 0, 0], [1, 1, 1, 0, 0]], bool)
    y, one = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        s = net.gradients(x, mask, y, one)[2]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).sum()

    grads, d_x, _ = net.gradients(x, mask, y, one)
    for name in ("uf", "ub", "wf", "wb", "wa", "va", "wo", "bf"):
        at = tuple(rng.integers(0, n) for n in net.p[name].shape)
        old, eps = net.p[name][at], 1e-3
        net.p[name][at] = old + eps
        high = loss()
        net.p[name][at] = old - eps
        low = loss()
        net.p[name][at] = old
        assert (high - low) / (2 * eps) == pytest.approx(grads[name][at], rel=2e-2, abs=2e-3)


def test_toxicity_learns_a_word(spark):
    rng = np.random.default_rng(5)
    common_words = [f"word{i}" for i in range(60)]
    texts, marks = [], []
    for i in range(400):
        words = list(rng.choice(common_words, 60))
        if i % 4 == 0:
            for at in rng.integers(0, 60, 3):
                words[at] = "scoundrel"
        texts.append(" ".join(words))
        marks.append((i, 1, int(i % 4 == 0)))
    out = gated_toxicity.toxicity(docs(spark, texts + ODD), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in out)


def test_licenses(spark):
    texts = ODD + ["x y Licensed under the Apache License, Version 2.0. z", "All rights\nreserved, all rights reserved", "GNU General Public License",
                   "licensed under the new rules"]
    got = {r.doc_id: r for r in diagonal_votes.scan_licenses(docs(spark, texts)).collect()}
    n = len(ODD)
    assert len(got) == len(texts) and got[n].labels == "apache-2.0" and got[n].n_base == 0
    assert (got[n + 1].n_base, got[n + 1].first_word, got[n + 1].last_word, got[n + 1].base_labels) == (2, 0, 3, "reserved")
    assert got[n + 2].base_labels == "gpl" and got[n + 3].labels == "" and got[0].labels == "" and got[0].first_word is None


def test_chat_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "### User: \\\\", "", None, "</turn>\n### x: y </turn>\n", "<|endoftext|> é 😀"]
    rows = [(c, t, ("user", "assistant", "a: \\b")[(t + c) % 3], texts[t % len(texts)]) for c in range(2) for t in range(150)]
    got = chat_format.conversation_digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"),
                                           queries.vocabulary(queries.BYTE_VOCABULARY)).collect()
    for r in got:
        mine = [x for x in rows if x[0] == r.conv_id]
        whole = "".join(f"{x[2]}\n{x[3] or ''}\n" for x in mine)
        loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert (r.n_turns, r.loss_chars) == (150, len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    path = queries.vocabulary(queries.WORD_VOCABULARY)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (token_counts.token_counts(empty, path), quality_cascade.quality_report(empty), chosen_path.near_documents(empty),
                pareto_mix.pareto_mix(empty), gated_toxicity.toxicity(empty, labels), diagonal_votes.scan_licenses(empty),
                itq_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert out.count() == 0


def test_null_and_repeated_rows(spark):
    rows = [(None, "one two three four five six", None, None, None, None), (3, "one two three four five six", "en", None, 1, "r")] * 2
    df = spark.createDataFrame(rows, DOCS)
    assert chosen_path.near_documents(df).count() == 4 and pareto_mix.pareto_mix(df).count() == 4
    assert quality_cascade.quality_report(df).count() == 4 and diagonal_votes.scan_licenses(df).count() == 4


def test_pipeline(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality_rules", "toxicity", "minhash_near_dedup", "source_mix", "bpe_round_trip"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.where(F.col("n_tokens") > 0).count() > 50
