"""Suffix arrays against sorting, and repeated bytes against a dictionary of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewarden.llm import suffix_dedup
from tracewarden.llm.induced_sort import common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, key string, spans int, anchor string"


def check_array(values):
    s = np.array([*values, 0])
    sa, text = suffix_array(s), s.tolist()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    before, common = common_prefixes(s, sa)
    for x, y in zip(sa[1:].tolist(), sa[:-1].tolist()):
        k = 0
        while max(x, y) + k < len(text) and text[x + k] == text[y + k]:
            k += 1
        assert (before[x], common[x]) == (y, k)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.integers(1, 3))
def test_small_alphabets(values, times):
    check_array(values * times)


@pytest.mark.parametrize("alphabet", [2, 40, 700, 100_000])
def test_alphabets(alphabet):
    rng = np.random.default_rng(alphabet)
    base = rng.integers(1, alphabet + 1, 900)
    check_array([*base, *base[100:700], *[1] * 50, *base[:300]])


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(d[i:i + window] for d in texts for i in range(len(d) - window + 1))
    out = []
    for (doc_id, _), d in zip(rows, texts):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - window + 1):
            if count[d[i:i + window]] > 1:
                gone[i:i + window] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, window, **more):
    docs = spark.createDataFrame([(i, t, "k", 1, "a") for i, t in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in suffix_dedup.without_repeats(docs, window, **more).collect()), key=str)


def made_rows():
    rng = np.random.default_rng(5)

    def prose(n):
        return "".join(chr(c) for c in rng.choice([97, 98, 99, 32, 233, 0x4E2D], n))

    passage, line = prose(120), "-" * 300
    rows = [(i, prose(60) + passage[i % 40:] + prose(30)) for i in range(40)]
    rows += [(100, passage), (100, passage), (None, passage), (101, line), (102, line[:90]), (103, prose(40) + line[:64] + prose(40)), (104, "ab" * 200)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # a hot group of copies
    rows += [(300, None), (301, ""), (302, "short"), (None, None), (303, prose(3) * 40), (304, "\0" + passage[:70] + "\0")]
    return rows


@pytest.mark.parametrize("window,more", [(64, {}), (64, {"hot_pieces": 2}), (20, {})])
def test_against_all_windows(spark, window, more):
    rows = made_rows()
    assert found(spark, rows, window, **more) == brute(rows, window)


def test_long_text_and_clean_rows(spark):
    rng = np.random.default_rng(9)
    long = "".join(map(chr, rng.integers(97, 123, 2_300_000)))
    rows = [(1, long), (2, long[1_000_000:1_000_500] + "|"), (3, "".join(map(chr, rng.integers(97, 123, 5000))))]
    got = {r[0]: r for r in found(spark, rows, 200)}
    assert [got[i][2:4] for i in (1, 2, 3)] == [(500, 1), (500, 1), (0, 0)]
    assert got[2][4] == hashlib.sha256(b"|").hexdigest()
    assert got[1][4] == hashlib.sha256((long[:1_000_000] + long[1_000_500:]).encode()).hexdigest()


def test_empty_table(spark):
    assert found(spark, [], 200) == []


def test_pieces_cover_each_window_once():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 5, 300, 31, 32, 4000, 0)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, start, windows, *_ = suffix_dedup.anchored(np.frombuffer(b"".join(texts), np.uint8), offsets, 32)
    seen = Counter((t, s + i) for t, s, n in zip(text.tolist(), start.tolist(), windows.tolist()) for i in range(n))
    assert seen == Counter((t, i) for t, d in enumerate(texts) for i in range(len(d) - 31))
