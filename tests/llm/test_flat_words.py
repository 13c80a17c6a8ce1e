"""Flat words against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from tracewarden.llm import gated_toxicity, quality_cascade
from tracewarden.llm.flat_words import SPACE_WORDS, Spans, flat, pieces

ODD = ["", None, " ", "\n", "a", "ab", "é 日本 x", "a b a b", "x" * 5000]


def _texts(n=300):
    rnd = random.Random(4)
    return ODD + ["".join(rnd.choice("ab \n\té日#") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_words_and_hashes():
    texts = _texts()
    seen = {}
    for piece in pieces(pa.array(texts), 64):
        words = Spans(*flat(piece), SPACE_WORDS)
        for i, text in enumerate(piece.to_pylist()):
            expected = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            low, high = words.first[i], words.first[i + 1]
            got = [words.data[x:y].tobytes().decode() for x, y in zip(words.starts[low:high], words.ends[low:high])]
            assert got == expected
            for word, h in zip(expected, words.hashes[low:high]):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_repeated_windows_and_lines():
    texts = ["a b c d e f g h " * 3, "q w\nq w\n\n \n \nq w", "one", None]
    features = quality_cascade.Texts(pa.array(texts))
    assert features.n_repeat_words.tolist() == [24, 0, 0, 0]
    assert features.n_dup_lines.tolist() == [0, 2, 0, 0]
    assert quality_cascade.survivors(pa.array([], pa.string()), list(quality_cascade.RULES)).tolist() == []


def test_checksums_of_character_runs():
    words = ["a", "é", "日本", "plain", "z" * 30]
    rows, grams, sizes = gated_toxicity.many_rows(words)
    cut = np.split(grams, np.cumsum(sizes)[:-1])
    assert [(r, g.tolist()) for r, g in zip(rows, cut)] == [gated_toxicity.word_rows(w) for w in words]
