"""Sums over pieces against the library on whole texts."""

import random

from tracewarden.llm.queries import WORD_VOCABULARY, vocabulary
from tracewarden.llm.token_counts import PieceCounts, load, token_counts


def test_pieces_equal_whole_texts():
    tokenizer = load(vocabulary(WORD_VOCABULARY))
    rng = random.Random(4)
    letters = [*"abcXYZ019'. ,!\t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u2028", "\u0301", "\u0308", "\u0345", "e", "\u00e9", "\u03a3", "\u0130", "\u1e9e", "\uac00", "\u1100", "\u1161",
               "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "\U0001f600", "\u200d", "\u4e2d", "\u093c", "\u0928"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(4000)] + ["", " ", "\n \u0301a"]
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    counts = PieceCounts(tokenizer, most=500)
    got = [n for at in range(0, len(texts), 64) for n in counts.counts(texts[at:at + 64])]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


def test_rows(spark):
    docs = spark.createDataFrame([(1, "A b"), (1, "A b"), (None, None), (2, ""), (3, "word " * 30_000)], "doc_id long, text string")
    tokenizer = load(vocabulary(WORD_VOCABULARY))
    got = sorted((tuple(r) for r in token_counts(docs, vocabulary(WORD_VOCABULARY)).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 2048)
            for i, t in ((1, "A b"), (1, "A b"), (None, None), (2, ""), (3, "word " * 30_000))]
    assert got == sorted(want, key=str)
    assert token_counts(docs.where("doc_id > 9"), vocabulary(WORD_VOCABULARY)).collect() == []
