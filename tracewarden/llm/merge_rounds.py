"""BPE encoding in batched numpy merge rounds, and decoding.

The symbols of many words lie in one flat array. A round looks up every neighbouring pair by
binary search over the sorted pair keys, takes each word's lowest rank and merges all places of
that pair; words without a pair left leave the array. Distinct words are merged once per cache.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame

from tracewarden.llm.common import map_batches, strings

# The white space class and the word pattern of the vocabulary file
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_NONE = np.iinfo(np.int64).max
CACHE_WORDS = 200_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class MergeRounds:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        end = spec["model"]["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], made
        self.split = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.cache: dict[str, tuple[int, str, str]] = {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list = [None] * len(words)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            key = (symbols[:-1] << 20) | symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbols), _NONE)
            rank[:-1] = np.where((self.keys[place] == key) & (owner[1:] == owner[:-1]), self.order[place], _NONE)
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            for at in np.flatnonzero(best == _NONE):
                done[owner[starts[at]]] = symbols[starts[at]:starts[at] + sizes[at]]
            best = np.repeat(best, sizes)
            chosen = np.flatnonzero((rank == best) & (best != _NONE))
            if len(chosen):
                # in a run of overlapping places every second one merges, from the left
                first = np.r_[True, np.diff(chosen) != 1]
                run = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
                chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
            symbols[chosen] = self.made[rank[chosen]]
            keep = best != _NONE
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return done

    def pieces(self, text: str) -> list[str]:
        """The words of a text in order; a special string stands for itself behind a space."""
        out, at = [], 0
        for found in [*self.split.finditer(text), None]:
            part = text[at:found.start() if found else len(text)]
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += _WORDS.findall(part)
            if found:
                out.append(" " + found.group())
                at = found.end()
        return out

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.cache and w[0] != " "]
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            for w, ids in zip(some, self.merge([w.encode() for w in some])):
                self._keep(w, ids.tolist())
        for s, i in self.special.items():
            self._keep(" " + s, [i])

    def _keep(self, word, ids):
        self.cache[word] = len(ids), " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids)

    def encode_batch(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, ids joined by a space and decoded text of each text."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        out = []
        for words in split:
            found = [self.cache[w] for w in words]
            out.append((sum(f[0] for f in found), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])))
        return out


def bpe_round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Null and empty texts have no ids and decode to the empty text; repeated rows and null ids
    are kept; an empty table gives an empty result. The vocabulary file names no decoder, so
    decoding joins the tokens by one space.
    """

    def make():
        bpe = MergeRounds(tokenizer_path)

        def step(batch):
            texts = strings(batch, "text")
            coded = []
            for at in range(0, len(texts), 64):
                coded += bpe.encode_batch(texts[at:at + 64])
            digest = [[hashlib.sha256(c[k].encode()).hexdigest() for c in coded] for k in (1, 2)]
            return {"doc_id": batch.column("doc_id"), "n_tokens": [c[0] for c in coded],
                    "ids_sha256": digest[0], "decoded_sha256": digest[1]}

        return step

    return map_batches(docs.select("doc_id", "text"), make,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
