"""Token counts by overlap resynchronisation.

A huge text is encoded in overlapping chunks with offsets. Two neighbouring chunks are spliced
at a boundary that both of them start a token at and that is proven stable: white space stands
before it, no combining mark after it, and the vocabulary's pre-tokenizer never joins across
white space. Without such a boundary the overlap is doubled, up to the whole chunk.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from tracewarden.llm.common import map_batches, strings

CHUNK, OVERLAP = 1 << 15, 1 << 10
LIMIT = 2048
CACHED_PIECES = 300_000
_GAP = " \t\n\r"


def load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _cut(text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The last stable boundary inside (low, high) that both chunks agree on."""
    for p in np.intersect1d(left[(left > low) & (left < high)], right)[::-1]:
        if text[p - 1] in _GAP and not unicodedata.combining(text[p]):
            return int(p)
    return None


def count_long(starts, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the whole text; starts(piece) gives the start offset of each of its tokens."""
    total, start, end = 0, 0, min(len(text), chunk)
    left = starts(text[:end])
    while end < len(text):
        width = overlap
        while True:
            low = max(start, end - width)
            stop = min(len(text), low + chunk + width)
            right = starts(text[low:stop]) + low
            cut = _cut(text, left, right, low, end)
            if cut is not None or low == start:
                break
            width *= 2
        if cut is None:
            left, end = right, stop
            continue
        total += int((left < cut).sum())
        left, start, end = right[right >= cut], cut, stop
    return total + len(left)


class PieceCounts:
    """Tokens of texts as sums over the pieces between stable boundaries, each piece encoded once."""

    def __init__(self, tokenizer, most: int = CACHED_PIECES):
        self.tokenizer, self.most, self.known = tokenizer, most, {}

    def _encoded(self, texts: list[str]) -> list[int]:
        out = []
        for at in range(0, len(texts), 256):
            out += [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts[at:at + 256], add_special_tokens=False)]
        return out

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self.known) > self.most:
            self.known = {}
        new = list(set().union(*pieces) - self.known.keys()) if pieces else []
        # a piece that begins with a combining mark may belong to what stands before it: no boundary there
        whole = {p: None for p in new if p and unicodedata.combining(p[0])}
        new = [p for p in new if p not in whole]
        self.known |= whole | dict(zip(new, self._encoded(new)))
        out = []
        for text, parts in zip(texts, pieces):
            try:
                out.append(sum(map(self.known.__getitem__, parts)))
            except TypeError:
                out += self._encoded([text])
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Null and empty texts count 0; repeated rows and null ids are kept as they are; an empty
    table gives an empty result; other columns are not read.
    """

    def make():
        tokenizer = load(tokenizer_path)
        pieces = PieceCounts(tokenizer)

        def starts(piece):
            offsets = tokenizer.encode(piece, add_special_tokens=False).offsets
            return np.fromiter((a for a, _ in offsets), np.int64, len(offsets))

        def step(batch):
            texts = strings(batch, "text")
            counts = [0] * len(texts)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            for at in range(0, len(short), 64):
                some = short[at:at + 64]
                for i, n in zip(some, pieces.counts([texts[i] for i in some])):
                    counts[i] = n
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = count_long(starts, t, chunk, overlap)
            return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts],
                    "n_tokens": counts, "over_limit": [n > limit for n in counts]}

        return step

    return map_batches(docs.select("doc_id", "text"), make,
                       "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
