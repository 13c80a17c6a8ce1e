"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Cost (CPU time per character) and rejection rate of each rule are measured on a bounded hashed
sample; the most rejections per cost run first and later rules see only the texts still kept.
A text is rejected if any rule rejects it, so the order changes the work and never the verdict.
"""

from __future__ import annotations

import time
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import keep_rows, map_batches
from tracewarden.llm.flat_words import LINES, SPACE_WORDS, Spans, byte_set, flat, mix, pieces

SAMPLE_ROWS = 1000
SAMPLE_SEED = 31
WINDOW = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = byte_set(lambda b: b in b"#*$%&|<>")
_CHARACTERS = byte_set(lambda b: not 0x80 <= b < 0xC0)


class Texts:
    """Features of a column of texts, one array each, computed when a rule first asks for it."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)

    @cached_property
    def words(self):
        return Spans(self.data, self.offsets, SPACE_WORDS)

    @cached_property
    def lines(self):
        """Lines, and whether each holds a word."""
        lines = Spans(self.data, self.offsets, LINES)
        at = self.words.starts
        return lines, np.searchsorted(at, lines.ends) > np.searchsorted(at, lines.starts)

    @cached_property
    def n_words(self):
        return self.words.counts

    @cached_property
    def word_chars(self):
        return self.words.per_text(self.words.inside & _CHARACTERS[self.data], self.offsets)

    @cached_property
    def n_symbols(self):
        return self.words.per_text(_SYMBOLS[self.data], self.offsets)

    @cached_property
    def n_lines(self):
        lines, worded = self.lines
        return lines.per_text(worded, lines.first)

    @cached_property
    def n_dup_lines(self):
        lines, worded = self.lines
        key = _salted(lines.hashes, lines.owner)[worded]
        order = np.argsort(key, kind="stable")
        again = order[1:][key[order[1:]] == key[order[:-1]]]
        return np.bincount(lines.owner[worded][again], minlength=len(self.n_words))

    @cached_property
    def n_repeat_words(self):
        grams, whole = self.words.grams(WINDOW)
        places = np.flatnonzero(whole)
        key = _salted(grams[places], self.words.owner[places])
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        edges = np.zeros(len(self.words.starts) + 1, np.int64)
        if len(twice):
            found = places[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]
            edges[found] += 1
            edges[found + WINDOW] -= 1
        return self.words.per_text(np.cumsum(edges)[:-1] > 0, self.words.first)


def _salted(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that tell the texts apart too."""
    return mix(hashes + (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))


def Text(text: str) -> Texts:
    """The features of one text, as arrays of one value."""
    return Texts(pa.array([text], pa.large_string()))


# rule name -> rejects(Texts)
RULES = {
    "too_few_words": lambda t: t.n_words < 20,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 30 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > 3 * np.maximum(t.n_words, 1),
    "repeated_lines": lambda t: 10 * t.n_dup_lines > 3 * np.maximum(t.n_lines, 1),
    "word_length": lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 20 * t.n_words),
}
BASE = ("too_few_words", "repeated_windows")


def rule_order(docs: DataFrame, rules: dict = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by measured rejection per cost on about sample_rows texts, never more.

    The sample is every row whose hashed id falls under the wanted share; no order is needed, as
    the order of the rules changes the work only.
    """
    rows = docs.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit(SAMPLE_SEED)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample_rows / max(rows, 1))))
    sample = pa.array([r["text"] or "" for r in docs.where(share).select(F.substring("text", 1, 20000).alias("text"))
                       .limit(sample_rows).collect()], pa.large_string())
    gain = {}
    for name, rejects in rules.items():
        start = time.process_time()
        rejected = int(rejects(Texts(sample)).sum()) if len(sample) else 0
        gain[name] = (rejected + 0.5) / (time.process_time() - start + 1e-6)
    return sorted(rules, key=lambda name: (-gain[name], name))


def first_rejection(text: Texts, order: list[str], rules: dict = RULES) -> str | None:
    return next((name for name in order if rules[name](text)), None)


def survivors(column: pa.Array, order: list[str], rules: dict = RULES) -> np.ndarray:
    """Which texts no rule rejects; each rule sees only those that all earlier ones kept."""
    alive = np.arange(len(column))
    for name in order:
        if not len(alive):
            break
        alive = alive[~rules[name](Texts(column.take(pa.array(alive))))]
    kept = np.zeros(len(column), bool)
    kept[alive] = True
    return kept


def quality_filter(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with all their columns. Null texts have no words and go."""
    order = rule_order(docs, sample_rows=sample_rows)
    return keep_rows(docs, lambda: lambda batch: np.concatenate(
        [survivors(piece, order) for piece in pieces(batch.column(batch.schema.get_field_index("text")))] or [np.zeros(0, bool)]))


def quality_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every row; null and empty texts have no words and fail the base rules.

    The report needs all counts of every text, so the cascade reads its verdict off them.
    Repeated rows and null ids are kept; an empty table gives an empty result.
    """
    order = rule_order(docs, sample_rows=sample_rows)

    def make():
        def step(batch):
            out = {name: [] for name in (*FEATURES, "base_failed", "kept")}
            for piece in pieces(batch.column("text")):
                texts = Texts(piece)
                for name in FEATURES:
                    out[name].append(getattr(texts, name))
                out["base_failed"].append(np.logical_or.reduce([RULES[name](texts) for name in BASE]))
                kept = np.ones(len(piece), bool)
                for name in order:
                    kept &= ~RULES[name](texts)
                out["kept"].append(kept)
            return {"doc_id": batch.column("doc_id"), **{k: np.concatenate(v) for k, v in out.items()}}

        return step

    return map_batches(
        docs.select("doc_id", "text"), make,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean")
