"""License scans by diagonal voting.

All rolling word k-gram hashes of the texts are joined to the template positions. A hit votes
for the diagonal (place in text - place in template); neighbouring diagonals with hits merge
into one span, and a span is verified on the words themselves.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import ASCII_LOWER, map_batches
from tracewarden.llm.flat_words import LOWER, Spans, byte_set, flat, pieces

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_BYTES = byte_set(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
K = 3
NEIGHBOUR = 8
ACCEPT = 0.8
# Phrases and labels of the base
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Opening words of public licences
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2.0",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-name": "released under the mit license",
    "gpl-name": "licensed under the gnu general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "cc-by-sa": "licensed under a creative commons attribution sharealike license",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license",
}


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.translate(ASCII_LOWER))


def spans_of(column: pa.Array) -> Spans:
    """The lower-cased words of a column of texts."""
    data, offsets = flat(column)
    return Spans(LOWER[data], offsets, WORD_BYTES)


def gram_hashes(words: list[str], k: int = K) -> np.ndarray:
    """One 64-bit hash per run of k words of a template."""
    return spans_of(pa.array([" ".join(words)], pa.large_string())).grams(k)[0].view(np.int64)


def text_grams(column: pa.Array, k: int = K) -> list[np.ndarray]:
    """The hashes of all runs of k words of each text."""
    out = []
    for piece in pieces(column):
        words = spans_of(piece)
        grams = words.grams(k)[0].view(np.int64)
        out += [grams[low:max(low, high - k + 1)] for low, high in zip(words.first[:-1], words.first[1:])]
    return out


def base_places(words: Spans) -> list[tuple[str, np.ndarray]]:
    """Label and start words (counted through all texts) of the places of each phrase."""
    found = []
    for phrase, label in PHRASES.items():
        n = phrase.count(" ") + 1
        grams, whole = words.grams(n)
        found.append((label, np.flatnonzero((grams == gram_hashes(phrase.split(), n)[0].view(np.uint64)) & whole)))
    return found


def base_columns(words: Spans) -> dict[str, list]:
    """n_words, n_base, first_word, last_word and base labels of each text."""
    rows = len(words.counts)
    labels, places = [set() for _ in range(rows)], []
    for label, at in base_places(words):
        for i in np.unique(words.owner[at]):
            labels[i].add(label)
        places.append(at)
    at = np.sort(np.concatenate(places))
    owner = words.owner[at]
    low, high = np.searchsorted(owner, np.arange(rows)), np.searchsorted(owner, np.arange(rows), "right")
    starts = at - words.first[owner]
    return {"n_words": words.counts.tolist(), "n_base": (high - low).tolist(),
            "first_word": [int(starts[x]) if y > x else None for x, y in zip(low, high)],
            "last_word": [int(starts[y - 1]) if y > x else None for x, y in zip(low, high)], "base": labels}


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, k: int = K, accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every row.

    Null and empty texts have no words, no labels (empty strings) and score 0. Rows that repeat
    an id with other texts are scanned one by one (rows are told apart by a hash of the text).
    An empty table gives an empty result; other columns are not read.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    named = [(name, words_of(t)) for name, t in templates.items()]
    spark = docs.sparkSession
    # a row per template word: as small as the templates themselves
    positions = spark.createDataFrame(
        [(int(h), name, i) for name, words in named for i, h in enumerate(gram_hashes(words, k))],
        "gram long, template string, place long")

    def make_grams():
        def step(batch):
            return {"doc_id": batch.column("doc_id"), "row_hash": batch.column("row_hash"), "grams": text_grams(batch.column("text"), k)}
        return step

    grams = map_batches(texts, make_grams, "doc_id long, row_hash long, grams array<long>").select(
        "doc_id", "row_hash", F.posexplode("grams").alias("at", "gram"))
    hits = grams.join(F.broadcast(positions), "gram").groupBy(
        "doc_id", "row_hash", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count_distinct("place").alias("votes"))
    line = Window.partitionBy("doc_id", "row_hash", "template").orderBy("diagonal")
    merged = (hits.withColumn("fresh", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(line), F.lit(-10 ** 9)) > NEIGHBOUR).cast("int"))
              .withColumn("span", F.sum("fresh").over(line))
              .groupBy("doc_id", "row_hash", "template", "span")
              .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes")))
    spans = merged.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("template", "low", "high", "votes")).alias("found"))
    whole = {name: [w.encode() for w in words] for name, words in named}

    def verified(words: Spans, i: int, found: list):
        """Labels, best share and spans of one text, from its merged diagonals."""
        first, n = int(words.first[i]), int(words.counts[i])
        labels, score, spans = set(), 0.0, []
        for hit in found:
            template = whole[hit["template"]]
            begin, end = max(0, hit["low"]), min(n, hit["high"] + len(template))
            own = [words.data[x:y].tobytes() for x, y in zip(words.starts[first + begin:first + end], words.ends[first + begin:first + end])]
            share = sum(b.size for b in SequenceMatcher(None, own, template, autojunk=False).get_matching_blocks()) / len(template)
            if share >= accept:
                labels.add(hit["template"])
                score = max(score, share)
                spans.append({"label": hit["template"], "begin": begin, "end": end, "share": share})
        return labels, score, spans

    def make_labels():
        def step(batch):
            out = {key: [] for key in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            hits = iter(batch.column("found").to_pylist())
            for piece in pieces(batch.column("text")):
                words = spans_of(piece)
                columns = base_columns(words)
                for i, base in enumerate(columns.pop("base")):
                    labels, score, spans = verified(words, i, next(hits) or [])
                    out["base_labels"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(base | labels)))
                    out["score"].append(max(float(bool(base)), score))
                    out["spans"].append(spans)
                for key, values in columns.items():
                    out[key] += values
            return {"doc_id": batch.column("doc_id"), **out}
        return step

    joined = texts.join(spans, (texts.doc_id.eqNullSafe(spans.doc_id)) & (texts.row_hash == spans.row_hash), "left").select(
        texts.doc_id, "text", "found")
    return map_batches(
        joined, make_labels,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, begin: long, end: long, share: double>>")
