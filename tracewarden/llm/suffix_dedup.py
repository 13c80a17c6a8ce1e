"""Repeated byte strings across all documents, found in suffix arrays of content-dealt shards.

Every window of WINDOW bytes is dealt by the smallest hash among its GRAM-byte strings, so equal
windows meet whatever document they stand in; neighbouring windows with one such anchor form a
piece. A piece whose anchor occurs once, in all documents, holds no repeat. Of the others equal ones collapse to one
with a count, and the different pieces of an anchor go to one shard (an anchor with a single one is settled by
its count). A shard lays its pieces end
to end, sorts their suffixes by induced sorting and reads from the permuted common prefixes which
windows stand there twice. An anchor with too many different pieces for one shard is
dealt anew by whole windows, which are counted. The verdicts return to all occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import discarded, map_batches, written
from tracewarden.llm.flat_words import _BYTES, _powers, flat, mix, pieces
from tracewarden.llm.induced_sort import common_prefixes, suffix_array

WINDOW = 200
GRAM = 24
# windows of a piece, bytes of a shard, different pieces of an anchor that one shard takes
MOST_WINDOWS, SHARD, HOT_PIECES = 1 << 10, 1 << 20, 1 << 12
_STRIDE = 1 << 21
_ODD, _OTHER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_BACK, _OTHER_BACK = pow(_ODD, -1, 1 << 64), pow(_OTHER, -1, 1 << 64)


class _Sums:
    """Polynomial hashes of any stretch of some bytes, off running sums."""

    def __init__(self, data: np.ndarray, base: int = _ODD, back: int = _BACK):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _powers(n, base), out=self.sums[1:])
        self.back = _powers(n + 1, back)

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n])


def _extreme(least, h: np.ndarray, width: int) -> np.ndarray:
    """Minimum (or maximum) of each width values in a row, by doubled spans."""
    n, span = len(h) - width + 1, 1
    while 2 * span <= width:
        h = least(h[:-span], h[span:])
        span *= 2
    return least(h[:n], h[width - span:width - span + n])


def anchored(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
    """Pieces of texts laid end to end: text, start in it, windows, anchor, hash of the bytes, and
    whether two places in the piece may carry the anchor, so that it may repeat a window itself."""
    out = []
    for low in range(0, max(1, len(data) - window + 1), _STRIDE):
        part = data[low:low + _STRIDE + window - 1]
        count = len(part) - window + 1
        if count < 1:
            break
        sums = _Sums(part)
        gram = min(GRAM, window)
        grams, width = sums.all(gram), window - gram + 1
        anchor = _extreme(np.minimum, grams, width)
        none = np.zeros(width - 1, np.uint64)
        carriers = np.flatnonzero(grams == _extreme(np.maximum, np.concatenate([none, anchor, none]), width))
        near = np.flatnonzero((grams[carriers[1:]] == grams[carriers[:-1]]) & (np.diff(carriers) < width))
        first, second = carriers[near], np.append(carriers[near + 1], len(data))
        text = np.searchsorted(offsets, np.arange(low, low + count), "right") - 1 if len(offsets) > 2 else np.zeros(count, np.int64)
        start = np.ones(count, bool)
        start[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        inside = np.arange(low, low + count) + window <= offsets[text + 1]
        heads = np.flatnonzero(start & inside)
        # a piece ends where the next begins or where windows no longer fit into its text
        nexts = np.append(np.flatnonzero(start), count)
        stops = np.minimum(nexts[np.searchsorted(nexts, heads, "right")], offsets[text[heads] + 1] - low - window + 1)
        cuts = -(-(stops - heads) // MOST_WINDOWS)
        turn = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        head = np.repeat(heads, cuts) + turn * MOST_WINDOWS
        windows = np.minimum(np.repeat(stops, cuts) - head, MOST_WINDOWS)
        owner = text[head]
        inner = second[np.searchsorted(first, head)] <= head + windows + width - 2
        out.append((owner, head + low - offsets[owner], windows, anchor[head], sums.of(head, head + windows + window - 1), inner))
    return [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 6)]


def _key():
    return F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key")


def _occurrences(docs: DataFrame, window: int) -> DataFrame:
    def make():
        def step(batch):
            parts = []
            at = 0
            for piece in pieces(batch.column("text")):
                text, start, windows, anchor, seg, inner = anchored(*flat(piece), window)
                parts.append((text.astype(np.int64) + at, start, windows, anchor.astype(np.uint64).view(np.int64),
                              seg.astype(np.uint64).view(np.int64), inner.astype(bool)))
                at += len(piece)
            text, start, windows, anchor, seg, inner = (np.concatenate(c) for c in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 6
            return {"anchor": anchor, "seg": seg, "windows": windows, "start": start, "inner": inner.astype(bool),
                    "key": batch.column("key").take(pa.array(text))}
        return step

    return map_batches(docs.where(F.octet_length("text") >= window).select("text", _key()), make,
                       "anchor long, seg long, windows int, start long, inner boolean, key binary")


def _ends(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def repeated_windows(texts: list[bytes], counts: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each different piece of a shard, which of its windows stand in the shard twice or occur more than once."""
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + 1) - 1
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 2
    joined[ends] = 1
    s = np.append(joined, 0)
    before, common = common_prefixes(s, suffix_array(s))
    rest = np.append(np.repeat(ends, lengths + 1) - np.arange(len(joined)), 0)
    twice = (common >= window) & (rest >= window)
    twice[before[twice]] = True
    out = []
    for low, length, count in zip(ends - lengths, lengths, counts):
        flags = twice[low:low + length - window + 1]
        out.append(np.ones_like(flags) if count > 1 else flags)
    return out


def _shards(batches, window):
    """Pieces of whole anchors, gathered to shards: sorted rows in, (anchor, seg, windows, low, high) out."""
    names = ("anchor", "seg", "windows", "low", "high")
    held, size, last = [], 0, None

    def flush():
        found = [np.zeros(0, np.int64)] * 5
        if held:
            parts = []
            for row, flags in zip(held, repeated_windows([r[4] for r in held], [r[3] for r in held], window)):
                low, high = _ends(flags)
                if len(low):
                    parts.append((np.full(len(low), row[0]), np.full(len(low), row[1]), np.full(len(low), row[2]), low, high))
            if parts:
                found = [np.concatenate(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("anchor", "seg", "windows", "n", "bytes"))):
            if row[:3] == last:
                continue  # the same piece out of another copy of its text
            if size >= SHARD and row[0] != last[0]:
                yield flush()
                held, size = [], 0
            held.append(row)
            size += len(row[4])
            last = row[:3]
    yield flush()


def _bytes_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """anchor, seg, windows, n, bytes of the wanted pieces, out of the texts they are sampled from.

    A task cuts them from the first copy of a text it meets; copies in other tasks repeat the rows.
    """
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "seg", "windows", "n", "start")).alias("parts"))
    rows = docs.where(F.octet_length("text") >= window).select("text", _key()).join(by_text, "key")

    def make():
        seen: set[bytes] = set()

        def step(batch):
            out: dict[str, list] = {n: [] for n in ("anchor", "seg", "windows", "n", "bytes")}
            for key, text, parts in zip(*(batch.column(n).to_pylist() for n in ("key", "text", "parts"))):
                if key in seen:
                    continue
                seen.add(key)
                data = text.encode()
                for p in parts:
                    for n in ("anchor", "seg", "windows", "n"):
                        out[n].append(p[n])
                    out["bytes"].append(data[p["start"]:p["start"] + p["windows"] + window - 1])
            return out
        return step

    return map_batches(rows.select("key", "text", "parts"), make, "anchor long, seg long, windows long, n long, bytes binary")


def _by_windows(parts: DataFrame, window: int) -> DataFrame:
    """The verdicts of pieces with hot anchors: every window by two hashes, counted over all pieces."""
    def make():
        def step(batch):
            columns = {n: [] for n in ("anchor", "seg", "windows", "n", "at", "one", "two")}
            for anchor, seg, windows, n, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "seg", "windows", "n", "bytes"))):
                raw = np.frombuffer(data, np.uint8)
                for c, v in (("anchor", anchor), ("seg", seg), ("windows", windows), ("n", n)):
                    columns[c].append(np.full(windows, v, np.int64))
                columns["at"].append(np.arange(windows))
                columns["one"].append(_Sums(raw).all(window).view(np.int64))
                columns["two"].append(_Sums(raw, _OTHER, _OTHER_BACK).all(window).view(np.int64))
            return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in columns.items()}
        return step

    schema = ", ".join(f"{c} long" for c in ("anchor", "seg", "windows", "n", "at", "one", "two"))
    rows = map_batches(parts.dropDuplicates(["anchor", "seg", "windows"]), make, schema)
    twice = rows.groupBy("one", "two").agg(F.sum("n").alias("times")).where("times > 1")
    return (rows.join(twice, ["one", "two"], "left_semi")
            .select("anchor", "seg", "windows", F.col("at").alias("low"), (F.col("at") + 1).alias("high")))


def covered_spans(docs: DataFrame, window: int = WINDOW, hot_pieces: int = HOT_PIECES) -> tuple[DataFrame, list[str]]:
    """(key, spans) of the texts with repeats, key being the digest of the text; and the tables it rests on."""
    spark = docs.sparkSession
    occurrences, folder = written(_occurrences(docs, window))
    again = occurrences.groupBy("anchor").agg(F.count("*").alias("n"), F.max("inner").alias("inner")).where("n > 1 OR inner").select("anchor")
    met, met_folder = written(occurrences.drop("inner").join(again, "anchor", "left_semi"))
    distinct, distinct_folder = written(met.groupBy("anchor", "seg", "windows").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "start")).alias("at"))
        .select("anchor", "seg", "windows", "n", "at.key", "at.start"))
    discarded(spark, folder)
    # anchors by their number of different pieces: one that occurs again, some, or too many for a shard
    kinds, kinds_folder = written(distinct.groupBy("anchor").agg(F.count("*").alias("different"), F.max("n").alias("most"))
                                  .select("anchor", (F.col("different") > hot_pieces).alias("hot"),
                                          ((F.col("different") == 1) & (F.col("most") > 1)).alias("settled")))
    common = distinct.join(kinds.where("NOT hot AND NOT settled"), "anchor", "left_semi")
    hot = kinds.where("hot")
    settled = distinct.join(kinds.where("settled"), "anchor", "left_semi").select(
        "anchor", "seg", "windows", F.lit(0).cast("long").alias("low"), F.col("windows").cast("long").alias("high"))
    schema = "anchor long, seg long, windows long, low long, high long"
    runs = (_bytes_of(docs, common, window).repartition("anchor").sortWithinPartitions("anchor", "seg", "windows")
            .mapInArrow(lambda batches: _shards(batches, window), schema)).unionByName(settled)
    if not hot.isEmpty():
        runs = runs.unionByName(_by_windows(_bytes_of(docs, distinct.join(hot, "anchor", "left_semi"), window), window))
    spans = (met.join(runs, ["anchor", "seg", "windows"])
             .select("key", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + window - 1).alias("high"))
             .distinct().groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans")))
    spans, spans_folder = written(spans)
    for used in (met_folder, distinct_folder, kinds_folder):
        discarded(spark, used)
    return spans, [spans_folder]


def without_repeats(docs: DataFrame, window: int = WINDOW, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Texts are UTF-8 bytes, null the empty text; texts shorter than the window keep all bytes. Rows that
    repeat a text repeat each other's windows, whatever their ids, so copies of at least one
    window keep nothing; null and equal ids are rows like others. An empty table gives an empty
    result; other columns are not read.
    """
    spans, _ = covered_spans(docs.select("doc_id", "text"), window, hot_pieces)
    rows = docs.select("doc_id", "text", _key()).join(spans, "key", "left")

    def make():
        def step(batch):
            out: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = (text or "").encode()
                removed, count = 0, 0
                kept = data
                if spans:
                    turns = np.zeros(len(data) + 1, np.int64)
                    np.add.at(turns, [s["low"] for s in spans], 1)
                    np.add.at(turns, [s["high"] for s in spans], -1)
                    gone = np.cumsum(turns[:-1]) > 0
                    removed, count = int(gone.sum()), len(_ends(gone)[0])
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                for n, v in zip(out, (len(data), removed, count, hashlib.sha256(kept).hexdigest())):
                    out[n].append(v)
            return {"doc_id": batch.column("doc_id"), **out}
        return step

    return map_batches(rows.select("doc_id", "text", "spans"), make,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
