"""Chat formatting by token-level assembly.

Role and text of a turn are escaped and encoded on their own; reserved ids outside the
vocabulary are spliced between the segments, so no text can produce one. The loss mask is the
prefix sum of +1 and -1 at the segment bounds of assistant texts.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import map_batches, strings
from tracewarden.llm.merge_rounds import byte_letters
from tracewarden.llm.token_counts import load

CONTROL = ("### ", ": ", " </turn>\n")
CHUNK_TURNS = 64
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*) </turn>\n\Z", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Assembler:
    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.reserved = [size + i for i in range(len(CONTROL))]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes = {i: (t.encode() if t not in byte_of and any(c not in byte_of for c in t)
                          else bytes(byte_of[c] for c in t))
                      for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes |= {i: s.encode() for i, s in zip(self.reserved, CONTROL)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode()

    def assemble(self, role_ids, text_ids, learn: bool):
        """Ids of a turn and its loss mask."""
        head, middle, tail = ([i] for i in self.reserved)
        parts = [head, role_ids, middle, text_ids, tail]
        bounds = np.cumsum([0, *map(len, parts)])
        step = np.zeros(bounds[-1] + 1, np.int64)
        if learn:
            step[bounds[3]] += 1
            step[bounds[4]] -= 1
        return [i for part in parts for i in part], np.cumsum(step)[:-1] > 0


def formatted_turns(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row: conv_id, turn, input_ids, loss_mask, formatted text, and what is read back of it."""

    def make():
        chat = Assembler(tokenizer_path)

        def step(batch):
            roles, texts = strings(batch, "role"), strings(batch, "text")
            role_ids = chat.encode([escape(r).replace(":", "\\:") for r in roles])
            text_ids = chat.encode([escape(t) for t in texts])
            out = {k: [] for k in ("input_ids", "loss_mask", "formatted", "turn_text", "loss_text")}
            for role, a, b in zip(roles, role_ids, text_ids):
                ids, mask = chat.assemble(a, b, role == "assistant")
                formatted = chat.decode(ids)
                read = _TURN.match(formatted)
                out["input_ids"].append(ids)
                out["loss_mask"].append(mask.tolist())
                out["formatted"].append(formatted)
                out["turn_text"].append(f"{unescape(read[1])}\n{unescape(read[2])}\n")
                out["loss_text"].append(unescape(chat.decode([i for i, m in zip(ids, mask) if m])))
            return {"conv_id": batch.column("conv_id"), "turn": batch.column("turn"), **out}

        return step

    return map_batches(
        turns.select("conv_id", "turn", "role", "text"), make,
        "conv_id long, turn long, input_ids array<int>, loss_mask array<boolean>, formatted string, "
        "turn_text string, loss_text string")


def conversation_digests(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per conv_id with the digests of its turns in order.

    Turns of a long conversation are joined in runs of CHUNK_TURNS first, so only one row per
    run meets in the last grouping; the digest itself needs the whole text in order. Rows that
    tie in turn are ordered by their text; null turns come first, null ids form a group.
    """
    rows = formatted_turns(turns, tokenizer_path).select(
        "conv_id", F.floor(F.col("turn") / CHUNK_TURNS).alias("run"),
        F.struct("turn", "turn_text", "loss_text").alias("t"), F.char_length("formatted").alias("n"))

    def joined(items, field):
        return F.array_join(F.transform(items, lambda t: t[field]), "")

    items = F.sort_array(F.collect_list("t"))
    runs = rows.groupBy("conv_id", "run").agg(F.count("*").alias("k"), F.sum("n").alias("n"), items.alias("t")).select(
        "conv_id", "k", "n", F.struct("run", joined(F.col("t"), "turn_text").alias("turn_text"),
                                      joined(F.col("t"), "loss_text").alias("loss_text")).alias("t"))
    whole = runs.groupBy("conv_id").agg(F.sum("k").alias("n_turns"), F.sum("n").alias("formatted_chars"), items.alias("t"))
    loss = joined(F.col("t"), "loss_text")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined(F.col("t"), "turn_text").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
