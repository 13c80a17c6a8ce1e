"""Merkle manifest of a dataset with incremental witnesses.

The leaves of a tree are numbered in their order and dealt out as aligned blocks of 16 ** 3. A
block is one stream of appends: a new node attaches a partial witness (the digests before it in
its open run), every later sibling that completes extends the witnesses of the run's earlier
members, and a full run becomes an append to the level above. The roots of the blocks are further
appends, dealt out as blocks again, until one node is left per source; the roots of the sources
are appended the same way. The finished witnesses then go back down: each block gets the witness of its root as
the first row of its stream, so no leaf row ever carries digests of the upper levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import saved
from tracewarden.operators.ranking import number_rows

FAN = 16
LEVELS = 3
BLOCK = FAN ** LEVELS
_UPPER = "array<struct<before:array<string>,after:array<string>>>"


def joined(digests) -> str:
    """H of hex digests."""
    return sha256("".join(digests).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels of runs above n nodes until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Witness:
    """Siblings of one node within its run, and the witness of the run's own node."""

    __slots__ = ("before", "after", "parent", "text")

    def __init__(self, before: list[str]):
        self.before, self.after, self.parent, self.text = before, [], None, None

    def path(self) -> list[tuple[list[str], list[str]]]:
        found, at = [], self
        while at is not None:
            found.append((at.before, at.after))
            at = at.parent
        return found

    def siblings(self, above: str) -> str:
        """The digests from this level on upwards, above being those beyond the block."""
        if self.text is None:
            rest = above if self.parent is None else self.parent.siblings(above)
            self.text = "".join(self.before) + "".join(self.after) + rest
        return self.text


class OpenTree:
    """Appends to a tree of the given depth; its root stands once it is closed."""

    def __init__(self, levels: int):
        self.levels, self.root = levels, None
        self.runs: list[list[str]] = [[] for _ in range(levels)]
        self.waiting: list[list[Witness]] = [[] for _ in range(levels)]

    def append(self, digest: str, level: int = 0) -> Witness | None:
        if level == self.levels:
            self.root = digest
            return None
        run, waiting = self.runs[level], self.waiting[level]
        witness = Witness(run[:])
        for earlier in waiting:
            earlier.after.append(digest)
        run.append(digest)
        waiting.append(witness)
        if len(run) == FAN:
            self._complete(level)
        return witness

    def _complete(self, level: int) -> None:
        run, waiting = self.runs[level], self.waiting[level]
        self.runs[level], self.waiting[level] = [], []
        parent = self.append(joined(run), level + 1)
        for witness in waiting:
            witness.parent = parent

    def close(self) -> None:
        for level in range(self.levels):
            if self.runs[level]:
                self._complete(level)


def folded(digest: str, path) -> str:
    for before, after in path:
        digest = joined([*before, digest, *after])
    return digest


def leaf_digest(text: Column | None = None) -> Column:
    """H over the fields of a document, each with its length."""
    def field(value):
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    rest = [field(F.col(n)) for n in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*rest, field(F.col("text") if text is None else text)), 256)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block of a sorted partition; a block is BLOCK rows and its first row at most."""
    rows, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = row["tree"], row["block"]
            if key != at and rows:
                yield rows
                rows = []
            at = key
            rows.append(row)
    if rows:
        yield rows


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def _in_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("long"))


def _map(df: DataFrame, step, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for rows in _blocks(batches):
            yield _table(step(rows), arrow)

    return df.mapInArrow(run, schema)


def block_roots(nodes: DataFrame) -> DataFrame:
    """(tree, rank, n, digest) of the level above from those of one level: one node per block."""
    def step(rows):
        first = rows[0]
        tree = OpenTree(min(LEVELS, depth(first["n"])))
        for row in rows:
            tree.append(row["digest"])
        tree.close()
        return [{"tree": first["tree"], "rank": first["block"], "n": -(-first["n"] // BLOCK), "digest": tree.root}]

    dealt = _dealt(_in_block(nodes.select("tree", "rank", "n", "digest")))
    return _map(dealt, step, "tree long, rank long, n long, digest string")


def levels_of(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The appended levels from the nodes up to the single roots of their trees."""
    levels = [nodes]
    while True:
        levels.append(saved(block_roots(levels[-1])))
        if largest <= BLOCK:
            return levels
        largest = -(-largest // BLOCK)


def _with_heads(nodes: DataFrame, heads: DataFrame, extra: list[str]) -> DataFrame:
    """The blocks' streams, each led by the row of its head (rank -1): witness and root of its tree."""
    body = _in_block(nodes).select("tree", "block", "rank", "n", "digest", *extra,
                                   F.lit(None).cast(_UPPER).alias("upper"))
    kinds = dict(nodes.dtypes)
    lead = heads.select("tree", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"),
                        F.lit(0).cast("long").alias("n"), F.col("root").alias("digest"),
                        *[F.lit(None).cast(kinds[c]).alias(c) for c in extra], "upper")
    return _dealt(body.unionByName(lead))


def _grown(rows: list[dict]) -> tuple[list[tuple[dict, Witness | None]], list, str]:
    """The nodes of a block with their finished witnesses, the path above the block, the tree's root."""
    head, body = rows[0], rows[1:]
    upper = [(u["before"], u["after"]) for u in head["upper"]]
    tree = OpenTree(min(LEVELS, depth(body[0]["n"])))
    witnesses = [(row, tree.append(row["digest"])) for row in body]
    tree.close()
    return witnesses, upper, head["digest"]


def witness_heads(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """(tree, rank, root, upper) of every node from the heads of their blocks."""
    def step(rows):
        grown, upper, root = _grown(rows)
        return [{"tree": row["tree"], "rank": row["rank"], "root": root,
                 "upper": [{"before": b, "after": a} for b, a in [*(w.path() if w else []), *upper]]}
                for row, w in grown]

    return _map(_with_heads(nodes, heads, []), step, f"tree long, rank long, root string, upper {_UPPER}")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Within a source rows ascend by doc_id (null first) and, where ids repeat, by leaf, so equal rows
    take neighbouring places. A null source is a source of its own, the first. A null doc_id is never
    tampered with. Null fields count as `-`; texts are hashed whole. An empty table gives an
    empty result; other columns are not read.
    """
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                     leaf_digest(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    leaves = docs.select("doc_id", "source", leaf_digest().alias("digest"), changed.alias("changed"))
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("digest")]
    numbered = number_rows(leaves, order, "number")
    sources = saved(numbered.groupBy("source").agg(F.min("number").alias("tree"), F.count("*").alias("n")))
    placed = (numbered.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
              .select("tree", (F.col("number") - F.col("tree")).alias("rank"), "n", "digest", "doc_id", "changed"))
    count, largest = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    trees = levels_of(placed, largest)
    forest = levels_of(
        number_rows(trees[-1].select(F.col("tree").alias("source_tree"), "digest"), [F.asc("source_tree")], "number")
        .select(F.lit(0).cast("long").alias("tree"), (F.col("number") - 1).alias("rank"), F.lit(count).cast("long").alias("n"),
                "digest", "source_tree"), count)
    # back down: from the root to the sources, then from each source to its blocks
    heads = forest[-1].select("tree", "rank", F.col("digest").alias("root"), F.array().cast(_UPPER).alias("upper"))
    for level in reversed(forest[:-1]):
        heads = saved(witness_heads(level, heads))
    top = forest[-1].select(F.col("digest").alias("top"))
    subroots = forest[0].select("rank", F.col("source_tree").alias("of"), F.col("digest").alias("subroot"))
    heads = (heads.join(subroots, "rank").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("rank"),
                                                 F.concat_ws(" ", "subroot", "root").alias("root"), "upper"))
    for level in reversed(trees[1:-1]):
        heads = saved(witness_heads(level, heads))

    def step(rows):
        grown, upper, roots = _grown(rows)
        subroot, root = roots.split(" ")
        above = "".join("".join(b) + "".join(a) for b, a in upper)
        out = []
        for row, witness in grown:
            path = [*(witness.path() if witness else []), *upper]
            siblings = witness.siblings(above) if witness else above
            found = folded(row["changed"] or row["digest"], path)
            out.append({"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": subroot, "root": root,
                        "proof_sha256": sha256(siblings.encode()).hexdigest(), "folded_root": found, "verified": found == root})
        return out

    return _map(_with_heads(placed, heads, ["doc_id", "changed"]), step,
                "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest_sql(levels: int = 6, source_levels: int = 3) -> str:
    """DuckDB SQL of the manifest for up to 16 ** levels rows a source and 16 ** source_levels sources."""
    def field(name):
        return f"coalesce(strlen({name}::varchar)::varchar || ':' || {name}::varchar, '-')"

    fields = " || ".join(field(n) for n in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)), "
           "lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384::bigint * (v & 1)))))")
    parts = [
        f"leaves as (select doc_id, source, sha256({fields} || {field('text')}) as leaf, "
        f"case when doc_id is not null and {crc} % 5 = 0 then sha256({fields} || coalesce(strlen({lower})::varchar || ':' || {lower}, '-')) end as changed from documents)",
        "placed as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank, "
        "dense_rank() over (order by source nulls first) as tree from leaves)",
        "a0 as (select tree, rank, leaf as digest, count(*) over (partition by tree) as n from placed)",
    ]
    def climb(name, top):
        for i in range(top):
            parts.append(f"{name}r{i} as (select tree, rank // 16 as run, list(digest order by rank) as members, (any_value(n) + 15) // 16 as n "
                         f"from {name}{i} where n > 1 group by tree, rank // 16)")
            parts.append(f"{name}{i + 1} as (select tree, run as rank, sha256(list_aggregate(members, 'string_agg', '')) as digest, n from {name}r{i})")

    climb("a", levels)
    ends = " union all ".join(f"select tree, digest from a{i} where n = 1" for i in range(levels + 1))
    parts.append(f"subs as ({ends})")
    parts.append("b0 as (select 0 as tree, row_number() over (order by tree) - 1 as rank, digest, count(*) over () as n from subs)")
    climb("b", source_levels)
    ends = " union all ".join(f"select digest from b{i} where n = 1" for i in range(source_levels + 1))
    parts.append(f"top as ({ends})")
    parts.append("w0 as (select p.doc_id, p.leaf, s.digest as subroot, p.rank, p.tree, 0 as zero, p.tree - 1 as place, '' as proof, "
                 "coalesce(p.changed, p.leaf) as found from placed p join subs s on p.tree = s.tree)")
    step = 0
    for name, tree, rank, top in (("a", "tree", "rank", levels), ("b", "zero", "place", source_levels)):
        for i in range(top):
            at = f"((w.{rank} // {16 ** i}) % 16)"
            before, after = f"list_aggregate(r.members[1:{at}], 'string_agg', '')", f"list_aggregate(r.members[{at} + 2:], 'string_agg', '')"
            around = lambda mid: f"coalesce({before}, '') || {mid} || coalesce({after}, '')"
            parts.append(f"w{step + 1} as (select w.doc_id, w.leaf, w.subroot, w.rank, w.tree, w.zero, w.place, "
                         f"case when r.run is null then w.proof else w.proof || {around(chr(39) * 2)} end as proof, "
                         f"case when r.run is null then w.found else sha256({around('w.found')}) end as found "
                         f"from w{step} w left join {name}r{i} r on r.tree = w.{tree} and r.run = w.{rank} // {16 ** (i + 1)})")
            step += 1
    return "with " + ",\n".join(parts) + (
        f"\nselect doc_id, leaf, subroot, top.digest as root, sha256(proof) as proof_sha256, found as folded_root, "
        f"found = top.digest as verified from w{step} cross join top")
