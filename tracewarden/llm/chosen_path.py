"""MinHash near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets become one representative. Independent trees branch the
representatives: a node picks two minwise coordinates and sends each member to the children
named by its tokens there, so similar pairs keep meeting (2 * 0.8 > 1 children each) and others
die out. Tokens of the first level are whole 64-bit hashes, so unrelated documents do not meet by
chance there, however many there are. Groups are found first, by comparing the members of each
first node with one of them. Then small nodes are compared exhaustively, but for members already in
one component. All members of a large node are compared with two of them, its hubs: the one most
often found similar so far, and one by chance; then it branches on, from the third level at one
coordinate. Candidates are confirmed on full sets twice, once the groups are found and after the
last level; nodes whose members are all in one component are left. Nodes that are large and mixed
on the last level are joined by what their members have that the hub has not.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import Scratch, components, map_batches, saved
from tracewarden.llm.flat_words import LOWER, SPACE_WORDS, Spans, flat, mix, pieces
from tracewarden.operators.ranking import number_rows

SHINGLE = 5
PERCENT = 85
COORDINATES = 64
TREES = 3
SMALL = 8
# nodes fork at two coordinates down to this depth, at one from there on, so rows grow no further
FORKS = 2
DEPTH = 5
# estimates from 64 coordinates stray by 0.045 (one sigma) at 0.85, by 0.05 at 0.80
SLACK = 0.17
# the coordinates of the first level, two for each tree
_ROOTS = np.arange(2 * TREES)
_SEEDS = np.random.default_rng(11).integers(1, 2 ** 63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each whole text of an Arrow column."""
    out = []
    for piece in pieces(column):
        data, offsets = flat(piece)
        words = Spans(LOWER[data], offsets, SPACE_WORDS)
        grams, _ = words.grams(SHINGLE)
        for low, high in zip(words.first[:-1], words.first[1:]):
            if high - low >= SHINGLE:
                out.append(np.unique(grams[low:high - SHINGLE + 1]))
            elif high > low:
                h = np.full(1, high - low, np.uint64)
                for i in range(low, high):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words.hashes[i])
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def minwise(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first-level tokens and 16 bits of the smallest hash per coordinate (the shingles are mixed hashes, so an
    odd factor orders them anew), in slices so that a huge set stays small."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, (_SEEDS[:, None] * shingles[None, at:at + 2048]).min(axis=1))
    roots = mix(low[_ROOTS] ^ np.arange(len(_ROOTS), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return roots.view(np.int64), (low >> np.uint64(16)).astype(np.uint16).view(np.int16)


def _row_key():
    """Never null: the id and the text of a row; rows that repeat both are one row."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(" "),
                    F.coalesce(F.md5("text"), F.lit("null")))


def _fingerprints(docs: DataFrame) -> DataFrame:
    def make():
        def step(batch):
            sets = shingle_sets(batch.column("text"))
            tokens = [minwise(s) if len(s) else (None, None) for s in sets]
            return {"doc_id": batch.column("doc_id"), "row_key": batch.column("row_key"), "n_shingles": [len(s) for s in sets],
                    "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "roots": [r for r, _ in tokens], "sig": [s for _, s in tokens]}
        return step

    return map_batches(docs.select("doc_id", "text", _row_key().alias("row_key")), make,
                       "doc_id long, row_key string, n_shingles long, node binary, roots array<long>, sig array<smallint>")


def _alike(x: str, y: str):
    """Share of coordinates with the same token."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v) / COORDINATES


def _children(rows: DataFrame, depth: int) -> DataFrame:
    """The children of (node, id, comp, sig), as such: one per token at the coordinates that the node picks."""
    pick = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(COORDINATES)).cast("int")
    other = F.pmod(pick + 1 + F.pmod(F.xxhash64("node", F.lit(-1 - depth)), F.lit(COORDINATES - 1)).cast("int"), F.lit(COORDINATES))
    picks = F.array(pick, other) if depth < FORKS else F.array(pick)
    return rows.select(F.explode(picks).alias("c"), "node", "id", "comp", "sig").select(
        F.xxhash64("node", "c", F.get("sig", F.col("c"))).alias("node"), "id", "comp", "sig")


def _hubs(large: DataFrame, degrees: DataFrame | None, depth: int) -> DataFrame:
    """(node, hub, hub_comp, hub_sig) of each large node: the member most often found similar so far, and one by chance."""
    ranked = (large.withColumn("degree", F.lit(0).cast("long")) if degrees is None
              else large.join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0).cast("long"))))
    best = F.min(F.struct(-F.col("degree"), F.xxhash64("id", F.lit(depth)), "id", "comp", "sig"))
    chance = F.min(F.struct(F.xxhash64("id", F.lit(-1 - depth)), "id", "comp", "sig"))
    both = ranked.groupBy("node").agg(best.alias("p"), chance.alias("q"))
    parts = [F.struct(f"{h}.id", f"{h}.comp", f"{h}.sig") for h in ("p", "q")]
    return both.select("node", F.posexplode(F.array(*parts)).alias("place", "h")).select(
        "node", "place", F.col("h.id").alias("hub"), F.col("h.comp").alias("hub_comp"), F.col("h.sig").alias("hub_sig"))


def _near_hubs(members: DataFrame, hubs: DataFrame, apart: str, least: float) -> DataFrame:
    """The pairs (a, b, alike) of a member and a hub of its node whose estimate is high enough. It is taken where the two
    meet, so pairs that are not similar leave no rows."""
    alike = _alike("sig", "hub_sig")
    return members.join(hubs, "node").where(apart).where(alike >= least).select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), alike.alias("alike"))


def _with_component(rows: DataFrame, part: DataFrame | None, name: str = "id", comp: str = "comp") -> DataFrame:
    if part is None:
        return rows.withColumn(comp, F.col(name))
    own = part.select(F.col("node").alias(name), F.col("component").alias("_component"))
    return rows.join(own, name, "left").withColumn(comp, F.coalesce("_component", name)).drop("_component")


def _still_apart(pairs: DataFrame, part: DataFrame | None) -> DataFrame:
    return (_with_component(_with_component(pairs, part, "a", "comp_a"), part, "b", "comp_b")
            .where("comp_a != comp_b").select(*pairs.columns))


def _joined(part: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components once the links are added to those known."""
    return components(links if part is None else links.union(part.select("component", "node")))


def _settled(todo: DataFrame, part: DataFrame | None, docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Components after the candidates (a, b, alike) are confirmed: the likeliest partner of each
    document first, then those pairs that are still apart."""
    with Scratch(todo.sparkSession) as scratch:
        ends = todo.union(todo.select("b", "a", "alike"))
        best = ends.groupBy("a").agg(F.max_by("b", "alike").alias("b"))
        first = scratch.table(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        part = _joined(part, _confirm(first, docs, reps, percent, scratch))
        rest = scratch.table(_still_apart(todo.select("a", "b"), part).join(first, ["a", "b"], "left_anti"))
        return part if rest.isEmpty() else _joined(part, _confirm(rest, docs, reps, percent, scratch))


def _texts(ids: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, shingles) of the full sets of the representatives asked for."""
    wanted = reps.select("id", "row_key").join(ids, "id", "left_semi")

    def make():
        def step(batch):
            return {"id": batch.column("id"),
                    "shingles": [s.view(np.int64) for s in shingle_sets(batch.column("text"))]}
        return step

    # rows may repeat an id and its text
    texts = docs.select(_row_key().alias("row_key"), "text").join(wanted, "row_key").dropDuplicates(["row_key"]).select("id", "text")
    return scratch.table(map_batches(texts, make, "id long, shingles array<long>"))


def _confirm(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    sets = _texts(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), docs, reps, scratch)
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
            .where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b").distinct())


def _through_hub(members: DataFrame, docs: DataFrame, reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) among the members (hub, id, comp) of each hub, exact for members of different components.

    With D(x) the shingles in which x differs from the hub, two members differ in
    |D(x)| + |D(y)| - 2 |D(x) and D(y)| shingles. If their D share nothing and they are similar, both
    are similar to the hub. So members similar to the hub are linked with it, and any other link needs
    common shingles in D, at least half of slack(x) + slack(y), slack(x) = |D(x)| - k |x|,
    k = (100 - percent) / (100 + percent). Those are joined by the rarest shingles of D, as many as
    that number calls for.
    """
    k = (100 - percent) / (100 + percent)
    sets = _texts(members.select("id").union(members.select("hub")).distinct(), docs, reps, scratch)
    other = sets.select(F.col("id").alias("hub"), F.col("shingles").alias("centre"))
    differ = F.concat(F.array_except("shingles", "centre"), F.array_except("centre", "shingles"))
    deltas = scratch.table(members.join(sets, "id").join(other, "hub").select(
        "hub", "id", "comp", F.size("shingles").cast("long").alias("size"), F.size("centre").cast("long").alias("whole"),
        differ.alias("delta")).withColumn("d", F.size("delta").cast("long")))
    near = (100 * (F.col("size") + F.col("whole") - F.col("d")) >= percent * (F.col("size") + F.col("whole") + F.col("d")))
    marked = deltas.withColumn("near", near).withColumn("slack", F.col("d") - k * F.col("size"))
    links = marked.where("near and id != hub").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))
    # the least slack of a partner, on either side
    least = marked.groupBy("hub").agg(F.min(F.when(F.col("near"), F.col("slack"))).alias("near_slack"),
                                      F.min(F.when(~F.col("near"), F.col("slack"))).alias("far_slack"))
    tokens = scratch.table(marked.select("hub", "id", "comp", "near", "d", "slack", F.explode("delta").alias("token")))
    often = tokens.groupBy("hub", "token").agg(F.count("*").alias("often"), F.min("comp").alias("low"), F.max("comp").alias("high"),
                                               F.bool_and("near").alias("all_near")).where("low < high and not all_near")
    member = Window.partitionBy("hub", "id")
    # what only one side has comes first in the order, so places count from those on
    placed = scratch.table(
        tokens.join(often.drop("low", "high", "all_near"), ["hub", "token"])
        .withColumn("place", F.row_number().over(member.orderBy("often", "token")) + F.col("d") - F.count("*").over(member))
        .join(least, "hub"))

    def upto(slack):
        # one less than needed, so that rounding loses nothing
        return F.col("d") - F.greatest(F.lit(1), F.ceil((F.col("slack") + F.col(slack)) / 2 - 1e-6)) + 1

    def side(rows, name):
        return rows.select("hub", "token", F.col("id").alias(name), F.col("comp").alias(f"comp_{name}"),
                           F.col("slack").alias(f"slack_{name}"), (F.col("d") - F.col("place")).alias(f"left_{name}"))

    far, close = placed.where("not near"), placed.where("near")
    reach = F.least("left_x", "left_y") + 1 >= (F.col("slack_x") + F.col("slack_y")) / 2 - 1e-6

    def meet(xs, ys):
        return (xs.join(ys, ["hub", "token"]).where("comp_x != comp_y").where(reach)
                .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))

    among = far.where(F.col("place") <= upto("far_slack"))
    asked = meet(side(far.where(F.col("place") <= upto("near_slack")), "x"),
                 side(close.where(F.col("place") <= upto("far_slack")), "y")).union(
        meet(side(among, "x"), side(among, "y")).where("a < b")).distinct()
    return links.union(_confirm(scratch.table(asked), docs, reps, percent, scratch)).distinct()


def _tree_components(reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all representatives (id, row_key, roots, sig) that have links."""
    with Scratch(docs.sparkSession) as scratch:
        return _branched(reps, docs, percent, scratch)


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (node, id, comp, ...) with their number of members, of nodes of more than one component: the others have nothing left to find."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("members"), F.min("comp").alias("low"),
                                     F.max("comp").alias("high")).where("low < high")
    return rows.join(sizes.select("node", "members"), "node")


def _branched(reps: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    least = percent / 100 - SLACK
    roots = _mixed(reps.select(F.explode("roots").alias("node"), "id", F.col("id").alias("comp")))
    roots = scratch.table(roots.join(reps.select("id", "sig"), "id"))
    # groups first: each member with one of its node
    centre = roots.groupBy("node").agg(F.min(F.struct(F.xxhash64("id"), "id", "sig")).alias("h"))
    centre = centre.select("node", F.col("h.id").alias("hub"), F.col("h.sig").alias("hub_sig"))
    found = scratch.table(_near_hubs(roots, centre, "id != hub", least).distinct())
    part = _settled(found, None, docs, reps, percent)
    todo = None
    for depth in range(DEPTH + 1):
        rows = _with_component((large if depth else roots).select("node", "id", "sig"), part)
        live = scratch.table(_mixed(_children(rows, depth) if depth else rows))
        small, large = live.where(F.col("members") <= SMALL), live.where(F.col("members") > SMALL)
        others = small.select("node", *[F.col(n).alias(f"hub_{n}" if n != "id" else "hub") for n in ("id", "comp", "sig")])
        asked = _near_hubs(small, others, "id < hub and comp != hub_comp", least)
        close = found.where(F.col("alike") >= percent / 100)
        degrees = close.select(F.col("a").alias("id")).union(close.select("b")).groupBy("id").agg(F.count("*").alias("degree"))
        more = not large.isEmpty()
        if more:
            hubs = scratch.table(_hubs(large, degrees, depth))
            asked = asked.union(_near_hubs(large, hubs, "id != hub and comp != hub_comp", least))
        new = scratch.table(asked.distinct().join(found.select("a", "b"), ["a", "b"], "left_anti"))
        found = found.union(new)
        todo = new if todo is None else todo.union(new)
        if not more:
            break
    part = _settled(todo, part, docs, reps, percent)
    if more:
        around = _surroundings(large, hubs.where("place = 0"), found, degrees, part, scratch)
        if not around.isEmpty():
            part = _joined(part, _through_hub(around, docs, reps, percent, scratch))
    return part


def _surroundings(large: DataFrame, hubs: DataFrame, found: DataFrame, degrees: DataFrame, part: DataFrame,
                  scratch: Scratch) -> DataFrame:
    """(hub, id, comp): what meets a hub in a node, was estimated near a document of its component on any level or is in that
    component. Of hubs in one component the one most often found similar stands for all; hubs with one component around them
    are left."""
    own = _with_component(hubs.select(F.col("hub").alias("id")).distinct(), part).join(degrees, "id", "left")
    lead = own.groupBy("comp").agg(F.min(F.struct(-F.coalesce("degree", F.lit(0).cast("long")), "id")).alias("lead"))
    lead = lead.select("comp", F.col("lead.id").alias("lead"))
    own = scratch.table(own.join(lead, "comp").select(F.col("id").alias("hub"), "comp", "lead"))
    met = large.select("node", "id").join(hubs.select("node", "hub"), "node").join(own, "hub").select(F.col("lead").alias("hub"), "id")
    pairs = _still_apart(found.select("a", "b"), part)
    ends = _with_component(pairs.union(pairs.select("b", "a")), part, "a")
    near = ends.join(own.select("comp", "lead").distinct(), "comp").select(F.col("lead").alias("hub"), F.col("b").alias("id"))
    around = _with_component(met.union(near).distinct(), part)
    mixed = around.groupBy("hub").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("hub")
    mixed = scratch.table(mixed)
    # those linked with the hub in other ways belong to it too
    leads = _with_component(mixed.select(F.col("hub").alias("id")), part).withColumnRenamed("id", "hub")
    linked = part.select(F.col("node").alias("id"), F.col("component").alias("comp")).join(leads, "comp").select("hub", "id", "comp")
    return scratch.table(around.join(mixed, "hub").union(linked).distinct())


def _row_components(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, kept of every row."""
    prints = saved(_fingerprints(docs))
    groups = prints.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("low"))
    # numbers follow the ids, null ids last: the smallest number of a component belongs to its smallest id
    groups = saved(number_rows(groups, [F.col("low.unnamed"), F.col("low.doc_id"), F.col("node")], "id").select(
        "id", "node", F.col("low.doc_id").alias("first_id"), F.col("low.row_key").alias("first_key")))
    reps = saved(prints.select("node", "row_key", "roots", "sig").join(groups.select("id", "node", F.col("first_key").alias("row_key")),
                                                              ["node", "row_key"]).select("id", "row_key", "roots", "sig").dropDuplicates(["id"]))
    part = _tree_components(reps, docs, percent)
    named = _with_component(groups, part).join(groups.select(F.col("id").alias("comp"), F.col("first_id").alias("component_id")), "comp")
    summary = named.select("node", "first_key", "component_id", (F.col("comp") == F.col("id")).alias("leads"))
    return (prints.drop("roots", "sig").join(summary, "node", "left").select(
        "doc_id", "row_key", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("leads") & (F.col("row_key") == F.col("first_key")), F.lit(True)).alias("kept")))


def near_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Null, empty and wordless texts have no shingles and link with nothing. Rows are told apart by id
    and text: of two texts under one id, or under null ids, each is searched. component_id is the
    smallest id of the component, null only where all its ids are; kept is true for one (id, text)
    of each. An empty table gives an empty result; other columns are not read.
    """
    return _row_components(docs, percent).drop("row_key")


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group with all its columns, whatever their names; of rows that repeat id
    and text the same one stays in every run. Null, empty and wordless texts stay; an empty table
    gives an empty result."""
    keep = _row_components(docs, percent).where("kept").select("row_key").distinct()
    rows = docs.select(_row_key().alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return (rows.join(keep, "row_key", "left_semi").groupBy("row_key")
            .agg(F.min_by("row", F.md5(F.to_json("row"))).alias("row")).select("row.*"))
