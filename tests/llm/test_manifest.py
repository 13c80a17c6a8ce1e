"""The Merkle manifest against DuckDB SQL and a plain recursion."""

from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tracewarden.llm import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, number int, digest string"


def as_rows(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["leaf"], r["proof_sha256"]))


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.drop("tree", "number", "digest").toArrow())
    cursor = con.execute(merkle_manifest.manifest_sql())
    names = [d[0] for d in cursor.description]
    return sorted((dict(zip(names, r)) for r in cursor.fetchall()),
                  key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["leaf"], r["proof_sha256"]))


def test_edge_rows_and_several_blocks(spark):
    odd = [(None, None, None, None, None), (None, "null ID", "en", "a", 7), (1, "", "", "", 0), (1, "", "", "", 0), (2, "Same ID", None, "b", 1),
           (2, "other", None, "b", 1), (-5, "Ünicode É A-Z", "de", "b", 13), (20, "x" * 200_000 + "QUITE LONG", "en", "ä", None)]
    many = [(100 + i, f"Row {i} OF the hot source", "en", "hot", i) for i in range(4500)] + [(9000 + i, "A", "en", f"s{i % 20:02d}", 1) for i in range(60)]
    docs = spark.createDataFrame([(*r, "t", 1, "d") for r in odd + many], SCHEMA)
    got, want = as_rows(merkle_manifest.manifest(docs)), by_sql(docs)
    assert len(got) == len(want) == len(odd) + len(many)
    assert [r.asDict() for r in got] == [{n: w[n] for n in got[0].asDict()} for w in want]
    kept = {r["doc_id"] for r in got if not r["verified"]}
    assert kept and kept < {r[0] for r in odd + many}


def test_plain_recursion(spark):
    def h(parts):
        return sha256("".join(parts).encode()).hexdigest()

    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", 2, "", 0, "") for i in range(37)], SCHEMA)
    leaves = [h(["".join(f"{len(v)}:{v}" for v in (str(i), "s", "en", "2", f"t{i}"))]) for i in range(37)]
    runs = [leaves[0:16], leaves[16:32], leaves[32:]]
    root = h([h(r) for r in runs])
    got = {r["doc_id"]: r for r in merkle_manifest.manifest(docs).collect()}
    assert {r["root"] for r in got.values()} == {r["subroot"] for r in got.values()} == {root}
    for i in (0, 15, 16, 36):
        run = runs[i // 16]
        siblings = [x for x in run if x != leaves[i]] + [h(r) for r in runs if r is not run]
        assert (got[i]["leaf"], got[i]["proof_sha256"]) == (leaves[i], h(siblings))
    assert all(r["verified"] for r in got.values())  # the texts hold no capitals


def test_empty_and_single(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle_manifest.manifest(none).collect() == []
    one = merkle_manifest.manifest(spark.createDataFrame([(3, "a", "en", None, 1, "", 0, "")], SCHEMA)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"]
    assert one["proof_sha256"] == sha256(b"").hexdigest()


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
def test_open_tree(n):
    """Witnesses of a streaming append fold to the root of a tree built level by level."""
    digests = [sha256(str(i).encode()).hexdigest() for i in range(n)]
    tree = merkle_manifest.OpenTree(merkle_manifest.depth(n))
    witnesses = [tree.append(d) for d in digests]
    tree.close()
    level = digests
    while len(level) > 1:
        level = [merkle_manifest.joined(level[i:i + 16]) for i in range(0, len(level), 16)]
    assert tree.root == level[0]
    for d, w in list(zip(digests, witnesses))[:: max(1, n // 50)]:
        assert merkle_manifest.folded(d, w.path() if w else []) == tree.root


def test_leaf_reads_whole_text(spark):
    docs = spark.createDataFrame([(1, "é" * 70_000, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert docs.select(merkle_manifest.leaf_digest().alias("x")).first()["x"] == sha256(
        f"1:1---140000:{'é' * 70_000}".encode()).hexdigest()
    assert docs.select(merkle_manifest.leaf_digest(F.lit(None).cast("string")).alias("x")).first()["x"] == sha256(b"1:1----").hexdigest()
