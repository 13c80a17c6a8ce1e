"""Queries of the timeline, the links and the first rows of a host clean and write narrow tables, and free what their writes shuffled."""

import os
import random
import re
import time

import pytest
from helpers import firewall, identity, raw
from pyspark.sql import functions as F
from test_parts import rows_of

from tracewarden.operators import cleaning, dedupe, investigate
from tracewarden.plans import feed, queries
from tracewarden.sources.published import FILE_CLEANUP, publish

NARROW = ["relationship_quality_report", "evidence_timeline_first_100", "timeline_chart_points", "firewall_first_50_events_per_user"]


def counted(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def tables(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"{tmp_path}/kept")
    columns = {
        "customer": ["id as c_custkey", "concat('Customer#', lpad(cast(id as string), 9, '0')) as c_name", "'BUILDING' as c_mktsegment"],
        "orders": ["id as o_orderkey", "id % 40 as o_custkey", "'F' as o_orderstatus", "'1-URGENT' as o_orderpriority"],
        "events": ["id as event_id", "id % 40 as user_id", "timestamp_ntz'2024-01-05 10:00:00' + make_interval(0, 0, 0, 0, id % 5) as ts",
                   "1.5D as value", "'click' as event_type"],
        "lineitem": ["id as l_orderkey", "cast(1 + id % 7 as int) as l_linenumber", "900.5D as l_extendedprice"],
    }
    for name, chosen in columns.items():
        spark.range(160).selectExpr(*chosen).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_no_whole_table_is_written(spark, tables):
    """Nor the timeline for a query that reads it once."""
    for name in NARROW:
        queries.QUERIES[name](spark, tables)
    written = {os.path.basename(at) for at, found, _ in os.walk(f"{tables}/kept") if any(f.startswith("run-") for f in found)}
    assert {w for w in written if w.endswith("_stage")} == {"identity_stage"} and "evidence_timeline" not in written
    assert {f"{table}_timeline" for table in ("iam", "endpoint", "firewall")} <= written


@pytest.mark.parametrize("table", ["iam", "endpoint", "firewall"])
def test_narrow_rows_are_those_of_the_clean_table(spark, table):
    df = raw(spark, table, *rows_of(table))
    columns = feed.NARROW["events"][table]
    assert all(set(tables[table]) <= {*columns, "hostname_join_key"} for tables in feed.NARROW.values() if table in tables)
    assert counted(cleaning.clean_part(table, df, columns)) == counted(cleaning.clean(table, df).select(*columns))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(" ")))

    before = files()
    rows = spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 9_000).alias("k")).agg(F.count("*").alias("n"))
    back = publish(rows, str(tmp_path), "t")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(FILE_CLEANUP) == "false"
    assert back.agg(F.sum("n"), F.count("*")).first() == (50_000, 9_000)
    assert rows.count() == 9_000


def test_the_digest_of_three_columns_tells_rows_apart(spark):
    rows = [("k", "a", "bc", ""), ("k", "ab", "c", ""), ("k", None, "a", "b"), ("k", "a", None, "b"), ("k", "", None, "-"), ("k", None, "", "-"),
            ("k", "a", "bc", ""), (None, None, None, None), (None, None, None, None), ("k", "1:a", "", "1"), ("k", "", "1:a", "1")]
    df = spark.createDataFrame(rows, "key string, x string, y string, z string")
    part = dedupe.distinct_part(df, ["key"])
    assert "sha2" in part._jdf.queryExecution().optimizedPlan().toString()
    assert counted(part) == counted(dedupe.distinct_with_copies(df).select("key", dedupe.COPIES))


def test_shared_names_against_a_plain_search(spark, monkeypatch):
    """Repeated and null keys, users of several shared names and of ids: each text and user once, and the shared rows are not shuffled."""
    dice = random.Random(5)
    shown = ["alex morgan", "casey lee", "robin fox", "only one", "just two"]
    people = [{"user_id": f"EMP{i}", "full_name": dice.choice(shown[:3]), "username": dice.choice([*shown[:3], None, f"user{i}"])} for i in range(90)]
    people += [{"user_id": "EMP3", "full_name": "Only One"}, {"user_id": "EMP200", "full_name": "Just Two"}, {"user_id": "EMP201", "full_name": "just two"},
               {"user_id": None, "full_name": "Alex Morgan"}]
    ident = identity(spark, *people)
    lines = [(dice.choice([None, *range(8)]), " , ".join(dice.sample([*shown, "EMP1", "emp-7", "EMP999", "nothing"], dice.randint(1, 5)))) for _ in range(40)]
    texts = spark.createDataFrame(lines, "k int, text string")
    want = {}
    for k, text in lines:
        for spelled in re.findall(r"(?i)emp-?\d+", text):
            user = spelled.upper().replace("-", "")
            want[k, user] = (user != "EMP999", "id")
        for p in people:
            if p["user_id"] and {(p["full_name"] or "").lower(), (p.get("username") or "").lower()} & set(text.split(" , ")):
                want.setdefault((k, p["user_id"]), (True, "name"))
    for users in (256, 4, 1):
        monkeypatch.setattr(investigate, "NAME_USERS", users)
        rows = investigate.user_mentions(texts, ["k"], ident, ident)
        got = rows.collect()
        assert len(got) == len(want) and {(r["k"], r["user_id"]): (r["found"], r["how"]) for r in got} == want
    # nothing is grouped above the join that forms the rows of shared names
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    branch = max(at for at, line in enumerate(plan) if line.startswith("+- "))
    joined = next(at for at, line in enumerate(plan) if "array_intersect" in line)
    assert plan[0].startswith("Union") and branch < joined and not any("Aggregate" in line for line in plan[branch:joined])


def test_a_row_is_cut_once_per_spelling(spark):
    """Names that differ in case, rows without one of the names, and users who fall back to full names."""
    logs = firewall(
        spark, *[{"log_id": f"{i}", "hostname": "a.corp.local", "hostname_join_key": "a", "bytes_sent": i} for i in range(5)],
        {"log_id": "A1", "hostname": "A.corp.local", "hostname_join_key": "A"}, {"log_id": "3", "hostname": "b.x"},
        {"log_id": "5", "hostname_join_key": "D"}, {"log_id": "6"})
    wanted = spark.createDataFrame([("U", "a"), ("U", "a.corp.local"), ("V", "a.corp.local"), ("W", "b.x"), ("X", "d"), ("Y", "zz")],
                                   "user_id string, host_key string")
    want = [("U", 1, "0"), ("U", 2, "1"), ("U", 3, "2"), ("V", 1, "0"), ("V", 2, "1"), ("V", 3, "2"), ("W", 1, "3"), ("X", 1, "5")]
    for traffic in (None, investigate.user_traffic(wanted, logs)):
        events = investigate.firewall_events(wanted, logs, 3, traffic)
        assert sorted((r["user_id"], r["event_no"], r["log_id"]) for r in events.collect()) == want
    # with the match at hand only spellings get two names, never the rows
    plan = events._jdf.queryExecution().optimizedPlan().toString().splitlines()
    inlined = [at for at, line in enumerate(plan) if "Generate inline" in line]
    assert inlined and all(any("Aggregate" in below for below in plan[at + 1:at + 4]) for at in inlined)
