"""Sources, contracts and the whole pipeline from exported files."""

import pytest
from pyspark.sql import functions as F

from tracewarden.plans import pipeline
from tracewarden.schemas import PUBLISHED, RAW_COLUMNS
from tracewarden.sources import published, raw, sample_feed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    inputs = {}
    for table in RAW_COLUMNS:
        df, path = sample_feed.load(spark, SF, table), str(base / table)
        if table == "iam":
            df.coalesce(1).write.json(path)
            inputs[table] = (path, "jsonl")
        elif table == "endpoint":
            df.write.parquet(path)
            inputs[table] = (path, "parquet")
        else:
            df.write.option("header", True).option("escape", '"').csv(path)
            inputs[table] = (path, "csv")
    return inputs


def test_pipeline_publishes_everything(spark, exports, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, exports, out)
    report = {r["name"]: (r["exists"], r["rows"]) for r in published.verify_outputs(spark, out).collect()}
    assert set(report) == set(PUBLISHED) and all(exists for exists, _ in report.values())
    users = {r[0] for r in published.read(spark, out, "investigation_queue").select("user_id").collect()}
    threats = {r[0] for r in published.read(spark, out, "threat_detections").select("user_id").collect()}
    scored = {r[0] for r in published.read(spark, out, "user_risk_scores").select("user_id").collect()}
    assert users == threats & scored and users
    scores = published.read(spark, out, "user_risk_scores")
    parts = sum(F.col(c) for c in ("authentication_risk", "iam_risk", "endpoint_severity_risk",
                                   "threat_behavior_risk", "contextual_risk", "cross_signal_bonus"))
    assert scores.where(F.col("risk_score") != F.least(parts, F.lit(100.0))).count() == 0
    summary = {r["metric"]: r["value"]
               for r in published.read(spark, out, "identity_pipeline_summary").collect()}
    assert (summary["raw_rows"], summary["exact_duplicate_rows"]) == (159, 5)
    linked = published.read(spark, out, "relationship_quality_report").where("matched IS NOT NULL")
    assert linked.where("matched + missing + unmatched != rows").count() == 0


def test_json_array_and_missing_column(spark, tmp_path):
    good = tmp_path / "good.json"
    record = ", ".join(f'"{c}": "x"' for c in RAW_COLUMNS["iam"])
    good.write_text(f"[{{{record}}}, {{{record}}}]")
    df = raw.scan_json(spark, str(good))
    assert df.columns == [*RAW_COLUMNS["iam"], raw.MALFORMED] and len(df.collect()) == 2
    bad = tmp_path / "bad.json"
    bad.write_text('[{"event_id": 1}]')
    with pytest.raises(ValueError, match="timestamp"):
        pipeline.clean_and_report("iam", raw.scan_json(spark, str(bad)), str(tmp_path / "out"))
    assert published.manifest(spark, str(tmp_path / "out"), "iam_clean") is None  # refused rows are not committed


def test_json_lines_count_malformed_records(spark, tmp_path):
    record = ", ".join(f'"{c}": "x{{0}}"' for c in RAW_COLUMNS["iam"])
    lines = ["{" + record.replace("{0}", str(i)) + "}" for i in range(4)] + ["{broken", '{"event_id": "only"}']
    (tmp_path / "a.json").write_text("\n".join(lines[:3]))
    (tmp_path / "b.json").write_text("\n".join(lines[3:]))
    pipeline.clean_and_report("iam", raw.scan_json_lines(spark, f"{tmp_path}/*.json"), str(tmp_path / "out"))
    found = {r["metric"]: r["value"] for r in published.read(spark, str(tmp_path / "out"), "iam_pipeline_summary").collect()}
    assert (found["raw_rows"], found["malformed_records"], found["raw_columns"]) == (6, 1, 15)


def test_csv_contract_and_null_tokens(spark, tmp_path):
    path = tmp_path / "identity.csv"
    columns = [*RAW_COLUMNS["identity"], "surprise"]
    path.write_text(",".join(columns) + "\n" + ",".join(["NaN", "null", "N/A", " N/A "] + ["v"] * 9) + "\n")
    df = raw.scan_csv(spark, str(path), "identity")
    row = df.first()
    assert raw.unexpected_columns(df, "identity") == ["surprise"]
    assert row["full_name"] is None and row["user_id"] is None and row["department"] == " N/A "
    assert raw.expected_only(df, "identity").columns == list(RAW_COLUMNS["identity"])
    with pytest.raises(ValueError, match="role"):
        raw.require_columns(df.drop("role"), "identity")


def test_absent_inputs_and_outputs(spark, exports, tmp_path):
    with pytest.raises(FileNotFoundError, match="firewall"):
        raw.check_raw_inputs(spark, {k: v for k, v in exports.items() if k != "firewall"})
    report = published.verify_outputs(spark, str(tmp_path), ["nothing"]).first()
    assert tuple(report) == ("nothing", False, 0)
    with pytest.raises(FileNotFoundError):
        published.require_outputs(spark, str(tmp_path))


def test_csv_files_of_differing_headers(spark, tmp_path):
    """Two header orders, one with a column of its own and compressed, give the same table."""
    import gzip

    names = list(RAW_COLUMNS["firewall"])
    text = [",".join(header) + "\n" + ",".join(f"{i}_{n}" for n in header) + "\n"
            for i, header in enumerate((names, names[::-1], [*names[3:], "badge", *names[:3]], names))]
    for i in (0, 1, 3):
        (tmp_path / f"{i}.csv").write_text(text[i])
    (tmp_path / "2.csv.gz").write_bytes(gzip.compress(text[2].encode()))
    df = raw.scan_csv(spark, str(tmp_path), "firewall")
    assert raw.unexpected_columns(df, "firewall") == ["badge"]
    got = sorted(tuple(r) for r in raw.expected_only(df, "firewall").collect())
    assert got == [tuple(f"{i}_{n}" for n in names) for i in range(4)]
    (tmp_path / "4.csv").write_text("log_id\n1\n")
    with pytest.raises(ValueError, match="hostname"):
        raw.scan_csv(spark, str(tmp_path), "firewall")


def test_only_committed_runs_are_read(spark, tmp_path):
    out = str(tmp_path)
    first = published.publish(spark.range(5), out, "t")
    assert first.count() == 5 and published.manifest(spark, out, "t")["rows"] == 5

    def broken(batches):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        published.publish(spark.range(9).mapInArrow(broken, "id long"), out, "t")
    # files of a run that never committed lie about, and are not read
    spark.range(7).write.parquet(f"{out}/t/run-stray")
    assert published.read(spark, out, "t").count() == 5
    second = published.publish(spark.range(6).withColumnRenamed("id", "n"), out, "t")
    assert second.columns == ["n"] and second.count() == 6 and first.count() == 5  # a reader of the former run goes on
    published.publish(spark.range(0), out, "t")
    assert tuple(published.verify_outputs(spark, out, ["t"]).first()) == ("t", True, 0)
    with pytest.raises(FileNotFoundError):
        published.read(spark, out, "u")
    text = published.publish(spark.range(3), out, "c", "csv")
    assert text.dtypes == [("id", "string")] and sorted(r["id"] for r in text.collect()) == ["0", "1", "2"]


def test_changed_tables_are_read_anew(spark, tmp_path):
    from tracewarden.plans.feed import Feed

    def rows():
        return Feed(spark, str(tmp_path)).published("n", lambda: spark.read.parquet(f"{tmp_path}/n.parquet")).count()

    spark.range(3).write.parquet(f"{tmp_path}/n.parquet")
    assert rows() == 3 and rows() == 3
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/n.parquet")
    assert rows() == 4


def test_summaries_tell_unread_times_and_columns(spark, tmp_path):
    from helpers import raw as made

    rows = made(spark, "identity", {"user_id": "EMP1", "hire_date": "2024-01-05", "termination_date": "n/a"},
                {"user_id": "EMP2", "hire_date": "the fifth", "termination_date": "2024-13-45"}).withColumn("badge", F.lit("x"))
    pipeline.clean_and_report("identity", rows, str(tmp_path))
    found = {r["metric"]: r["value"] for r in published.read(spark, str(tmp_path), "identity_pipeline_summary").collect()}
    assert (found["unparsed_dates"], found["unexpected_column: badge"], found["raw_rows"]) == (2, 1, 2)
    assert "_unparsed" not in published.read(spark, str(tmp_path), "identity_clean").columns
