"""What one task is given stays the same size in a larger table."""

from pyspark.sql import functions as F

from tracewarden import session
from tracewarden.sources import sample_feed


def test_a_large_single_file_is_spread_by_its_size(spark, tmp_path):
    rows = spark.range(1_500_000).select("id", F.xxhash64("id").alias("noise"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    scanned = sample_feed._scan(spark, f"{tmp_path}/t.parquet")
    size = sample_feed._bytes(spark, scanned.inputFiles())
    parts = scanned.rdd.getNumPartitions()
    assert size > 8 * sample_feed.TASK_BYTES and parts >= size / sample_feed.TASK_BYTES
    assert scanned.agg(F.count("*"), F.bit_xor("noise")).first() == rows.agg(F.count("*"), F.bit_xor("noise")).first()


def test_tasks_after_a_shuffle_are_bounded(spark):
    before = spark.conf.get(session.ADVISORY)
    try:
        spark.conf.set(session.ADVISORY, "64MB")
        assert session.prepare(spark).conf.get(session.ADVISORY) == f"{session.TASK_SHUFFLE_BYTES}b"
        spark.conf.set(session.ADVISORY, "8m")
        assert session.prepare(spark).conf.get(session.ADVISORY) == "8m"
    finally:
        spark.conf.set(session.ADVISORY, before)
