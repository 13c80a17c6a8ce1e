"""Session helpers: the settings every job relies on, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# bytes of shuffle files that one task may be given when small partitions are put together
TASK_SHUFFLE_BYTES = 16 << 20


def build_session(
    app_name: str = "tracewarden",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs expect.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: AQE coalesces
    and splits shuffle partitions from the configured upper bound.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the jobs depend on.

    Naive times are read as UTC. The JVM never compiles a method over 8000 bytes of bytecode,
    so a fused cleaning stage of that size would run interpreted; with the limit below Spark
    generates such a stage as split, compilable expression methods instead. Partitions are put together by the
    bytes of their compressed files, and narrow sorted events take many times those in memory, so less goes to one task than
    Spark's 64 MB; a session that asks for still less keeps its setting.
    """
    for key, value in RUNTIME.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(ADVISORY)) > TASK_SHUFFLE_BYTES:
        spark.conf.set(ADVISORY, f"{TASK_SHUFFLE_BYTES}b")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names.

    Only a local-mode session that names none gets a scratch folder of its own; on a
    cluster a machine-local folder would not survive a lost executor, so it is refused.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = os.path.join(tempfile.mkdtemp(prefix="tracewarden-"), "checkpoints")
    context.setCheckpointDir(configured)
    return configured
