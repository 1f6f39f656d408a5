"""Session settings and the two places where a job needs durable scratch space."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE on, skew joins on)."""
    builder = (
        SparkSession.builder.appName("chatloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # sessions of a busy client are merged inside each map task before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # checkpoint files go when the frame that needs them is gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder is lost together with the machine that holds it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # local-cluster has executors of their own
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="chatloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and ends the plan's growth."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def cut_narrow(df: DataFrame, per_task: int = 50_000, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """A checkpoint of narrow rows (numbers, sketches), read in one partition per ``per_task`` rows, or in as many as it has if that is less.

    A shuffle leaves three files per task that writes to it, until the driver collects its garbage, and a checkpoint two per partition, however few the
    rows. Loops over small tables thus fill the disk with files of a few bytes. Rows are counted as they are written; up to ``per_task`` of them are
    one partition, and the number of partitions grows with the rows. ``cut`` makes the checkpoint.
    """
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out.coalesce(max(1, math.ceil(seen.get.get("n", 0) / per_task)))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the scratch folder.

    For long loops: unlike a checkpoint, a table keeps none of the old plan's constraints, which a loop would multiply.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession, most: int = 2_000) -> Iterator[None]:
    """Inside of it jobs send Python at most ``most`` rows at a time.

    Spark's 10,000 rows of whole texts, or of pairs of texts, are tens of MB per running task, which the executor holds outside of its heap and the Python worker once more; both
    keep what they once took. Only for jobs that end inside, such as checkpoints: the session's own setting, if smaller, holds, and comes back afterwards.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)
