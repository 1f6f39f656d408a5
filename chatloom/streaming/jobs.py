"""Streaming forms of curation and usage reports. They reuse the batch operators' columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from chatloom.operators.contracts import validate_messages
from chatloom.operators.serving import usage_aggregates


def stream_curate(
    samples: DataFrame, path: str, quarantine: str, checkpoint: str, lateness: str = "1 day",
    roles: tuple[str, ...] = ("user", "model"), messages: str = "messages", trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Validate chat samples, drop repeats, append good rows; bad rows go to ``quarantine``.

    ``samples`` carries ``arrived``, the event time (for files: their modification time). State is
    bounded by the watermark, so a repeat that arrives later than ``lateness`` after its first copy
    can come back. Two queries, each with its own checkpoint: a restart repeats neither sink.
    """
    checked = validate_messages(samples, messages, roles)
    key = F.sha2(F.to_json(messages), 256)
    good = checked.filter(F.size("reasons") == 0).drop("reasons").withColumn("_key", key)
    fresh = good.withWatermark("arrived", lateness).dropDuplicatesWithinWatermark(["_key"]).drop("_key")
    bad = checked.filter(F.size("reasons") > 0)
    options = trigger or {"availableNow": True}
    return [
        _parquet_sink(fresh, path, f"{checkpoint}/good", options), _parquet_sink(bad, quarantine, f"{checkpoint}/bad", options),
    ]


def _parquet_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def stream_usage(log: DataFrame, window: str, slide: str | None = None, lateness: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    """Requests, tokens, latency and error rate per tumbling (or sliding) window of ``ts``.

    Works on a stream (append mode emits a window once the watermark has passed its end; later
    rows are dropped) and unchanged on a batch table.
    """
    framed = log.withWatermark("ts", lateness) if log.isStreaming else log
    frame = F.window("ts", window, slide) if slide else F.window("ts", window)
    report = framed.groupBy(frame.alias("w"), *by).agg(*usage_aggregates())
    return report.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in report.columns if c != "w"])


def stream_sessions(log: DataFrame, gap: str, lateness: str = "1 hour", client: str = "client") -> DataFrame:
    """Client sessions closed by ``gap`` of silence: requests and errors per session.

    Start and end come from aggregates, not from the window column: Spark moves a filter on
    the window column below the merging of sessions, which would cut sessions short.
    """
    framed = log.withWatermark("ts", lateness) if log.isStreaming else log
    sessions = framed.groupBy(F.session_window("ts", gap), client).agg(
        F.min("ts").alias("session_start"), (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
        F.count(F.lit(1)).alias("requests"), F.sum((F.col("status") != 200).cast("bigint")).alias("errors"),
    )
    return sessions.select(client, "session_start", "session_end", "requests", "errors")


def drain(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a streaming frame over everything available now and return what reached the sink."""
    _parquet_sink(df, path, checkpoint, {"availableNow": True}).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def from_table(spark, path: str, schema, fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    """File stream over a table that is one file or a folder of part files; a path that does not exist is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(place)
    root, pattern = (path, "*") if found.isDirectory() else path.rsplit("/", 1)
    return from_files(spark, root, pattern, schema, fmt, max_files=max_files)


def from_files(spark, root: str, pattern: str, schema, fmt: str, select: Callable[[DataFrame], DataFrame] | None = None, max_files: int = 1000) -> DataFrame:
    """File stream with the arrival time of every row's file as ``arrived``."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files)
    stream = reader.load(root)
    arrived: Column = F.col("_metadata.file_modification_time").alias("arrived")
    rows = stream.select("*", arrived)
    return select(rows) if select else rows
