"""Queries that run a stream to the end of the data and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.operators.prepare import assemble_conversations
from chatloom.plans import views as V
from chatloom.plans.registry import query, table
from chatloom.session import scratch_dir
from chatloom.sources.datasets import CHAT_SAMPLE, write_jsonl
from chatloom.streaming import jobs as J


def live_log(spark, sf_dir):
    """The events file as a stream; event time needs a TIMESTAMP, the file holds TIMESTAMP_NTZ."""
    schema = table(spark, sf_dir, "events").schema
    stream = J.from_table(spark, f"{sf_dir}/events.parquet", schema)
    return V.request_log_columns(stream).withColumn("ts", F.col("ts").cast("timestamp"))


def naive(df, *cols):
    """Timestamps without zone, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("stream_curate", """
WITH c AS (SELECT conv_id // 2 AS k, list({'role': role, 'content': text} ORDER BY turn) AS m FROM conversations GROUP BY conv_id),
g AS (SELECT DISTINCT m FROM c WHERE len(m) = 2 AND m[1].role = 'user' AND m[2].role = 'assistant')
SELECT m[1].content AS user_content, m[2].content AS model_content FROM g""")
def stream_curate(spark, sf_dir):
    """Conversations as JSON-lines files, every one of them twice, through the curation stream."""
    root = scratch_dir(spark, "curate")
    samples = assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("messages")
    write_jsonl(samples.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"), f"{root}/in")
    stream = J.from_files(spark, f"{root}/in", "*.json", CHAT_SAMPLE, "json")
    for q in J.stream_curate(stream, f"{root}/good", f"{root}/bad", f"{root}/state", roles=("user", "assistant")):
        q.awaitTermination()
    schema = T.StructType([*CHAT_SAMPLE.fields, T.StructField("arrived", T.TimestampType())])
    kept = spark.read.schema(schema).parquet(f"{root}/good")
    return kept.select(F.col("messages")[0]["content"].alias("user_content"), F.col("messages")[1]["content"].alias("model_content"))


_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query("stream_usage", f"""WITH {V.REQUEST_LOG},
w AS (SELECT *, date_trunc('day', ts) AS window_start FROM request_log),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY seconds) AS rn, count(*) OVER (PARTITION BY window_start) AS c FROM w)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(seconds), 2) AS seconds,
  round(sum(tokens) / sum(seconds), 4) AS tokens_per_second, round(avg(seconds), 4) AS mean_seconds,
  min(seconds) FILTER (rn >= 0.5 * c) AS p50_seconds, min(seconds) FILTER (rn >= 0.95 * c) AS p95_seconds,
  round(avg(CASE WHEN status <> 200 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS error_rate
FROM r GROUP BY window_start HAVING window_start + INTERVAL 1 DAY <= {_CLOSED}""")
def stream_usage(spark, sf_dir):
    root = scratch_dir(spark, "usage")
    report = J.stream_usage(live_log(spark, sf_dir), "1 day")
    return naive(J.drain(report, f"{root}/out", f"{root}/state"), "window_start", "window_end")


@query("stream_usage_sliding", f"""WITH {V.REQUEST_LOG},
w AS (SELECT *, date_trunc('hour', ts) - to_hours(extract(hour FROM ts)::INT % 6) - to_hours(6 * k) AS window_start FROM request_log, range(0, 2) t(k))
SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens
FROM w GROUP BY window_start HAVING window_start + INTERVAL 12 HOUR <= {_CLOSED}""")
def stream_usage_sliding(spark, sf_dir):
    root = scratch_dir(spark, "sliding")
    report = J.stream_usage(live_log(spark, sf_dir), "12 hours", "6 hours")
    return naive(J.drain(report, f"{root}/out", f"{root}/state"), "window_start", "window_end").select(
        "window_start", "window_end", "requests", "tokens"
    )


@query("stream_sessions", f"""WITH {V.REQUEST_LOG},
g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY client ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM request_log),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY client ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT client, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS requests, CAST(sum((status <> 200)::INT) AS BIGINT) AS errors
FROM s GROUP BY client, sid HAVING max(ts) + INTERVAL 2 HOUR <= {_CLOSED}""")
def stream_sessions(spark, sf_dir):
    root = scratch_dir(spark, "sessions")
    sessions = J.stream_sessions(live_log(spark, sf_dir), "2 hours")
    return naive(J.drain(sessions, f"{root}/out", f"{root}/state"), "session_start", "session_end")
