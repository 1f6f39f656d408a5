"""Queries over batch inference and request logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.text import words
from chatloom.operators import serving as S
from chatloom.plans import views as V
from chatloom.plans.registry import query, sql_list, table

_GOOD, _BAD = ["the", "die", "le", "el", "and", "to"], ["of", "der", "de", "in", "la", "und"]


@query("batch_predict", f"""
WITH w AS (SELECT conv_id, turn, text, string_split(lower(text), ' ') AS ws FROM conversations),
s AS (SELECT *, len(list_filter(ws, lambda x: list_contains({sql_list(_GOOD)}, x))) - len(list_filter(ws, lambda x: list_contains({sql_list(_BAD)}, x))) AS b FROM w)
SELECT conv_id, turn, CASE WHEN length(text) > 900 THEN NULL WHEN b > 0 THEN 'Positive' WHEN b < 0 THEN 'Negative' ELSE 'Neutral' END AS prediction,
  CASE WHEN length(text) > 900 THEN 'ValueError: prompt too long' END AS error FROM s""")
def batch_predict(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return S.batch_predict(turns, S.lexicon_scorer(_GOOD, _BAD, 900), "text", 64).drop("text")


_N = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> ''))"


def responses(spark, sf_dir):
    pairs = V.turn_pairs(spark, sf_dir)
    body = S.to_chat_completion(
        F.lit("demo"), F.col("prediction"), F.size(words(F.col("reference"))), F.size(words(F.col("prediction"))),
        F.concat(F.lit("chatcmpl-"), "id"),
    )
    return pairs.select("id", body.alias("body"))


@query("to_chat_completion", f"""WITH {V.TURN_PAIRS}
SELECT id, 'chatcmpl-' || id::VARCHAR AS rid, 'chat.completion' AS object, 'demo' AS model, 'assistant' AS role, prediction AS content, 'stop' AS finish_reason,
  CAST({_N.format('reference')} + {_N.format('prediction')} AS BIGINT) AS total_tokens FROM turn_pairs""")
def to_chat_completion(spark, sf_dir):
    def at(path):
        return F.get_json_object("body", path)

    return responses(spark, sf_dir).select(
        "id", at("$.id").alias("rid"), at("$.object").alias("object"), at("$.model").alias("model"),
        at("$.choices[0].message.role").alias("role"), at("$.choices[0].message.content").alias("content"),
        at("$.choices[0].finish_reason").alias("finish_reason"), at("$.usage.total_tokens").cast("bigint").alias("total_tokens"),
    )


@query("parse_chat_completion", f"""WITH {V.TURN_PAIRS}
SELECT id, trim(prediction) AS content, 'stop' AS finish_reason, CAST({_N.format('reference')} AS BIGINT) AS prompt_tokens,
  CAST({_N.format('prediction')} AS BIGINT) AS completion_tokens, CAST({_N.format('reference')} + {_N.format('prediction')} AS BIGINT) AS total_tokens FROM turn_pairs""")
def parse_chat_completion(spark, sf_dir):
    return S.parse_chat_completion(responses(spark, sf_dir), "body").drop("body")


@query("usage_report", f"""WITH {V.REQUEST_LOG},
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY seconds) AS rn, count(*) OVER (PARTITION BY kind) AS c FROM request_log)
SELECT kind, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(seconds), 2) AS seconds, round(sum(tokens) / sum(seconds), 4) AS tokens_per_second,
  round(avg(seconds), 4) AS mean_seconds, min(seconds) FILTER (rn >= 0.5 * c) AS p50_seconds, min(seconds) FILTER (rn >= 0.95 * c) AS p95_seconds,
  round(avg(CASE WHEN status <> 200 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS error_rate
FROM r GROUP BY kind""")
def usage_report(spark, sf_dir):
    return S.usage_report(V.request_log(spark, sf_dir), ["kind"])


@query("request_speed", f"WITH {V.REQUEST_LOG} SELECT id, round(tokens / nullif(seconds, 0), 4) AS tokens_per_second FROM request_log")
def request_speed(spark, sf_dir):
    return S.with_speed(V.request_log(spark, sf_dir)).select("id", F.round("tokens_per_second", 4).alias("tokens_per_second"))


@query("health_runs", f"""WITH {V.REQUEST_LOG},
s AS (SELECT *, min(ts) OVER (PARTITION BY client) AS start FROM request_log),
f AS (SELECT *, status <> 200 AND ts >= start + INTERVAL 120 SECOND AS failed FROM s),
r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY client ORDER BY ts, id) AS run FROM f)
SELECT client, count(*) AS failures, min(ts) AS first_ts, max(ts) AS last_ts, count(*) >= 3 AS outage FROM r WHERE failed GROUP BY client, run""")
def health_runs(spark, sf_dir):
    log = V.request_log(spark, sf_dir)
    return S.health_runs(log, "client", "ts", F.col("status") != 200, ["ts", "id"], threshold=3)
