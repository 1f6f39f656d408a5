"""Batch inference with user-supplied models, response shaping and request-log reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.ranks import ranked
from chatloom.functions.text import strip
from chatloom.plans.positions import running_total
from chatloom.sources.datasets import MESSAGE

Model = Callable[[list[str]], Sequence[str | None]]

USAGE = T.StructType([
    T.StructField("prompt_tokens", T.LongType()), T.StructField("completion_tokens", T.LongType()), T.StructField("total_tokens", T.LongType()),
])
CHAT_COMPLETION = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("object", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("choices", T.ArrayType(T.StructType([
        T.StructField("index", T.IntegerType()), T.StructField("message", MESSAGE), T.StructField("finish_reason", T.StringType()),
    ]))),
    T.StructField("usage", USAGE),
])


def batch_predict(
    df: DataFrame, factory: Callable[[], Model], prompt: str, batch_rows: int = 256, partitions: int | None = None
) -> DataFrame:
    """Add ``prediction`` and ``error`` by running a model over the prompts.

    ``factory`` is called once per task, before its first batch. When a batch raises, its
    rows are retried one by one, so only the failing rows end with a null prediction and the
    error text; nothing is fatal. ``partitions`` spreads few, expensive prompts.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.StringType()), T.StructField("error", T.StringType())])

    def one(model: Model, text: str) -> tuple[str | None, str | None]:
        try:
            return model([text])[0], None
        except Exception as exc:  # noqa: BLE001 - any model failure becomes a row value
            return None, f"{type(exc).__name__}: {exc}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                part = frame.iloc[start:start + batch_rows]
                texts = part[prompt].tolist()
                try:
                    answers = [(a, None) for a in model(texts)]
                except Exception:  # noqa: BLE001
                    answers = [one(model, t) for t in texts]
                yield part.assign(prediction=[a for a, _ in answers], error=[e for _, e in answers])

    source = df.repartition(partitions) if partitions else df
    return source.mapInPandas(run, schema)


def lexicon_scorer(positive: Sequence[str], negative: Sequence[str], max_chars: int | None = None) -> Callable[[], Model]:
    """A stand-in model for tests and dry runs: more positive than negative words wins."""
    def factory() -> Model:
        good, bad = set(positive), set(negative)

        def score(text: str) -> str:
            if max_chars is not None and len(text) > max_chars:
                raise ValueError("prompt too long")
            words = text.lower().split(" ")
            balance = sum(w in good for w in words) - sum(w in bad for w in words)
            return "Positive" if balance > 0 else "Negative" if balance < 0 else "Neutral"

        return lambda texts: [score(t) for t in texts]

    return factory


def to_chat_completion(model: Column, text: Column, prompt_tokens: Column, completion_tokens: Column, response_id: Column) -> Column:
    """Response JSON; totals add up and the finish reason is always ``stop``."""
    message = F.struct(F.lit("assistant").alias("role"), text.alias("content"))
    choice = F.struct(F.lit(0).alias("index"), message.alias("message"), F.lit("stop").alias("finish_reason"))
    usage = F.struct(
        prompt_tokens.cast("bigint").alias("prompt_tokens"), completion_tokens.cast("bigint").alias("completion_tokens"),
        (prompt_tokens + completion_tokens).cast("bigint").alias("total_tokens"),
    )
    body = F.struct(
        response_id.alias("id"), F.lit("chat.completion").alias("object"), model.alias("model"), F.array(choice).alias("choices"), usage.alias("usage")
    )
    return F.to_json(body)


def parse_chat_completion(df: DataFrame, col: str) -> DataFrame:
    """Add ``content`` (stripped), ``finish_reason`` and the three usage counts."""
    parsed = df.withColumn("_r", F.from_json(col, CHAT_COMPLETION))
    first = F.get(F.col("_r.choices"), F.lit(0))
    usage = {c: F.col(f"_r.usage.{c}") for c in USAGE.fieldNames()}
    return parsed.withColumns({"content": strip(first["message"]["content"]), "finish_reason": first["finish_reason"], **usage}).drop("_r")


def with_speed(df: DataFrame, tokens: str = "tokens", seconds: str = "seconds") -> DataFrame:
    """Tokens per second of each request; null when no time elapsed."""
    return df.withColumn("tokens_per_second", F.try_divide(F.col(tokens).cast("double"), F.col(seconds)))


def usage_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("requests"), F.sum("tokens").alias("tokens"), F.round(F.sum("seconds"), 2).alias("seconds"),
        F.round(F.try_divide(F.sum("tokens").cast("double"), F.sum("seconds")), 4).alias("tokens_per_second"),
        F.round(F.avg("seconds"), 4).alias("mean_seconds"), ranked("seconds", 50).alias("p50_seconds"), ranked("seconds", 95).alias("p95_seconds"),
        F.round(F.avg((F.col("status") != 200).cast("double")), 4).alias("error_rate"),
    ]


def usage_report(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals, mean, p50 / p95 latency and error rate per group.

    Percentiles are exact, from map-side counts of the different latencies.
    """
    return df.groupBy(*by).agg(*usage_aggregates())


def health_runs(
    df: DataFrame, service: str, ts: str, failed: Column, order: Sequence[str], threshold: int = 15, grace_seconds: int = 120
) -> DataFrame:
    """Runs of consecutive failed probes; a run of at least ``threshold`` is an outage.

    Failures within ``grace_seconds`` of a service's first probe are start-up and ignored. A
    run is identified by how many good probes came before it, a running total over range
    partitions, so neither a busy service nor a busy day ends up in one task.
    """
    probes = df.select(service, ts, *[o for o in order if o not in (service, ts)], failed.alias("_failed"))
    ok = F.when(F.col("_failed"), 0).otherwise(1)
    ranked = running_total(probes, ok, [service], order, "_run", group_min=("_start", F.col(ts)))
    # start-up failures come before all others, so leaving them out neither joins nor splits a later run
    live = F.col(ts) >= F.col("_start") + F.make_interval(secs=F.lit(grace_seconds))
    runs = ranked.filter(F.col("_failed") & live).groupBy(service, "_run").agg(
        F.count(F.lit(1)).alias("failures"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return runs.drop("_run").withColumn("outage", F.col("failures") >= threshold)
