"""Training rows: conversations, rendered text, tokens, masks, packing and batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.ranks import ranked
from chatloom.functions.text import words
from chatloom.plans.positions import running_total

# The turn format of the chat models this data is for.
BOS = "<bos>"
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
# The two labelled-text sample formats.
INSTRUCT_HEAD = "Instruct: Classify the sentiment.\nInput: "
INSTRUCT_ANSWER = "\nOutput: "
REVIEW_HEAD = "Review: "
REVIEW_ANSWER = "\nSentiment: "


def build_messages(user: Column, answer: Column, roles: tuple[str, str] = ("user", "model")) -> Column:
    """Two-element messages array."""
    return F.array(
        F.struct(F.lit(roles[0]).alias("role"), user.alias("content")),
        F.struct(F.lit(roles[1]).alias("role"), answer.alias("content")),
    )


def assemble_parts(
    df: DataFrame, id_col: str, turn: str, role: str = "role", text: str = "text", part_turns: int = 4096
) -> DataFrame:
    """Turn rows to ``id, part, messages, turns`` (turn numbers) in turn order, in parts of at most ``part_turns`` turn numbers.

    For conversations too long for one row; :func:`assemble_conversations` gives whole ones.
    """
    part = F.floor(F.col(turn) / part_turns).cast("bigint")
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    grouped = df.groupBy(F.col(id_col), part.alias("part")).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return grouped.select(id_col, "part", _messages("_items").alias("messages"), F.transform("_items", lambda m: m["turn"]).alias("turns"))


def _messages(items: str) -> Column:
    return F.transform(items, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def assemble_conversations(
    df: DataFrame, id_col: str, turn: str, role: str = "role", text: str = "text", part_turns: int = 4096
) -> DataFrame:
    """Turn rows to one row per conversation: ``id, messages, turns`` (turn numbers) in turn order.

    Two levels: parts of ``part_turns`` turn numbers are sorted each by itself, then put together in order; their size has no
    influence on the rows. Turn numbers may have gaps and start anywhere; rows with equal numbers go by role and text, a null number comes first.
    """
    parts = assemble_parts(df, id_col, turn, role, text, part_turns)
    whole = parts.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("part", "messages", "turns"))).alias("_parts"))
    return whole.select(id_col, F.flatten(F.transform("_parts", lambda p: p["messages"])).alias("messages"), F.flatten(F.transform("_parts", lambda p: p["turns"])).alias("turns"))


def with_ends(parts: DataFrame, id_col: str) -> DataFrame:
    """Add ``is_first`` and ``is_last``: whether a part begins or ends its conversation. Only ids and part numbers meet."""
    ends = parts.groupBy(F.col(id_col).alias("_id")).agg(F.min("part").alias("_start"), F.max("part").alias("_end"))
    met = parts.join(ends, F.col(id_col).eqNullSafe(F.col("_id")))
    return met.withColumn("is_first", F.col("part") == F.col("_start")).withColumn("is_last", F.col("part") == F.col("_end")).drop("_id", "_start", "_end")


def explode_turns(df: DataFrame, id_col: str, messages: str = "messages", turns: str = "turns") -> DataFrame:
    """Inverse of :func:`assemble_conversations` and :func:`assemble_parts`: ``id, turn, role, text`` with the turn numbers as they were.

    Messages without ``turns`` are numbered from 0.
    """
    numbers = F.col(turns) if turns in df.columns else F.transform(messages, lambda m, i: i)
    pairs = df.select(id_col, F.explode(F.arrays_zip(numbers.alias("t"), F.col(messages).alias("m"))).alias("_p"))
    return pairs.select(id_col, F.col("_p.t").cast("bigint").alias("turn"), F.col("_p.m.role").alias("role"), F.col("_p.m.content").alias("text"))


def render_chat(
    messages: Column,
    bos: str = BOS,
    start: str = TURN_START,
    end: str = TURN_END,
    role_map: Mapping[str, str] | None = None,
    on_unknown: str = "drop",
    add_generation_prompt: bool = False,
    first_part: Column | None = None,
    last_part: Column | None = None,
) -> Column:
    """Messages to training text.

    For conversations in parts, ``first_part`` and ``last_part`` say which part carries the opening token and which the generation prompt,
    so that the parts' texts add up to the text of the whole.

    Only ``user`` and ``model`` turns are rendered. Other roles vanish (``on_unknown='drop'``,
    the fallback template's behaviour) unless ``role_map`` renames them first, or make the
    whole text null with ``on_unknown='null'``.
    """
    if on_unknown not in ("drop", "null"):
        raise ValueError("on_unknown must be 'drop' or 'null'")

    def named(m: Column) -> Column:
        role = m["role"]
        for source, target in (role_map or {}).items():
            role = F.when(m["role"] == source, target).otherwise(role)
        return role

    def rendered(m: Column) -> Column:
        role = named(m)
        turn = F.concat(F.lit(start), role, F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(f"{end}\n"))
        return F.when(role.isin("user", "model"), turn).otherwise("")

    def only(where: Column | None, token: str) -> Column:
        return F.lit(token) if where is None else F.when(where, token).otherwise("")

    text = F.concat(only(first_part, bos), F.array_join(F.transform(messages, rendered), ""))
    if add_generation_prompt:
        text = F.concat(text, only(last_part, f"{start}model\n"))
    if on_unknown == "null":
        known = F.forall(messages, lambda m: F.coalesce(named(m).isin("user", "model"), F.lit(False)))
        text = F.when(known, text)
    return text


def select_train_field(df: DataFrame, messages: str = "messages", **render: object) -> DataFrame:
    """The ``text`` column when there is one, else the rendered messages, as ``train_text``. Parts need :func:`with_ends` before."""
    if "is_first" in df.columns:
        render = {"first_part": F.col("is_first")} | render
    source = F.col("text") if "text" in df.columns else render_chat(F.col(messages), **render)
    return df.withColumn("train_text", source)


def format_instruct(text: Column, label: Column) -> Column:
    """Three-line instruct sample."""
    return F.concat(F.lit(INSTRUCT_HEAD), text, F.lit(INSTRUCT_ANSWER), label.cast("string"))


def format_review(text: Column, label: Column) -> Column:
    """Two-line review sample; label 1 is Positive, anything else Negative."""
    name = F.when(label == 1, "Positive").otherwise("Negative")
    return F.concat(F.lit(REVIEW_HEAD), text, F.lit(REVIEW_ANSWER), name)


def tokenize_rows(df: DataFrame, col: str, factory: Callable[[], Callable[[str], Sequence[str]]] | None = None) -> DataFrame:
    """Add ``tokens`` and ``n_tokens``.

    Whitespace tokens by default, in the JVM. ``factory`` plugs in a sub-word tokenizer: it
    is called once per task and the result is applied to Arrow batches.
    """
    if factory is None:
        tokens = words(F.col(col))
    else:
        @F.pandas_udf("array<string>")
        def plugged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenizer = factory()
            for batch in batches:
                yield batch.map(lambda t: list(tokenizer(t or "")))

        tokens = plugged(F.col(col))
    return df.withColumn("tokens", tokens).withColumn("n_tokens", F.size("tokens"))


def truncate_tokens(df: DataFrame, max_len: int = 1024) -> DataFrame:
    """Cut ``tokens`` on the right; ``n_cut`` counts what was lost, ``was_cut`` flags it."""
    cut = F.greatest(F.col("n_tokens") - max_len, F.lit(0))
    return (
        df.withColumn("n_cut", cut)
        .withColumn("was_cut", F.col("n_cut") > 0)
        .withColumn("tokens", F.slice("tokens", 1, max_len))
        .withColumn("n_tokens", F.least(F.col("n_tokens"), F.lit(max_len)))
    )


def length_report(df: DataFrame, by: Sequence[str], length: str = "n_tokens", max_len: int = 1024) -> DataFrame:
    """min / mean / p50 / p95 / p99 / max and the truncated share per group.

    A percentile is the smallest length that its share of the rows does not exceed. It is exact: lengths are counted on the map side,
    so a hot group is as large as the number of its different lengths.
    """
    kind = df.schema[length].dataType
    report = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(length).alias("min_len"), F.round(F.avg(length), 4).alias("mean_len"), F.max(length).alias("max_len"),
        *[ranked(length, share).cast(kind).alias(f"_p{share}") for share in (50, 95, 99)],
        F.round(F.avg((F.col(length) > max_len).cast("double")), 4).alias("cut_share"),
    )
    return report.select(
        *by, "n_rows", "min_len", "mean_len",
        F.col("_p50").alias("p50_len"), F.col("_p95").alias("p95_len"), F.col("_p99").alias("p99_len"),
        "max_len", "cut_share",
    )


def loss_mask(prompt_len: Column, target_len: Column) -> Column:
    """Zeros over the prompt, ones over the target."""
    return F.concat(F.array_repeat(F.lit(0), prompt_len), F.array_repeat(F.lit(1), target_len))


def masked_nll(df: DataFrame, logprobs: str, mask: str, by: Sequence[str] = ()) -> DataFrame:
    """Token-weighted negative log-likelihood per group: minus the masked sum over the mask total."""
    total = F.aggregate(F.zip_with(logprobs, mask, lambda p, m: p * m), F.lit(0.0), lambda acc, x: acc + x)
    weight = F.aggregate(mask, F.lit(0), lambda acc, x: acc + x).cast("bigint")
    summed = df.select(*by, total.alias("_t"), weight.alias("_w")).groupBy(*by)
    return summed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_w").alias("target_tokens"),
        F.round(F.try_divide(-F.sum("_t"), F.sum("_w").cast("double")), 4).alias("nll"),
    )


def pack_sequences(
    df: DataFrame, id_col: str, max_len: int, shard: Sequence[str] = (), tokens: str = "tokens"
) -> DataFrame:
    """Concatenate token rows in id order inside each shard and cut into blocks of ``max_len``.

    Offsets come from running totals over (shard, id, length) alone, so one huge shard is spread over many tasks and tokens cross
    the network once to meet their offset and once to meet their block. Ids are unique.
    Output: ``*shard, block, tokens``; a block never holds more than ``max_len`` tokens.
    """
    sized = df.select(*shard, id_col, F.size(tokens).cast("bigint").alias("_len")).filter("_len > 0")
    ended = running_total(sized, F.col("_len"), shard, [id_col], "_end").select(id_col, "_len", "_end")
    placed = df.select(*shard, id_col, tokens).join(ended, id_col).withColumn("_start", F.col("_end") - F.col("_len"))
    first_block = F.floor(F.col("_start") / max_len).cast("bigint")
    last_block = F.floor((F.col("_end") - 1) / max_len).cast("bigint")
    spread = placed.withColumn("block", F.explode(F.sequence(first_block, last_block)))
    lo = F.greatest(F.col("_start"), F.col("block") * max_len)
    hi = F.least(F.col("_end"), (F.col("block") + 1) * max_len)
    piece = F.slice(F.col(tokens), (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int"))
    pieces = spread.select(*shard, "block", F.struct(lo.alias("at"), piece.alias("piece")).alias("_p"))
    blocks = pieces.groupBy(*shard, "block").agg(F.sort_array(F.collect_list("_p")).alias("_ps"))
    return blocks.select(*shard, "block", F.flatten(F.transform("_ps", lambda p: p["piece"])).alias("tokens"))


def batch_plan(
    df: DataFrame, id_col: str, length: str = "n_tokens", batch_size: int = 4, accumulation: int = 4
) -> DataFrame:
    """Row to micro-batch and optimiser step, padding to the longest row of the micro-batch."""
    narrow = df.select(id_col, F.col(length).cast("bigint").alias("n_tokens"))
    ranked = running_total(narrow, F.lit(1), [], [id_col], "_rank")
    batched = ranked.withColumn("micro_batch", F.floor((F.col("_rank") - 1) / batch_size).cast("bigint"))
    members = Window.partitionBy("micro_batch")
    return batched.select(
        id_col, "micro_batch", F.floor(F.col("micro_batch") / accumulation).cast("bigint").alias("step"), "n_tokens",
        F.max("n_tokens").over(members).alias("pad_to"),
        (F.max("n_tokens").over(members) - F.col("n_tokens")).alias("padding"),
    )


def schedule(plan: DataFrame, epochs: int = 1, warmup_ratio: float = 0.03) -> DataFrame:
    """One line for a :func:`batch_plan`: ``n_rows``, ``micro_batches``, optimiser ``steps`` over all epochs and ``warmup_steps`` (rounded up)."""
    totals = plan.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.max("micro_batch") + 1, F.lit(0)).cast("bigint").alias("micro_batches"),
                      (F.coalesce(F.max("step") + 1, F.lit(0)) * epochs).cast("bigint").alias("steps"))
    return totals.withColumn("warmup_steps", F.ceil(F.col("steps") * F.lit(warmup_ratio)).cast("bigint"))
