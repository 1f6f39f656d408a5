"""Contract checks. Every check adds ``reasons``: the list of broken rules, empty when the row is fine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import strip
from chatloom.plans.positions import running_total

# Fixed values of the answer contracts.
TRIAGE_CATEGORIES = ["billing", "technical_support", "account_security", "refund_request"]
TRIAGE_PRIORITIES = ["critical", "high", "medium", "low"]
SENTIMENTS = ["Positive", "Negative", "Neutral"]
EMOTIONS = ["Positive", "Negative", "Sarcastic", "Frustrated"]
# Fixed defaults and ranges of a decoding request.
DECODE_DEFAULTS = {"max_new_tokens": 512, "temperature": 0.7, "top_p": 0.9, "top_k": 50, "repetition_penalty": 1.1}
DECODE_RANGES = {
    "max_new_tokens": (1, 4096), "temperature": (0.0, 2.0), "top_p": (0.0, 1.0), "top_k": (1, None), "repetition_penalty": (1.0, None),
}


def reasons(*rules: tuple[str, Column]) -> Column:
    """Names of the rules that do not hold; a rule that evaluates to null counts as broken."""
    flags = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    return F.filter(F.array(*flags), lambda r: r.isNotNull())


def blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def validate_messages(df: DataFrame, messages: str = "messages", roles: Sequence[str] = ("user", "model")) -> DataFrame:
    """Exactly the given roles in order, no null or blank content."""
    m = F.col(messages)
    wanted = F.array(*[F.lit(r) for r in roles])
    return df.withColumn("reasons", reasons(
        ("missing", m.isNotNull()),
        ("turn_count", F.size(m) == len(roles)),
        ("roles", F.transform(m, lambda x: x["role"]) == wanted),
        ("blank_content", ~F.exists(m, lambda x: blank(x["content"]))),
    ))


def validate_turns(df: DataFrame, conv: str, turn: str = "turn", role: str = "role", user: str = "user", answer: str = "assistant") -> DataFrame:
    """Optional leading system turn, then strict user / answer alternation, per conversation.

    Alternation is judged on the place of a turn in its conversation, in the order of turn numbers (which may have gaps and
    start anywhere), then roles; a repeated or missing number is reported as ``numbering``. Places come from running totals over bounded
    buckets of turn numbers, so a very long conversation is never sorted in one task; on places alternation
    is a statement about parities, which a combined aggregation decides.
    """
    known = df.select(conv, F.col(turn).cast("bigint").alias("_t"), F.col(role).alias("_r"))
    placed = running_total(known, F.lit(1), [conv], ["_t", "_r"], "_place")
    repeated = known.groupBy(conv, "_t").agg(F.count(F.lit(1)).alias("_n")).groupBy(conv).agg(
        F.max(F.when(F.col("_t").isNull(), 2).otherwise(F.col("_n"))).alias("_most"))
    t, r = F.col("_place") - 1, F.col("_r")

    def count(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    grouped = placed.groupBy(conv).agg(
        F.count(F.lit(1)).alias("n_turns"),
        count((r == "system") & (t == 0)).alias("_sys0"), count((r == "system") & (t != 0)).alias("_sys"),
        count(~F.coalesce(r.isin("system", user, answer), F.lit(False))).alias("_other"),
        count(((r == user) & (t % 2 != 0)) | ((r == answer) & (t % 2 == 0))).alias("_odd"),
        count(((r == user) & (t % 2 == 0)) | ((r == answer) & (t % 2 != 0))).alias("_even"),
    ).join(repeated, conv)
    in_step = F.when(F.col("_sys0") > 0, F.col("_even") == 0).otherwise(F.col("_odd") == 0)
    checked = grouped.withColumn("reasons", reasons(
        ("numbering", F.col("_most") == 1), ("unknown_role", F.col("_other") == 0), ("late_system", F.col("_sys") == 0),
        ("alternation", in_step), ("no_user_turn", F.col("n_turns") > F.col("_sys0")),
    ))
    return checked.select(conv, "n_turns", "reasons")


def validate_labels(df: DataFrame, label: str, domain: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Answer (stripped) belongs to the label set."""
    return df.withColumn("reasons", reasons(("label", strip(F.col(label)).isin(*domain))))


def is_json_object(c: Column) -> Column:
    """The whole text is one JSON object.

    Spark's JSON functions stop at the end of the first value and accept what follows. Wrapping
    the text as an array element and as an object member makes trailing garbage a syntax error.
    """
    text = strip(c)
    as_item = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    as_member = F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')), "$.end") == "1"
    strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "allowSingleQuotes": "false"}
    quoted = F.from_json(text, "bad string", strict)["bad"].isNull()
    return F.coalesce(F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")) & as_item & as_member & quoted, F.lit(False))


def json_kind(c: Column, path: str) -> Column:
    """Type name at a path: ``STRING``, ``BIGINT``, ``OBJECT<...>``; null when absent or not JSON."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(c), path, "variant"))


def validate_triage(df: DataFrame, col: str) -> DataFrame:
    """A JSON object with exactly ``category`` and ``priority``, both from their fixed sets."""
    c = F.col(col)
    keys = F.array_sort(F.json_object_keys(c))
    return df.withColumn("reasons", reasons(
        ("not_json", is_json_object(c)),
        ("keys", keys == F.array(F.lit("category"), F.lit("priority"))),
        ("category", (json_kind(c, "$.category") == "STRING") & F.get_json_object(c, "$.category").isin(*TRIAGE_CATEGORIES)),
        ("priority", (json_kind(c, "$.priority") == "STRING") & F.get_json_object(c, "$.priority").isin(*TRIAGE_PRIORITIES)),
    ))


def validate_api_payload(df: DataFrame, col: str) -> DataFrame:
    """A JSON object with a non-empty string ``action`` and an object ``params``."""
    c = F.col(col)
    return df.withColumn("reasons", reasons(
        ("not_json", is_json_object(c)),
        ("action", (json_kind(c, "$.action") == "STRING") & ~blank(F.get_json_object(c, "$.action"))),
        ("params", F.startswith(json_kind(c, "$.params"), F.lit("OBJECT"))),
    ))


def with_decode_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in DECODE_DEFAULTS.items()})


def validate_requests(df: DataFrame) -> DataFrame:
    """Fill defaults, then check ranges. Rows with reasons belong in quarantine."""
    filled = with_decode_defaults(df)
    rules = []
    for name, (low, high) in DECODE_RANGES.items():
        ok = F.col(name) >= low
        rules.append((name, ok if high is None else ok & (F.col(name) <= high)))
    return filled.withColumn("reasons", reasons(*rules))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) by ``reasons``."""
    return df.filter(F.size("reasons") == 0).drop("reasons"), df.filter(F.size("reasons") > 0)


def normalise_decode(df: DataFrame) -> DataFrame:
    """Temperature 0 means greedy decoding: the sampling options become null."""
    sampled = F.col("temperature") > 0
    return (
        with_decode_defaults(df)
        .withColumn("do_sample", sampled)
        .withColumn("top_p", F.when(sampled, F.col("top_p")))
        .withColumn("top_k", F.when(sampled, F.col("top_k")))
        .withColumn("temperature", F.when(sampled, F.col("temperature")))
    )
