"""Deterministic views that stand in for inputs the test tables do not hold.

Each view exists twice: as a DataFrame and as the SQL text the checks use. Every view is
linear in its table and needs no window over an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.seeded import digest32
from chatloom.plans.registry import sql_draw, table, texts

H = sql_draw


def h(*parts: Column | str) -> Column:
    """Draw over ``a:b:c``."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return digest32(F.concat_ws(":", *columns))


# --- pairs of texts -------------------------------------------------------------------

TURN_PAIRS = """turn_pairs AS (
  SELECT u.conv_id * 1000 + u.turn AS id, a.text AS prediction, u.text AS reference
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it; the join key is nearly unique."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    said = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prediction"))
    pairs = asked.join(said, ["conv_id", "turn"])
    return pairs.select((F.col("conv_id") * 1000 + F.col("turn") - 1).alias("id"), "prediction", "reference")


EDIT_PAIRS = """edit_pairs AS (
  SELECT doc_id AS id, text AS reference,
         array_to_string(list_transform(string_split(text, ' '), lambda w, i: CASE WHEN i % 5 = 3 THEN 'Zz' ELSE w END), ' ') AS prediction
  FROM documents)"""


def edit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document against a copy whose every fifth word is overwritten."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    edited = F.transform(F.split("text", " "), lambda w, i: F.when(i % 5 == 2, F.lit("Zz")).otherwise(w))
    return docs.select(F.col("doc_id").alias("id"), F.array_join(edited, " ").alias("prediction"), F.col("text").alias("reference"))


# --- labels and predictions -----------------------------------------------------------

GOLD_PRED = f"""gold_pred AS (
  SELECT d.doc_id AS id, d.lang AS category, d.source, d.n_chars, l.quality::VARCHAR AS expected,
         CASE WHEN {H("d.doc_id::VARCHAR")} % 20 = 0 THEN NULL WHEN d.n_chars >= 1000 THEN '1' ELSE '0' END AS predicted
  FROM documents d JOIN labels l USING (doc_id))"""

GOLD_PRED_B = """gold_pred_b AS (
  SELECT d.doc_id AS id, d.lang AS category, l.quality::VARCHAR AS expected,
         CASE WHEN d.n_chars >= 2000 THEN '1' ELSE '0' END AS predicted
  FROM documents d JOIN labels l USING (doc_id))"""


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id")
    return joined.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("category"), "source", "n_chars",
        F.col("quality").cast("string").alias("expected"), "toxic",
    )


def gold_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.when(F.col("n_chars") >= 1000, "1").otherwise("0")
    return gold(spark, sf_dir).withColumn("predicted", F.when(h(F.col("id")) % 20 == 0, None).otherwise(rule))


def gold_pred_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(spark, sf_dir).withColumn("predicted", F.when(F.col("n_chars") >= 2000, "1").otherwise("0"))


# --- request logs ---------------------------------------------------------------------

REQUEST_LOG = """request_log AS (
  SELECT event_id AS id, ts, user_id AS client, event_type AS kind, value AS seconds,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status
  FROM events)"""


def request_log_columns(events: DataFrame) -> DataFrame:
    """Events read as a request log; works on batch and streaming frames."""
    return events.select(
        F.col("event_id").alias("id"), "ts", F.col("user_id").alias("client"), F.col("event_type").alias("kind"),
        F.col("value").alias("seconds"), F.get_json_object("props", "$.k").cast("bigint").alias("tokens"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log_columns(table(spark, sf_dir, "events"))


DECODE_REQUESTS = """decode_requests AS (
  SELECT l_orderkey AS orderkey, l_linenumber AS line, l_partkey AS part,
         CAST(l_quantity * 100 AS INTEGER) AS max_new_tokens,
         round(l_discount * 25 + 0.0, 4) AS temperature, round(l_tax * 15 + 0.0, 4) AS top_p,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_linenumber - 1 AS INTEGER) END AS top_k,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE round(l_quantity / 10, 4) END AS repetition_penalty
  FROM lineitem)"""


def decode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        (F.col("l_quantity") * 100).cast("int").alias("max_new_tokens"),
        F.round(F.col("l_discount") * 25 + 0.0, 4).alias("temperature"),
        F.round(F.col("l_tax") * 15 + 0.0, 4).alias("top_p"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_linenumber") - 1).cast("int").alias("top_k"),
        F.when(F.col("l_orderkey") % 5 != 0, F.round(F.col("l_quantity") / 10, 4)).alias("repetition_penalty"),
    )


# --- structured answers ---------------------------------------------------------------

TRIAGE_ROWS = f"""triage_rows AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 50 = 0 THEN left(js, length(js) - 3) ELSE js END AS content
  FROM (SELECT o_orderkey, '{{"category": "' || ['billing','technical_support','account_security','refund_request','other'][{H("o_orderkey::VARCHAR")} % 5 + 1]
        || '", "priority": "' || CASE left(o_orderpriority, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '5' THEN 'low' ELSE 'unspecified' END || '"}}' AS js
        FROM orders))"""


def triage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = texts(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    names = F.array(*[F.lit(n) for n in ("billing", "technical_support", "account_security", "refund_request", "other")])
    digit = F.substring("o_orderpriority", 1, 1)
    priority = F.when(digit == "1", "critical").when(digit == "2", "high").when(digit == "3", "medium").when(digit == "5", "low").otherwise("unspecified")
    text = F.concat(
        F.lit('{"category": "'), F.get(names, (h(F.col("o_orderkey")) % 5).cast("int")),
        F.lit('", "priority": "'), priority, F.lit('"}'),
    )
    shown = orders.withColumn("js", text)
    cut = F.when(F.col("o_orderkey") % 50 == 0, F.expr("left(js, length(js) - 3)")).otherwise(F.col("js"))
    return shown.select(F.col("o_orderkey").alias("id"), cut.alias("content"))


API_ROWS = """api_rows AS (
  SELECT event_id AS id, '{"action": "' || CASE WHEN event_type = 'error' THEN '' ELSE event_type END || '", "params": '
         || CASE WHEN event_id % 40 = 0 THEN '7' ELSE props END || '}' AS content
  FROM events)"""


def api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = texts(spark, sf_dir, "events", "event_id", "event_type", "props")
    text = F.concat(
        F.lit('{"action": "'), F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")),
        F.lit('", "params": '), F.when(F.col("event_id") % 40 == 0, "7").otherwise(F.col("props")), F.lit("}"),
    )
    return events.select(F.col("event_id").alias("id"), text.alias("content"))


OPTION_ROWS = f"""option_rows AS (
  SELECT p_partkey AS item, p_brand AS subject, ['A','B','C','D'][p_size % 4 + 1] AS gold,
    CASE WHEN {H("'o:' || p_partkey::VARCHAR")} % 9 = 0 THEN 'I cannot tell'
         WHEN p_partkey % 2 = 0 THEN letter ELSE 'So the answer is ' || letter || '.' END AS output
  FROM (SELECT *, ['A','B','C','D'][CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size % 4 END + 1] AS letter FROM part))"""


def option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    letters = F.array(*[F.lit(x) for x in "ABCD"])
    index = (F.col("p_size") % 4).cast("int")
    letter = F.get(letters, F.when(F.col("p_partkey") % 3 == 0, 0).otherwise(index))
    output = (
        F.when(h("o", F.col("p_partkey")) % 9 == 0, "I cannot tell")
        .when(F.col("p_partkey") % 2 == 0, letter)
        .otherwise(F.concat(F.lit("So the answer is "), letter, F.lit(".")))
    )
    return part.select(
        F.col("p_partkey").alias("item"), F.col("p_brand").alias("subject"),
        F.get(letters, index).alias("gold"), output.alias("output"),
    )


MATH_ROWS = f"""math_rows AS (
  SELECT l_orderkey * 10 + l_linenumber AS item, l_returnflag AS subject, CAST(CAST(l_quantity * 100 AS INTEGER) AS VARCHAR) AS gold,
    CASE {H("l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR")} % 5
      WHEN 0 THEN 'Counting gives #### ' || CAST(CAST(l_quantity * 100 AS INTEGER) AS VARCHAR)
      WHEN 1 THEN 'Counting gives' || chr(10) || '#### ' || CAST(CAST(l_quantity * 100 AS INTEGER) AS VARCHAR) || '.0'
      WHEN 2 THEN 'Counting gives #### many'
      WHEN 3 THEN 'Counting gives ' || CAST(CAST(l_quantity * 100 AS INTEGER) AS VARCHAR)
      ELSE 'Counting gives #### ' || CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) || ',00' END AS output
  FROM lineitem)"""


def math_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = texts(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    number = (F.col("l_quantity") * 100).cast("int").cast("string")
    kind = h(F.col("l_orderkey"), F.col("l_linenumber")) % 5
    output = (
        F.when(kind == 0, F.concat(F.lit("Counting gives #### "), number))
        .when(kind == 1, F.concat(F.lit("Counting gives\n#### "), number, F.lit(".0")))
        .when(kind == 2, "Counting gives #### many")
        .when(kind == 3, F.concat(F.lit("Counting gives "), number))
        .otherwise(F.concat(F.lit("Counting gives #### "), F.floor("l_quantity").cast("int").cast("string"), F.lit(",00")))
    )
    return items.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"), F.col("l_returnflag").alias("subject"),
        number.alias("gold"), output.alias("output"),
    )


# --- code attempts, judge verdicts and scores -----------------------------------------

ATTEMPTS = """attempts AS (
  SELECT user_id::VARCHAR || '/' || (date_diff('day', TIMESTAMP '1970-01-01', date_trunc('day', ts)) // 7)::VARCHAR AS problem,
         event_type = 'purchase' AS passed
  FROM events)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")) / 7)
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), week.cast("string")).alias("problem"),
        (F.col("event_type") == "purchase").alias("passed"),
    )


# Two consecutive documents of different sources meet twice, once in each slot order. The
# longer one wins, except that every fifth meeting goes to whoever sits in the first slot.
VERDICTS = f"""pairs AS (
  SELECT x.doc_id AS item, x.source AS a, y.source AS b, x.n_chars AS a_len, y.n_chars AS b_len
  FROM documents x JOIN documents y ON y.doc_id = x.doc_id + 1 WHERE x.source <> y.source),
verdicts AS (
  SELECT item, a, b, slot AS first_slot, a_len, b_len,
    CASE WHEN {H("item::VARCHAR")} % 5 = 0 THEN CASE WHEN slot = 'a' THEN a ELSE b END
         WHEN a_len = b_len THEN 'tie'
         WHEN a_len > b_len THEN a ELSE b END AS winner,
    ({H("item::VARCHAR || ':' || slot")} % 1000) / 1000.0::DOUBLE AS p_a
  FROM pairs, (VALUES ('a'), ('b')) s(slot))"""


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    x = docs.select(F.col("doc_id").alias("item"), F.col("source").alias("a"), F.col("n_chars").alias("a_len"))
    y = docs.select((F.col("doc_id") - 1).alias("item"), F.col("source").alias("b"), F.col("n_chars").alias("b_len"))
    met = x.join(y, "item").filter("a <> b")
    both = met.withColumn("first_slot", F.explode(F.array(F.lit("a"), F.lit("b"))))
    winner = (
        F.when(h(F.col("item")) % 5 == 0, F.when(F.col("first_slot") == "a", F.col("a")).otherwise(F.col("b")))
        .when(F.col("a_len") == F.col("b_len"), "tie")
        .when(F.col("a_len") > F.col("b_len"), F.col("a"))
        .otherwise(F.col("b"))
    )
    p_a = (h(F.col("item"), F.col("first_slot")) % 1000) / 1000.0
    return both.withColumn("winner", winner).withColumn("p_a", p_a)


JUDGE_SCORES = f"""judge_scores AS (
  SELECT doc_id AS item, source AS model, judge, CASE judge WHEN 'j0' THEN 'f0' WHEN 'j1' THEN 'f1' ELSE 'f2' END AS judge_family,
    'f' || ({H("source")} % 3)::VARCHAR AS model_family, CAST(1 + {H("doc_id::VARCHAR || ':' || judge")} % 5 AS DOUBLE) AS score
  FROM documents, (VALUES ('j0'), ('j1'), ('j2')) j(judge))"""


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    seen = docs.withColumn("judge", F.explode(F.array(F.lit("j0"), F.lit("j1"), F.lit("j2"))))
    return seen.select(
        F.col("doc_id").alias("item"), F.col("source").alias("model"), "judge",
        F.concat(F.lit("f"), F.substring("judge", 2, 1)).alias("judge_family"),
        F.concat(F.lit("f"), (h(F.col("source")) % 3).cast("string")).alias("model_family"),
        (1 + h(F.col("doc_id"), F.col("judge")) % 5).cast("double").alias("score"),
    )


SCORE_LOGPROBS = f"""score_logprobs AS (
  SELECT doc_id AS item, aspect, i AS score, -(1 + {H("doc_id::VARCHAR || ':' || aspect || ':' || i::VARCHAR")} % 500) / 100.0::DOUBLE AS logprob
  FROM documents, (VALUES ('clarity'), ('accuracy')) a(aspect), (VALUES (1), (2), (3), (4), (5)) s(i))"""


def score_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    rated = docs.withColumn("aspect", F.explode(F.array(F.lit("clarity"), F.lit("accuracy"))))
    logprob = [(-(1 + h(F.col("doc_id"), F.col("aspect"), str(i)) % 500) / 100.0) for i in range(1, 6)]
    entries = F.map_from_arrays(F.array(*[F.lit(i) for i in range(1, 6)]), F.array(*logprob))
    return rated.select(F.col("doc_id").alias("item"), "aspect", entries.alias("logprobs"))


CONFIDENCE = GOLD_PRED + f""",
confidence AS (
  SELECT id, category, ({H("id::VARCHAR || ':c'")} % 1000) / 1000.0::DOUBLE AS conf,
         coalesce(expected = predicted, false) AS correct
  FROM gold_pred)"""


def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_pred(spark, sf_dir).select(
        "id", "category", ((h(F.col("id"), "c") % 1000) / 1000.0).alias("conf"),
        F.coalesce(F.col("expected") == F.col("predicted"), F.lit(False)).alias("correct"),
    )


ATTRIBUTES = ["toxicity", "severe_toxicity", "insult", "profanity"]

SAFETY_SCORES = f"""safety_scores AS (
  SELECT d.doc_id AS id, d.lang, l.toxic, attribute, ({H("d.doc_id::VARCHAR || ':' || attribute")} % 1000) / 1000.0::DOUBLE AS score
  FROM documents d JOIN labels l USING (doc_id), (VALUES ('toxicity'), ('severe_toxicity'), ('insult'), ('profanity')) a(attribute))"""


def safety_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per text with its attribute scores in a map."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    values = F.array(*[(h(F.col("doc_id"), a) % 1000) / 1000.0 for a in ATTRIBUTES])
    scores = F.map_from_arrays(F.array(*[F.lit(a) for a in ATTRIBUTES]), values)
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("id"), "lang", "toxic", scores.alias("scores"))
