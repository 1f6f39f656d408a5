"""Queries over training-row preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import prepare as P
from chatloom.plans import views as V
from chatloom.plans.registry import query, table, texts

_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"


@query("build_messages", f"""
WITH {V.TURN_PAIRS}
SELECT id, 'user>' || reference || chr(10) || 'model>' || prediction AS flat, CAST(2 AS INTEGER) AS n FROM turn_pairs""")
def build_messages(spark, sf_dir):
    pairs = V.turn_pairs(spark, sf_dir)
    built = pairs.select("id", P.build_messages(F.col("reference"), F.col("prediction")).alias("m"))
    flat = F.array_join(F.transform("m", lambda x: F.concat_ws(">", x["role"], x["content"])), "\n")
    return built.select("id", flat.alias("flat"), F.size("m").alias("n"))


@query("assemble_conversations", """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n, string_agg(role || '>' || text, chr(10) ORDER BY turn) AS flat
FROM conversations GROUP BY conv_id""")
def assemble_conversations(spark, sf_dir):
    made = P.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    flat = F.array_join(F.transform("messages", lambda x: F.concat_ws(">", x["role"], x["content"])), "\n")
    return made.select("conv_id", F.size("messages").alias("n"), flat.alias("flat"))


@query("explode_turns", "SELECT conv_id, turn * 3 + conv_id % 50 AS turn, role, text FROM conversations")
def explode_turns(spark, sf_dir):
    """Turn numbers with gaps and other starts come back as they were."""
    turns = table(spark, sf_dir, "conversations").withColumn("turn", F.col("turn") * 3 + F.col("conv_id") % 50)
    return P.explode_turns(P.assemble_conversations(turns, "conv_id", "turn", part_turns=4), "conv_id")


@query("render_chat", """
SELECT conv_id,
  '<bos>' || coalesce(string_agg('<start_of_turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || text || '<end_of_turn>' || chr(10), '' ORDER BY turn)
                      FILTER (role IN ('user', 'assistant')), '') || '<start_of_turn>model' || chr(10) AS mapped,
  '<bos>' || coalesce(string_agg('<start_of_turn>user' || chr(10) || text || '<end_of_turn>' || chr(10), '' ORDER BY turn) FILTER (role = 'user'), '') AS unmapped
FROM conversations GROUP BY conv_id""")
def render_chat(spark, sf_dir):
    """With the serving role mapped to ``model``, and without: unknown roles disappear."""
    made = P.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    mapped = P.render_chat(F.col("messages"), role_map={"assistant": "model"}, add_generation_prompt=True)
    return made.select("conv_id", mapped.alias("mapped"), P.render_chat(F.col("messages")).alias("unmapped"))


@query("select_train_field", """
SELECT 'd' || doc_id::VARCHAR AS id, text AS train_text FROM documents
UNION ALL
SELECT 'c' || conv_id::VARCHAR, '<bos>' || string_agg('<start_of_turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || text || '<end_of_turn>' || chr(10), '' ORDER BY turn)
                      FILTER (role IN ('user', 'assistant')) FROM conversations GROUP BY conv_id""")
def select_train_field(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    chats = P.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    chats = chats.select(F.concat(F.lit("c"), "conv_id").alias("id"), "messages")
    a = P.select_train_field(docs).select("id", "train_text")
    return a.unionByName(P.select_train_field(chats, role_map={"assistant": "model"}).select("id", "train_text"))


@query("format_instruct", """
SELECT doc_id, 'Instruct: Classify the sentiment.' || chr(10) || 'Input: ' || text || chr(10) || 'Output: ' || quality::VARCHAR AS sample
FROM documents JOIN labels USING (doc_id)""")
def format_instruct(spark, sf_dir):
    joined = texts(spark, sf_dir, "documents", "doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id")
    return joined.select("doc_id", P.format_instruct(F.col("text"), F.col("quality")).alias("sample"))


@query("format_review", """
SELECT doc_id, 'Review: ' || text || chr(10) || 'Sentiment: ' || CASE WHEN quality = 1 THEN 'Positive' ELSE 'Negative' END AS sample
FROM documents JOIN labels USING (doc_id)""")
def format_review(spark, sf_dir):
    joined = texts(spark, sf_dir, "documents", "doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id")
    return joined.select("doc_id", P.format_review(F.col("text"), F.col("quality")).alias("sample"))


@query("tokenize_rows", f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, w[1] AS first_token, w[-1] AS last_token, array_to_string(w, ' ') AS joined
FROM (SELECT doc_id, {_WORDS} AS w FROM documents)""")
def tokenize_rows(spark, sf_dir):
    rows = P.tokenize_rows(texts(spark, sf_dir, "documents", "doc_id", "text"), "text")
    return rows.select(
        "doc_id", "n_tokens", F.get("tokens", F.lit(0)).alias("first_token"),
        F.try_element_at("tokens", F.lit(-1)).alias("last_token"), F.array_join("tokens", " ").alias("joined"),
    )


@query("truncate_tokens", f"""
SELECT doc_id, CAST(least(len(w), 512) AS INTEGER) AS n_tokens, CAST(greatest(len(w) - 512, 0) AS INTEGER) AS n_cut, len(w) > 512 AS was_cut,
       array_to_string(w[1:512], ' ') AS kept
FROM (SELECT doc_id, {_WORDS} AS w FROM documents)""")
def truncate_tokens(spark, sf_dir):
    rows = P.tokenize_rows(texts(spark, sf_dir, "documents", "doc_id", "text"), "text")
    cut = P.truncate_tokens(rows, 512)
    return cut.select("doc_id", "n_tokens", "n_cut", "was_cut", F.array_join("tokens", " ").alias("kept"))


@query("length_report", f"""
WITH t AS (SELECT lang, CAST(len({_WORDS}) AS INTEGER) AS n FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n) AS rn, count(*) OVER (PARTITION BY lang) AS c FROM t)
SELECT lang, count(*) AS n_rows, min(n) AS min_len, round(avg(n), 4) AS mean_len,
  min(n) FILTER (rn >= 0.5 * c) AS p50_len, min(n) FILTER (rn >= 0.95 * c) AS p95_len, min(n) FILTER (rn >= 0.99 * c) AS p99_len,
  max(n) AS max_len, round(avg(CASE WHEN n > 1024 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS cut_share
FROM r GROUP BY lang""")
def length_report(spark, sf_dir):
    rows = texts(spark, sf_dir, "documents", "doc_id", "lang", "text").select("lang", F.size(P.words(F.col("text"))).alias("n_tokens"))
    return P.length_report(rows, ["lang"])


@query("loss_mask", f"""
WITH {V.TURN_PAIRS}, n AS (
  SELECT id, len(list_filter(regexp_split_to_array(reference, '\\s+'), lambda x: x <> '')) AS m,
         len(list_filter(regexp_split_to_array(prediction, '\\s+'), lambda x: x <> '')) AS t FROM turn_pairs)
SELECT id, repeat('0', m) || repeat('1', t) AS mask, CAST(t AS INTEGER) AS target_tokens FROM n""")
def loss_mask(spark, sf_dir):
    pairs = V.turn_pairs(spark, sf_dir)
    sized = pairs.select("id", F.size(P.words(F.col("reference"))).alias("m"), F.size(P.words(F.col("prediction"))).alias("t"))
    return sized.select("id", F.array_join(P.loss_mask(F.col("m"), F.col("t")), "").alias("mask"), F.col("t").alias("target_tokens"))


@query("masked_nll", """
WITH t AS (SELECT label, 16 + vec_id % 32 AS m, list_transform(embedding, lambda x: -abs(x)::DOUBLE * 10) AS lp FROM embeddings)
SELECT label, count(*) AS n_rows, CAST(sum(64 - m) AS BIGINT) AS target_tokens,
       round(-sum(list_sum(lp[m + 1:])) / sum(64 - m), 4) AS nll
FROM t GROUP BY label""")
def masked_nll(spark, sf_dir):
    """Embedding values stand in for token log-probabilities."""
    vectors = table(spark, sf_dir, "embeddings")
    logprobs = F.transform("embedding", lambda x: -F.abs(x).cast("double") * 10)
    m = (16 + F.col("vec_id") % 32).cast("int")
    rows = vectors.select("label", logprobs.alias("lp"), P.loss_mask(m, F.size("embedding") - m).alias("mask"))
    return P.masked_nll(rows, "lp", "mask", ["label"])


@query("pack_sequences", f"""
WITH t AS (SELECT doc_id, source, {_WORDS} AS w FROM documents),
u AS (SELECT source, doc_id, unnest(w) AS tok, unnest(range(len(w))) AS i FROM t),
p AS (SELECT source, tok, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS o FROM u)
SELECT source, o // 1024 AS block, CAST(count(*) AS INTEGER) AS n_tokens, string_agg(tok, ' ' ORDER BY o) AS packed
FROM p GROUP BY 1, 2""")
def pack_sequences(spark, sf_dir):
    rows = texts(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", "source", P.words(F.col("text")).alias("tokens"))
    packed = P.pack_sequences(rows, "doc_id", 1024, ["source"])
    return packed.select("source", "block", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("packed"))


@query("batch_plan", f"""
WITH t AS (SELECT doc_id, len({_WORDS}) AS n_tokens, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents),
b AS (SELECT *, r // 4 AS micro_batch, max(n_tokens) OVER (PARTITION BY r // 4) AS pad_to FROM t)
SELECT doc_id, micro_batch, micro_batch // 4 AS step, n_tokens, pad_to, pad_to - n_tokens AS padding FROM b""")
def batch_plan(spark, sf_dir):
    rows = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.size(P.words(F.col("text"))).alias("n_tokens"))
    return P.batch_plan(rows, "doc_id")


@query("train_schedule", """
SELECT count(*) AS n_rows, CAST(ceil(count(*) / 4.0) AS BIGINT) AS micro_batches, CAST(ceil(count(*) / 16.0) * 3 AS BIGINT) AS steps,
       CAST(ceil(ceil(count(*) / 16.0) * 3 * 0.03) AS BIGINT) AS warmup_steps FROM documents""")
def train_schedule(spark, sf_dir):
    """Three epochs over the batch plan of all documents."""
    return P.schedule(batch_plan(spark, sf_dir), epochs=3)
