"""Queries over readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.operators.prepare import assemble_conversations
from chatloom.plans.registry import query, table
from chatloom.session import scratch_dir
from chatloom.sources import datasets as S

_KEYED_SAMPLE = T.StructType([T.StructField("conv_id", T.LongType()), *S.CHAT_SAMPLE.fields])


@query("read_dataset", """
SELECT conv_id, count(*) AS n_messages, arg_min(role, turn) AS first_role, arg_max(text, turn) AS last_text
FROM conversations GROUP BY conv_id""")
def read_dataset(spark, sf_dir):
    path = scratch_dir(spark, "samples") + ".jsonl"
    samples = assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    S.write_jsonl(samples.select("conv_id", "messages"), path)
    back = S.read_dataset(spark, path, _KEYED_SAMPLE)
    return back.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"),
        F.col("messages")[0]["role"].alias("first_role"), F.element_at("messages", -1)["content"].alias("last_text"),
    )


@query("read_csv", """
SELECT doc_id, lang, text, true AS same_split FROM documents""")
def read_csv(spark, sf_dir):
    """Texts with quotes and line breaks through CSV; a column without them is also read split between tasks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path, narrow = scratch_dir(spark, "rows") + ".csv", scratch_dir(spark, "narrow") + ".csv"
    docs.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    docs.select("doc_id", "lang").write.csv(narrow, header=True)
    back = S.read_dataset(spark, path, docs.schema)
    ids = S.read_dataset(spark, narrow, docs.select("doc_id", "lang").schema, multi_line=False)
    met = back.join(ids.select("doc_id", F.col("lang").alias("_lang")), "doc_id")
    return met.select("doc_id", "lang", "text", F.col("lang").eqNullSafe(F.col("_lang")).alias("same_split"))


@query("write_jsonl", """
SELECT doc_id, lang, text, text AS ascii_text FROM documents""")
def write_jsonl(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    schema = "doc_id bigint, lang string, text string"
    raw, escaped = scratch_dir(spark, "raw") + ".jsonl", scratch_dir(spark, "ascii") + ".jsonl"
    S.write_jsonl(docs, raw)
    S.write_jsonl(docs, escaped, ascii=True)
    a = spark.read.schema(schema).json(raw)
    b = spark.read.schema(schema).json(escaped).select("doc_id", F.col("text").alias("ascii_text"))
    return a.join(b, "doc_id")


@query("read_split", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 100""")
def read_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return S.read_split(docs, "en[:100]", "doc_id", split_col="lang")


@query("read_request_log", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS max_new_tokens, false AS is_corrupt
FROM events""")
def read_request_log(spark, sf_dir):
    bodies = table(spark, sf_dir, "events").select("event_id", F.regexp_replace("props", '"k"', '"max_new_tokens"').alias("body"))
    parsed = S.parse_requests(bodies, "body")
    return parsed.select("event_id", "max_new_tokens", F.col("corrupt").isNotNull().alias("is_corrupt"))


@query("read_notebooks", """
SELECT page_id, 1 AS cell, html || chr(10) AS source FROM pages UNION ALL SELECT page_id, 2, '["a"]' || html FROM pages""")
def read_notebooks(spark, sf_dir):
    """Each page as one notebook document: a prose cell, a code cell in two source lines, a code cell whose source is one string."""
    def cell(kind: str, source):
        return F.to_json(F.struct(F.lit(kind).alias("cell_type"), source.alias("source")))

    cells = F.concat_ws(",", cell("markdown", F.array(F.lit("notes"))), cell("code", F.array("html", F.lit("\n"))), cell("code", F.concat(F.lit('["a"]'), "html")))
    books = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit('{"cells":['), cells, F.lit("]}")).alias("doc"))
    return S.notebook_cells(books, ["page_id"], "doc")


@query("assemble_chapters", """
SELECT d.doc_id // 8 AS book, count(*) AS members, string_agg(d.text, chr(10) || chr(10) ORDER BY 7 - d.doc_id % 8) AS text
FROM documents d JOIN labels USING (doc_id) GROUP BY 1""")
def assemble_chapters(spark, sf_dir):
    """Books of eight documents in reverse order; only labelled documents have a body."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bodies = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    order = docs.select(
        "doc_id", F.floor(F.col("doc_id") / 8).cast("bigint").alias("book"), (7 - F.col("doc_id") % 8).alias("pos")
    )
    return S.assemble_chapters(bodies, order, "doc_id", "text", "book", "pos", part_size=3)


@query("missing_members", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def missing_members(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return S.missing_members(docs, table(spark, sf_dir, "labels"), ["doc_id"])


_RULES = [
    ("script", ["<script>", "</script>"], []),
    ("navigation", [], ["<nav>", "<ul>"]),
    ("footer", ["<footer>"], ["copyright", "<p>"]),
]


@query("audit_patterns", """
SELECT page_id, concat_ws(',', CASE WHEN NOT s THEN 'script' END, CASE WHEN NOT n THEN 'navigation' END, CASE WHEN NOT f THEN 'footer' END) AS failures,
       s AND n AND f AS passed
FROM (SELECT page_id, contains(html, '<script>') AND contains(html, '</script>') AS s,
             contains(html, '<nav>') OR contains(html, '<ul>') AS n,
             contains(html, '<footer>') AND (contains(html, 'copyright') OR contains(html, '<p>')) AS f FROM pages)""")
def audit_patterns(spark, sf_dir):
    audited = S.audit_patterns(table(spark, sf_dir, "pages"), "html", _RULES)
    return audited.select("page_id", F.array_join("failures", ",").alias("failures"), "passed")
