"""From documents to packed training sequences.

Each stage takes the documents that its predecessor kept and returns documents, the last one packed pieces. A document is told
by its ``doc_id``; stages drop or repeat whole rows and never change a text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import SPACES, fold
from chatloom.llm.exact import exact_groups
from chatloom.llm.mixing import mix_sources, row_key
from chatloom.llm.packing import pack_documents
from chatloom.llm.resemblance import resembling
from chatloom.llm.toxicity import toxicity
from chatloom.plans.positions import first_by
from chatloom.session import scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``node``, a number that equal rows of id and text share and no others: one more hash is taken until a count finds no clash."""
    seed = 0
    while True:
        out = docs.withColumn("node", F.xxhash64(F.lit(seed), "doc_id", F.col("doc_id").isNull(), "text"))
        held = out.groupBy("node").agg(F.count_distinct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("n"))
        if held.filter("n > 1").isEmpty():
            return out
        seed += 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic.

    Every row is judged by its own text, also without id or with an id that other texts share; a label counts for all texts of its id, and labels of the fold
    that the operator holds out are not learned. Repeated rows go or stay together. A null text is judged as empty. Without labels nothing goes; an empty
    table gives an empty result, and other columns than those of ``documents`` are left behind.
    """
    rows = numbered(docs)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0).select("doc_id", "toxic")
    labels = rows.select("doc_id", "node").distinct().join(known, "doc_id").select(F.col("node").alias("doc_id"), "toxic")
    judged = toxicity(rows.select(F.col("node").alias("doc_id"), "text"), labels, folds=1, held_out=1)
    rejected = judged.filter("predicted = 1").select(F.col("doc_id").alias("node")).distinct()
    return rows.join(rejected, "node", "left_anti").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of the documents with equal normalised texts, by original length, then by id (an id before none).

    A null text counts as empty. Rows that repeat an id and a normalised text are one document: the longest of them stays, then any of the equal
    ones. An empty table gives an empty result.
    """
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"))
    named = docs.withColumn("_own", F.sha2(F.translate(F.coalesce("text", F.lit("")), SPACES, ""), 256))
    found = named.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
    # rows that repeat an id and a text are one document
    return first_by(found, ["doc_id", "_own"], [F.length("text").desc_nulls_last()]).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles have a Jaccard of 0.8 or more: the one with the smallest id.

    SimHash over the same shingles retrieves links, which are verified; an exact search adds those that it misses. A document is its id and text, so rows without id and rows that repeat an id are judged on their own; an id comes before no id. Rows that repeat
    both stay or go together. Blank and null texts resemble nothing. An empty table gives an empty result.
    """
    rows = numbered(docs)
    texts = rows.select("node", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    told = rows.select("node", "doc_id").join(resembling(texts), "node")
    first = told.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("first"))
    return rows.join(first.select(F.col("first.node").alias("node")), "node", "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or several times.

    Documents without words are never taken. A row is known by its id, text and source, so rows without id are taken each by itself; repeated rows are taken equally
    often. A null source is a source. An empty table gives an empty result.
    """
    taken = mix_sources(docs).filter("copies > 0").groupBy(F.col("key").alias("_key"), F.col("source").alias("_s")).agg(F.max("copies").alias("_n"))
    rows = docs.select(*COLUMNS).withColumn("_own", row_key())
    met = rows.join(taken, (F.col("_own") == F.col("_key")) & F.col("source").eqNullSafe(F.col("_s")))
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place. Every row is packed, repeated ones too; null and empty texts give one piece, the end token."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages train a model, link components and draw at random; tests hold them against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each writes its result into the shared scratch folder and the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
