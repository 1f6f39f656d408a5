"""Dataset readers and writers. Every URI goes through Spark's file systems."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.plans.positions import with_places

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CHAT_SAMPLE = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])
TEXT_SAMPLE = T.StructType([T.StructField("text", T.StringType())])
LABELLED_TEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])

_DECODE = [
    T.StructField("max_new_tokens", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("top_p", T.DoubleType()),
    T.StructField("top_k", T.IntegerType()),
    T.StructField("repetition_penalty", T.DoubleType()),
]
GENERATE_REQUEST = T.StructType([T.StructField("prompt", T.StringType()), *_DECODE])
CHAT_REQUEST = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), *_DECODE])

def _notebook(source: T.DataType) -> T.StructType:
    cell = T.StructType([T.StructField("cell_type", T.StringType()), T.StructField("source", source)])
    return T.StructType([T.StructField("cells", T.ArrayType(cell))])


def read_dataset(spark: SparkSession, uri: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """JSON lines for ``.json``/``.jsonl``, CSV with header for ``.csv``; anything else is refused.

    Quoted CSV values may hold line breaks; where they do not, ``multi_line=False`` lets Spark split a file between tasks.
    Pass a schema on large inputs: without one, JSON needs an extra pass to infer it and
    CSV columns stay strings.
    """
    if uri.endswith((".json", ".jsonl")):
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.json(uri)
    if uri.endswith(".csv"):
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.csv(uri, header=True, multiLine=multi_line, escape='"')
    raise ValueError(f"unsupported dataset format: {uri} (expected .json, .jsonl or .csv)")


def read_split(
    df: DataFrame, split: str, order_by: str, split_col: str | None = None
) -> DataFrame:
    """``train`` or ``train[a:b]``: rows a..b-1 of the split in ``order_by`` order.

    Spark keeps no file order, so an order column with unique values is required, of any orderable type. Slices of every length
    are cut from places in a range-partitioned sort, so none is pulled into one task.
    """
    match = re.fullmatch(r"(\w+)(?:\[(\d*):(\d*)\])?", split)
    if not match:
        raise ValueError(f"bad split: {split}")
    name, start, stop = match.groups()
    rows = df.filter(F.col(split_col) == name) if split_col else df
    first = int(start) if start else 0
    if not first and not stop:
        return rows
    wanted = F.col("_place") >= first
    if stop:
        wanted = wanted & (F.col("_place") < int(stop))
    return with_places(rows, [order_by], "_place").filter(wanted).drop("_place")


def write_jsonl(df: DataFrame, path: str, ascii: bool = False, mode: str = "errorifexists") -> None:
    """One object per line, nulls kept. Non-ASCII text stays raw unless ``ascii`` is set."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if ascii:
        writer = writer.option("writeNonAsciiCharacterAsCodePoint", "true")
    writer.json(path)


def parse_requests(df: DataFrame, col: str, schema: T.StructType = GENERATE_REQUEST) -> DataFrame:
    """Raw JSON bodies to typed columns plus ``corrupt``: the body when it is not valid JSON."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_r", F.from_json(F.col(col), wide, options))
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields]
    kept = [c for c in df.columns if c not in schema.fieldNames()]
    return parsed.select(*kept, *fields, F.col("_r._corrupt").alias("corrupt"))


def notebook_cells(df: DataFrame, keep: Sequence[str], col: str) -> DataFrame:
    """Code cells of notebook documents held in a JSON text column: ``*keep, cell, source``.

    The format allows a cell's source as a list of lines or as one string; each is read by the schema that fits it.
    """
    lists = F.from_json(F.col(col), _notebook(T.ArrayType(T.StringType())))["cells"]
    texts = F.from_json(F.col(col), _notebook(T.StringType()))["cells"]
    cells = df.select(*keep, F.posexplode(F.arrays_zip(lists.alias("l"), texts.alias("t"))).alias("cell", "_c"))
    code = cells.filter(F.col("_c.t.cell_type") == "code")
    return code.select(*keep, "cell", F.coalesce(F.array_join("_c.l.source", ""), "_c.t.source").alias("source"))


def read_notebooks(spark: SparkSession, glob: str) -> DataFrame:
    """Code cells of notebook files: ``path, cell, source``."""
    files = spark.read.text(glob, wholetext=True)
    return notebook_cells(files.select(F.col("_metadata.file_path").alias("path"), "value"), ["path"], "value")


def assemble_chapters(
    bodies: DataFrame, order: DataFrame, key: str, body: str, book: str, pos: str,
    sep: str = "\n\n", part_size: int = 1000,
) -> DataFrame:
    """Join bodies in an explicit order, one row per book: ``book, members, body``; keys with no body are skipped.

    ``order`` holds ``(book, pos, key)``. Two levels: stretches of ``part_size`` positions are joined each by itself, then put together in order;
    their size has no influence on the rows.
    """
    part = F.floor(F.col(pos) / part_size).cast("bigint")
    placed = order.join(bodies, key).withColumn("part", part)
    grouped = placed.groupBy(book, "part").agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(body).alias("b")))).alias("_items"),
    )
    joined = F.array_join(F.transform("_items", lambda i: i["b"]), sep)
    parts = grouped.select(book, F.struct("part", F.size("_items").cast("bigint").alias("n"), joined.alias("b")).alias("p"))
    whole = parts.groupBy(book).agg(F.sum("p.n").alias("members"), F.sort_array(F.collect_list("p")).alias("_parts"))
    return whole.select(book, "members", F.array_join(F.transform("_parts", lambda p: p["b"]), sep).alias(body))


def missing_members(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows that have no counterpart."""
    return expected.join(present.select(*keys), list(keys), "left_anti")


def pattern_flags(code: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> Column:
    """Names of the rules a text breaks. A rule is (name, all-of patterns, any-of patterns)."""
    broken = []
    for name, all_of, any_of in rules:
        ok = F.lit(True)
        for pattern in all_of:
            ok = ok & F.contains(code, F.lit(pattern))
        if any_of:
            some = F.lit(False)
            for pattern in any_of:
                some = some | F.contains(code, F.lit(pattern))
            ok = ok & some
        broken.append(F.when(~ok, F.lit(name)))
    return F.filter(F.array(*broken), lambda b: b.isNotNull())


def comment_magics(code: Column) -> Column:
    """Prefix ``# `` to lines whose first visible character is ``!`` or ``%``."""
    return F.regexp_replace(code, r"(?m)^(?=[ \t]*[!%])", "# ")


def audit_patterns(df: DataFrame, col: str, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Static check of code texts: which required patterns are missing."""
    audited = df.withColumn("_code", comment_magics(F.col(col)))
    failures = pattern_flags(F.col("_code"), rules)
    return audited.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0).drop("_code")
