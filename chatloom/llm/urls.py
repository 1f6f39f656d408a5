"""URL filters: host and path rules, and boosted trees on lexical features for what no rule covers."""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.session import cut_lineage

FEATURES = (
    "url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "upper_ratio", "hyphens", "entropy", "host_entropy",
    "parameters", "has_fragment", "secure", "suffix_length", "suffix_pages", "suffix_path_length", "suffix_depth",
)


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(text: str, verdict: str) -> UrlRule:
    host, slash, rest = text.partition("/")
    return UrlRule(verdict, host, slash + rest)


def _ascii_lower(value: Column) -> Column:
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or where ``://`` is missing."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return _ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as ``struct<text, verdict>``, or null. Of rules of equal length the one with the longer host wins.

    Rules enter the plan as literals and are tried in order, so this is for lists of some hundreds.
    """
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(value: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.split(value, "")
    size = F.greatest(F.length(value), F.lit(1)).cast("double")
    share = lambda c: (F.length(value) - F.length(F.replace(value, c, F.lit("")))) / size
    distinct = F.filter(F.array_distinct(chars), lambda c: c != "")
    return F.aggregate(distinct, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def lexical(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` and :data:`FEATURES` of each URL.

    Suffix statistics describe the last two labels of the host over all pages: number of pages, mean path length and mean depth.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    length = F.greatest(F.length("url"), F.lit(1)).cast("double")
    kept = lambda pattern: F.length(F.regexp_replace("url", pattern, ""))
    rows = base.select(
        "page_id", "url", "host", "path", F.substring_index("host", ".", -2).alias("suffix"),
        F.length("url").alias("url_length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.size(F.split("host", r"\.")).alias("labels"), F.regexp_count("path", F.lit("/")).alias("depth"),
        (kept("[^0-9]") / length).alias("digit_ratio"), (kept("[^A-Z]") / length).alias("upper_ratio"), F.regexp_count("url", F.lit("-")).alias("hyphens"),
        _entropy(F.col("url")).alias("entropy"), _entropy(F.col("host")).alias("host_entropy"),
        F.regexp_count("url", F.lit(r"[?&][^=&#]+=")).alias("parameters"), F.contains("url", F.lit("#")).cast("int").alias("has_fragment"),
        F.startswith("url", F.lit("https:")).cast("int").alias("secure"),
    )
    rows = cut_lineage(rows.withColumn("suffix_length", F.length("suffix")))
    suffixes = rows.groupBy("suffix").agg(
        F.log1p(F.count(F.lit(1))).alias("suffix_pages"), F.avg("path_length").alias("suffix_path_length"), F.avg("depth").alias("suffix_depth"))
    return rows.join(suffixes, "suffix")


def train_trees(labelled: DataFrame, max_urls: int = 20_000, trees: int = 12, depth: int = 4, seed: int = 17):
    """Gradient-boosted trees from rows with :data:`FEATURES` and ``label`` (0 or 1); the label itself if there is only one, null if there is none.

    At most ``max_urls`` rows are used, chosen by a hash of the URL.
    """
    sample = cut_lineage(labelled.select("url", "label", *FEATURES).orderBy(F.xxhash64("url"), "url").limit(max_urls))
    seen = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(seen) < 2:
        return seen[0] if seen else None
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("features", F.col("label").cast("double").alias("label"))
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=32, stepSize=0.3).fit(data)


def url_filter(pages: DataFrame, rules: Sequence[UrlRule], labelled: DataFrame | None = None, cut: float = 0.5, **settings) -> DataFrame:
    """A verdict for every page: ``page_id, host, path, rule, verdict, score``.

    The longest rule that fits decides. All other URLs get ``block`` when boosted trees on lexical features give a score of ``cut``
    or more. The trees learn from ``labelled`` (``url``, ``label``: 1 block) or, without it, from the pages that rules decide.
    :func:`train_trees` has the settings and their bounds. Without any label the score is null and the verdict ``allow``.

    A null URL, or one without ``://``, has an empty host and path; no rule fits it and the trees judge it. Repeated
    rows get equal lines, null ids stay null, and an empty table gives an empty result. Other columns are ignored.
    """
    rows = lexical(pages.select("page_id", F.col("url").cast("string")))
    rows = rows.withColumn("_rule", match_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        learn = rows.filter(F.col("_rule").isNotNull()).withColumn("label", (F.col("_rule.verdict") == "block").cast("int"))
    else:
        learn = lexical(labelled.select(F.col("label").cast("int").alias("page_id"), "url")).withColumnRenamed("page_id", "label").filter("label is not null")
    model = train_trees(learn, **settings)
    if model is None or isinstance(model, int):
        scored = rows.withColumn("score", F.lit(model).cast("double"))
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
        scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    judged = F.when(F.col("score") >= cut, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("_rule.text").alias("rule"), F.coalesce(F.col("_rule.verdict"), judged).alias("verdict"), "score")
