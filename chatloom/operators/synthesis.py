"""Seeded synthesis of labelled chat samples.

Every random decision is a pure function of (seed, row id), so sampling is a narrow
projection: any number of rows, no shuffle until the one deduplication.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.seeded import flip, pick, pick_index
from chatloom.operators import catalogue as C
from chatloom.operators.dedup import dedup_first
from chatloom.operators.prepare import build_messages
from chatloom.session import cut_lineage
from chatloom.sources.datasets import read_split

Catalogue = Mapping[str, Sequence[str]]
PLACEHOLDER = "{domain}"


def label_from_category(c: Column) -> Column:
    """Polarity in the category name; ``positive`` is looked for first."""
    return F.when(F.contains(c, F.lit("positive")), "Positive").when(F.contains(c, F.lit("negative")), "Negative").otherwise("Neutral")


def expand(template: Column, noun: Column, placeholder: str = PLACEHOLDER) -> Column:
    """Replace every placeholder; a template without one passes through."""
    return F.replace(template, F.lit(placeholder), noun)


def expand_templates(df: DataFrame, template: str, nouns: str, placeholder: str = PLACEHOLDER) -> DataFrame:
    """All fillings of a template column by an array column of nouns."""
    filled = df.withColumn("noun", F.explode(nouns))
    return filled.withColumn("text", expand(F.col(template), F.col("noun"), placeholder))


def inject_intensifier(
    c: Column, seed: int, *ids: Column, adjectives: Sequence[str] = C.ADJECTIVES, intensifiers: Sequence[str] = C.INTENSIFIERS, p: float = 0.2
) -> Column:
    """With probability ``p`` put an intensifier before all occurrences of the first listed adjective found.

    Plain substring match: no word boundaries, case-sensitive.
    """
    word = pick(intensifiers, seed, "intensifier", *ids)
    out = F.when(~flip(p, seed, "intensify", *ids), c)
    for adjective in adjectives:
        found = F.lit(adjective)
        out = out.when(F.contains(c, found), F.replace(c, found, F.concat(word, F.lit(" "), found)))
    return out.otherwise(c)


def vary_punctuation(c: Column, seed: int, *ids: Column, endings: Sequence[str] = C.ENDINGS) -> Column:
    """Swap a final ``.`` or ``!`` for one of the endings."""
    body = F.substring(c, F.lit(1), F.length(c) - 1)
    return F.when(F.substring(c, -1, 1).isin(".", "!"), F.concat(body, pick(endings, seed, "ending", *ids))).otherwise(c)


def vary_casing(c: Column, seed: int, *ids: Column, p_lower: float = 0.05, p_upper: float = 0.02) -> Column:
    """Lower case with ``p_lower``, otherwise upper case with ``p_upper``."""
    return F.when(flip(p_lower, seed, "lower", *ids), F.lower(c)).when(flip(p_upper, seed, "upper", *ids), F.upper(c)).otherwise(c)


def mutate(df: DataFrame, col: str, seed: int, *ids: str) -> DataFrame:
    """Intensifier, then punctuation, then casing. One projection each, so nothing is computed twice."""
    keys = [F.col(i) for i in ids]
    for step in (inject_intensifier, vary_punctuation, vary_casing):
        df = df.withColumn(col, step(F.col(col), seed, *keys))
    return df


def wrap_instruction(c: Column, seed: int, *ids: Column, formats: Sequence[str] = C.INSTRUCTIONS) -> Column:
    """Insert the text into one of the phrasings; a single phrasing is used as it is."""
    fmt = F.lit(formats[0]) if len(formats) == 1 else pick(formats, seed, "instruction", *ids)
    return F.replace(fmt, F.lit("{text}"), c)


def wrap_task(c: Column, task: str | Column) -> Column:
    """Task envelope around a text; ``task`` is a name or a column of names (unknown gives null)."""
    if isinstance(task, str):
        return F.replace(F.lit(C.TASK_ENVELOPES[task]), F.lit("{text}"), c)
    return F.coalesce(*[F.when(task == name, wrap_task(c, name)) for name in C.TASK_ENVELOPES])


def _nested(values: Sequence[Sequence[str]]) -> Column:
    return F.array(*[F.array(*[F.lit(v) for v in inner]) for inner in values])


def _with_noun(df: DataFrame, id_col: str, seed: int, lexicon: Catalogue) -> DataFrame:
    domains = list(lexicon)
    chosen = pick_index(len(domains), seed, "domain", F.col(id_col))
    named = df.withColumn("domain", F.get(F.array(*[F.lit(d) for d in domains]), chosen)).withColumn("_nouns", F.get(_nested(list(lexicon.values())), chosen))
    return named.withColumn("noun", pick(F.col("_nouns"), seed, "noun", F.col(id_col))).drop("_nouns")


def sample_two_stage(
    ids: DataFrame, id_col: str, seed: int, catalogue: Catalogue = C.TEMPLATES, lexicon: Catalogue = C.LEXICON
) -> DataFrame:
    """Category uniform, then template uniform inside it, then domain and noun uniform.

    One sample per id; adds ``category, template, domain, noun, text``.
    """
    names = list(catalogue)
    chosen = pick_index(len(names), seed, "category", F.col(id_col))
    staged = ids.withColumn("category", F.get(F.array(*[F.lit(n) for n in names]), chosen)).withColumn("_group", F.get(_nested(list(catalogue.values())), chosen))
    staged = staged.withColumn("template", pick(F.col("_group"), seed, "template", F.col(id_col))).drop("_group")
    return _with_noun(staged, id_col, seed, lexicon).withColumn("text", expand(F.col("template"), F.col("noun")))


def sample_label_first(
    ids: DataFrame, id_col: str, seed: int, catalogue: Catalogue = C.TEMPLATES, domains: Sequence[str] = tuple(C.LEXICON)
) -> DataFrame:
    """Label uniform over Positive / Negative, then any template of that label, then the domain word itself. No dedup."""
    groups = {
        "Positive": [t for c, ts in catalogue.items() if "positive" in c for t in ts],
        "Negative": [t for c, ts in catalogue.items() if "positive" not in c and "negative" in c for t in ts],
    }
    chosen = pick_index(2, seed, "label", F.col(id_col))
    staged = ids.withColumn("label", F.get(F.array(*[F.lit(n) for n in groups]), chosen)).withColumn("_group", F.get(_nested(list(groups.values())), chosen))
    staged = staged.withColumn("template", pick(F.col("_group"), seed, "template", F.col(id_col))).drop("_group")
    domain = pick(list(domains), seed, "domain", F.col(id_col))
    return staged.withColumn("domain", domain).withColumn("text", expand(F.col("template"), F.col("domain")))


def synthesise(
    ids: DataFrame, id_col: str, seed: int, n: int | None = None,
    catalogue: Catalogue = C.TEMPLATES, lexicon: Catalogue = C.LEXICON, formats: Sequence[str] = C.INSTRUCTIONS,
) -> DataFrame:
    """Sample, mutate, drop repeated texts (first id wins), label, wrap: ``id, text, label, messages``.

    One candidate per id. With ``n``, exactly the first ``n`` distinct samples in id order are
    returned; too few distinct texts among the candidates raise instead of looping for ever.
    """
    sampled = sample_two_stage(ids.select(id_col), id_col, seed, catalogue, lexicon)
    distinct = dedup_first(mutate(sampled.select(id_col, "category", "text"), "text", seed, id_col), "text", [id_col])
    if n is not None:
        # texts are drawn once; counting and cutting read what was drawn
        distinct = cut_lineage(distinct)
        have = distinct.count()
        if have < n:
            raise ValueError(f"only {have} distinct texts among the candidates, {n} requested")
        distinct = read_split(distinct, f"all[:{n}]", id_col)
    labelled = distinct.withColumn("label", label_from_category(F.col("category")))
    asked = wrap_instruction(F.col("text"), seed, F.col(id_col), formats=formats)
    return labelled.select(id_col, "category", "text", "label", build_messages(asked, F.col("label")).alias("messages"))


def reachable_texts(catalogue: Catalogue, lexicon: Catalogue) -> int:
    """How many different texts templates and nouns can give before any mutation."""
    nouns = {n for ns in lexicon.values() for n in ns}
    return len({t.replace(PLACEHOLDER, n) for ts in catalogue.values() for t in ts for n in nouns})


def synthesise_exactly(
    spark, n: int, seed: int, oversample: float = 2.0, catalogue: Catalogue = C.TEMPLATES, lexicon: Catalogue = C.LEXICON, **options
) -> DataFrame:
    """``synthesise`` over generated ids, with four times the candidates each round until ``n`` texts differ.

    Candidates enough to have met every unmutated text many times over, and still too few distinct texts,
    mean that the catalogue cannot give ``n``; only then the request fails.
    """
    candidates, plenty = max(1, int(n * oversample)), 64 * max(n, reachable_texts(catalogue, lexicon))
    while True:
        ids = spark.range(candidates)
        sampled = sample_two_stage(ids, "id", seed, catalogue, lexicon)
        have = mutate(sampled, "text", seed, "id").select("text").distinct().count()
        if have >= n or candidates >= plenty:
            return synthesise(ids, "id", seed, n, catalogue, lexicon, **options)
        candidates *= 4
