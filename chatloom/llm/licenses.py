"""License scans: MinHash bands over overlapping text windows, then exact containment, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Public statements by which texts name their license: (license, statement). Fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
     "to deal in the Software without restriction"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced"),
)


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case; null for a null text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: str, width: int) -> Column:
    """Hash of each run of ``width`` words of an array column; empty for a shorter array."""
    w = F.col(words)
    last = F.size(w) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[w[i + k] for k in range(width)]))).otherwise(
        F.array().cast("array<bigint>"))


def size_class(n: Column) -> Column:
    """Smallest c such that n <= 2 ** c."""
    return F.ceil(F.log2(n.cast("double")) - 1e-9).cast("int")


def min_hashes(shingles: Column, bands: int) -> Column:
    """Least value of the set under each of ``bands`` hash functions."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, j))))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES, width: int = 5) -> DataFrame:
    """``template, license, wanted`` (distinct shingles), ``class``. Statements shorter than a shingle are refused."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    out = rows.withColumn("_words", words_of(F.col("text"))).withColumn("wanted", F.array_distinct(shingle_hashes("_words", width)))
    return out.select("template", "license", F.when(F.size("wanted") > 0, F.col("wanted")).otherwise(
        F.raise_error(F.concat(F.lit("template too short: "), F.col("text")))).alias("wanted")).withColumn("class", size_class(F.size("wanted")))


def license_scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, width: int = 5, least: float = 0.8, bands: int = 48, most_templates: int = 2000) -> DataFrame:
    """License statements found in whole texts: ``doc_id, template, license, containment, n_windows, first_word, last_word``.

    Texts and templates become sequences of hashed runs of ``width`` words. A template of s runs belongs to class c with 2**(c-1) < s <= 2**c; texts are
    read in windows of 2**(c+1) runs every 2**c runs, so any passage of a template's length lies in a window as a whole. A window and a template meet
    when they agree in one of ``bands`` MinHash values (bands of one row). At a containment of 0.8 a window has a Jaccard
    similarity of at least 0.19, so a match is retrieved with a probability of at least 1 - 0.81**48 = 0.99996. Each candidate is then
    verified: the share of the template's distinct runs that the window holds must be ``least`` or more.

    A MinHash value of a template is one of its runs. Windows without any run of any template can therefore agree with none, and
    their MinHash values are not computed. Templates are a bounded list (at most ``most_templates``).

    One line per row of ``docs`` and template with the best window's containment, the number of matching windows, and the word positions (from 0) of the first
    and last matching run. Null, empty and very short texts have no runs. Rows are told apart by ``doc_id``: repeated ids count as one document, and so do rows with
    a null id. An empty table gives an empty result. Other columns are ignored.
    """
    if len(templates) > most_templates:
        raise ValueError(f"{len(templates)} templates; at most {most_templates} are broadcast")
    spark = docs.sparkSession
    wanted = template_table(spark, templates, width)
    listed = wanted.collect()  # bounded by most_templates
    every = F.array(*[F.lit(h).cast("bigint") for h in sorted({h for r in listed for h in r["wanted"]})])
    classes = sorted({r["class"] for r in listed})

    words = docs.select(F.col("doc_id").cast("bigint"), words_of(F.coalesce(F.col("text"), F.lit(""))).alias("words"))
    runs = words.select("doc_id", shingle_hashes("words", width).alias("runs")).withColumn("_shared", F.array_intersect("runs", every))
    # No filter here: the optimiser would push it, with all that it depends on, below the split and repeat that per run.
    hits = runs.withColumn("_hits", F.when(F.size("_shared") > 0, F.filter(
        F.sequence(F.lit(0), F.size("runs") - 1), lambda i: F.array_contains("_shared", F.col("runs")[i]))))

    def windows(c: int) -> Column:
        stride = 1 << c
        own = F.flatten(F.transform("_hits", lambda p: F.array(F.floor(p / stride).cast("int"), F.floor(p / stride).cast("int") - 1)))
        return F.transform(F.array_distinct(F.filter(own, lambda k: k >= 0)), lambda k: F.struct(F.lit(c).alias("class"), (k * stride).alias("start"), F.lit(2 * stride).alias("size")))

    placed = hits.select("doc_id", "runs", F.explode_outer(F.concat(*[windows(c) for c in classes])).alias("w")).select(
        "doc_id", F.col("w.class").alias("class"), F.col("w.start").alias("start"), F.expr("slice(runs, w.start + 1, w.size)").alias("window"))
    signed = placed.select("*", F.posexplode(min_hashes(F.array_distinct("window"), bands)).alias("band", "value"))
    keys = wanted.select("template", "license", "wanted", "class", F.posexplode(min_hashes(F.col("wanted"), bands)).alias("band", "value"))
    # most_templates x bands short lines
    met = signed.join(F.broadcast(keys), ["class", "band", "value"])
    share = F.size(F.array_intersect("wanted", "window")) / F.size("wanted")
    found = met.withColumn("containment", share).filter(F.col("containment") >= least)
    inside = lambda i: F.array_contains(F.col("wanted"), F.col("window")[i])
    at = F.filter(F.sequence(F.lit(0), F.size("window") - 1), inside)
    spans = found.select("doc_id", "template", "license", "class", "start", "containment",
                         (F.col("start") + F.array_min(at)).alias("from"), (F.col("start") + F.array_max(at) + width - 1).alias("to"))
    return spans.groupBy("doc_id", "template", "license").agg(
        F.max("containment").alias("containment"), F.count_distinct("start").alias("n_windows"),
        F.min("from").cast("bigint").alias("first_word"), F.max("to").cast("bigint").alias("last_word"))
