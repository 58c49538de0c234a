"""Licence scans with sparse TF-IDF vectors (native functions only).

Passages of a text are compared with templates of licence headers and whole licence files:
its lines, windows of up to ``LINES`` neighbouring lines and ``SENTENCES`` neighbouring sentences
(line breaks inside a paragraph do not end a sentence), and the whole text. Terms weigh log((1 + N) / (1 + document
frequency)), with frequencies over all documents; terms outside the templates weigh as if no
document held them. A line is a candidate if it holds a term of a header template that is no
stop word; a window or a whole text if, besides, half of its terms or more are template terms. The best cosine at or above ``min_cosine`` names a document's own licence.

A document whose whole text matches is a licence file of its directory.
Documents without a licence of their own inherit from the nearest ancestor directory that has a
licence file: each path is spread over its ancestors, joined by equality, and the deepest
hit wins.

Defined results: a null or empty text has no licence of its own, a null path
inherits nothing; several licence files in a directory: the best cosine, then the
first name; repeated rows count as one file of that path; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, written

#: Notices of common licences (fixed values): headers and opening sentences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: Template terms that do not make a passage a candidate on their own.
STOP_WORDS = "a all and any are as by can either following for form forms free general in is it later met modify of or person public published source subject terms that the this to under use version with without work you 0 2 3 4 v".split()
#: Texts of licence files (folder ``license_texts``) and the notice that ends Apache's.
FILES = [(p.name.removesuffix(".txt").replace("GPL-3", "GPL-3.0"), p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").iterdir())]
FILES += [(name, text[text.rindex("Licensed under the Apache License") :]) for name, text in FILES if name == "Apache-2.0"]
MIN_COSINE = 0.75
#: Neighbouring lines or sentences in one passage, at most.
LINES, SENTENCES = 6, 3
#: Sentences end at a stop and a blank, paragraphs at a line without letters and digits.
SENTENCE_END = r"(?<=[.!?])\s+|\n[^A-Za-z0-9\n]*\n"
TERM = "[^a-z0-9]+"


def terms(text: Column) -> Column:
    """Lower-case runs of letters a-z and digits."""
    return F.array_remove(F.split(F.lower(text), TERM), "")


def _python_terms(text: str) -> list[str]:
    return [t for t in re.split(TERM, text.lower()) if t]


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once (lambdas compute what they hold each time)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(pieces: Column, wanted: Column, most: int) -> Column:
    """Up to ``most`` neighbouring pieces, joined, wherever one of them holds a wanted term."""

    def joined(p: Column, near: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.exists(F.slice(near, i, F.lit(most)), lambda x: x))
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.sequence(F.lit(1), F.lit(most)), lambda k: F.array_join(F.slice(p, i, k), " "))))

    return _bound(pieces, lambda p: _bound(F.transform(p, lambda x: F.arrays_overlap(terms(x), wanted)), lambda near: joined(p, near)))


def scan(
    docs: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES, min_cosine: float = MIN_COSINE, files: list[tuple[str, str]] = FILES,
) -> DataFrame:
    """Rows (doc_id, path, license, score, is_license_file, inherited_license,
    inherited_from, effective_license), one per row of ``docs``. The templates are a
    parameter: their terms bound what is collected and broadcast."""
    spark = docs.sparkSession
    rows = docs.select(named(id_col).alias("doc_id"), named(path_col).alias("path"), named(text_col).alias("text"))
    # a licence file holds a header's strong term too, so its own terms make no candidates
    strong = sorted({t for _, text in templates for t in _python_terms(text)} - set(STOP_WORDS))
    templates = [*templates, *files]
    vocabulary = sorted({t for _, text in templates for t in _python_terms(text)})
    known, wanted = F.array(*map(F.lit, vocabulary)), F.array(*map(F.lit, strong))

    # one reading of the texts: the template terms of each; only texts with a strong one go on
    held = rows.withColumn("held", F.array_intersect(F.split(F.lower("text"), TERM), known))
    read = written(
        held.select(
            "doc_id", "path", F.xxhash64("doc_id", "path", "text").alias("twin"), "held",
            F.when(F.arrays_overlap("held", wanted), F.col("text")).alias("text"),
        )
    )
    n = read.count()
    frequency = {r["term"]: r["n"] for r in read.select(F.explode("held").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    idf = {t: math.log((1 + n) / (1 + frequency.get(t, 0))) for t in vocabulary}
    unseen = float(math.log(1 + n))

    # template vectors of length one: a term's parts in all of them, side by side
    parts: dict[str, list[float]] = {t: [0.0] * len(templates) for t in vocabulary}
    for i, (_, text) in enumerate(templates):
        tf: dict[str, int] = {}
        for t in _python_terms(text):
            tf[t] = tf.get(t, 0) + 1
        norm = sum((k * idf[t]) ** 2 for t, k in tf.items()) ** 0.5
        for t, k in tf.items():
            parts[t][i] = float(k * idf[t] / norm) if norm > 0 else 0.0
    weights = spark.createDataFrame([(t, float(idf[t]), parts[t]) for t in vocabulary], "term string, idf double, parts array<double>")

    # a line that a text repeats counts once
    texts = read.where("text is not null").dropDuplicates(["doc_id", "twin"]).withColumn("line", F.array_distinct(F.split("text", "\n")))
    lines = F.filter("line", lambda x: F.arrays_overlap(terms(x), wanted))
    mostly_known = lambda x: 2 * F.size(F.filter(terms(x), lambda t: F.array_contains("held", t))) >= F.size(terms(x))
    windows = F.array_distinct(F.concat(
        _windows(F.split("text", "\n"), wanted, LINES), _windows(F.split("text", SENTENCE_END), wanted, SENTENCES)
    ))
    windows = F.filter(windows, lambda x: F.arrays_overlap(terms(x), wanted) & mostly_known(x))
    whole = F.when(mostly_known(F.col("text")), F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("passage"))))
    passages = texts.select(
        "doc_id", "path", "twin",
        F.explode(F.concat(
            F.transform(F.array_union(lines, windows), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("passage"))),
            F.coalesce(whole, F.array().cast("array<struct<whole:boolean,passage:string>>")),
        )).alias("p"),
    ).select("doc_id", "path", "twin", "p.*").withColumn("h1", F.xxhash64("passage")).withColumn("h2", F.xxhash64(F.lit(7), "passage"))
    passages = written(passages)  # read twice below: the distinct ones, and where they are
    # equal passages (by 128 bits) are compared once; all that follows stays in the partition of its passage
    distinct = passages.groupBy("h1", "h2").agg(F.first("passage").alias("passage"))
    spread = distinct.select("h1", "h2", F.explode(terms(F.col("passage"))).alias("term")).groupBy("h1", "h2", "term").agg(F.count("*").alias("tf"))
    spread = spread.join(F.broadcast(weights), "term", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    dots = [F.sum(F.col("weight") * F.col("parts")[i]).alias(f"dot{i}") for i in range(len(templates))]
    compared = spread.groupBy("h1", "h2").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"), *dots).where("norm > 0")
    ranks = [F.struct((F.col(f"dot{i}") / F.col("norm")).alias("cosine"), F.lit(name).alias("license")) for i, (name, _) in enumerate(templates)]
    hits = compared.select("h1", "h2", F.array_max(F.array(*ranks)).alias("x")).select("h1", "h2", "x.*").where(F.col("cosine") >= min_cosine)
    cosine = passages.select("doc_id", "path", "twin", "whole", "h1", "h2").join(hits, ["h1", "h2"])
    rank = F.struct(F.col("cosine"), F.col("license"))
    best = written(
        cosine.groupBy("doc_id", "path", "twin").agg(
            F.max(rank).alias("best"), F.max(F.when(F.col("whole"), rank)).alias("file")
        )
    )
    directory = lambda path: F.regexp_replace(path, "/?[^/]*$", "")
    held_files = best.where("file is not null and path is not null").groupBy(directory(F.col("path")).alias("directory")).agg(
        F.max(F.struct(F.col("file.cosine").alias("cosine"), F.col("file.license").alias("license"))).alias("x")
    ).select("directory", F.col("x.license").alias("inherited_license"))
    found = read.select("doc_id", "path", "twin").alias("r").join(
        best.alias("b"), F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("r.path").eqNullSafe(F.col("b.path")) & (F.col("r.twin") == F.col("b.twin")), "left"
    ).select("r.doc_id", "r.path", "r.twin", F.col("best.license").alias("license"), F.col("best.cosine").alias("score"), F.col("file").isNotNull().alias("is_license_file"))
    # ancestors of a directory: itself, then its parents, the root ("") last
    parts = F.split(directory(F.col("path")), "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    ancestors = F.transform(depths, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    below = found.where("license is null and path is not null").select("path").distinct().select("path", F.posexplode(F.array_distinct(ancestors)).alias("depth", "directory"))
    nearest = below.join(held_files, "directory").groupBy("path").agg(F.max(F.struct("depth", "directory", "inherited_license")).alias("x")).select(
        F.col("path").alias("p"), F.col("x.inherited_license").alias("inherited_license"), F.col("x.directory").alias("inherited_from")
    )
    out = found.join(nearest, (F.col("path") == F.col("p")) & F.col("license").isNull(), "left")
    return out.select(
        "doc_id", "path", "license", "score", "is_license_file", "inherited_license", "inherited_from",
        F.coalesce("license", "inherited_license").alias("effective_license"),
    )
