"""Licence notices in documents: a trained paragraph classifier, confirmed by templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.llm.common import stored

#: Notices by licence family: fixed values, the customary wordings.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("mit", "Released under the MIT License."),
    ("mit", "This software is available under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("bsd", "Use of this source code is governed by a BSD-style license."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("agpl", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0 Universal."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("proprietary", "Copyright, all rights reserved. No part of this work may be reproduced without written permission."),
    ("proprietary", "Confidential and proprietary. Unauthorized copying or distribution of this file is strictly prohibited."),
]
#: Class of paragraphs without a notice, and of notices whose family is not sure.
NONE, UNKNOWN = "none", "unknown"
#: Variants made of each template, and the rows that all corpus paragraphs without a notice weigh together.
VARIANTS, BACKGROUND = 40, 4000
#: Share of held-out background that may score above the calibrated probability; the least such probability.
FALSE_SHARE, LEAST = 0.001, 0.5
#: Share of a template's word pairs that a paragraph has to hold for the family to be confirmed.
CONFIRMED = 0.6


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:[.\-][a-z0-9]+)*)"))


def pairs(words: str) -> Column:
    """Neighbouring words of the column ``words``.

    Both arrays are zipped; a function that looked up the next word would have the whole text cut
    into words again for each of them, since Spark merges projections.
    """
    behind = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), behind), F.slice(words, F.lit(2), behind), lambda a, b: F.concat(a, F.lit(" "), b))


def terms(paragraphs: DataFrame) -> DataFrame:
    """``paragraphs`` (with ``text``) with ``words``, and ``terms``, the words and word pairs."""
    return paragraphs.withColumn("words", word_list(F.col("text"))).withColumn("terms", F.concat("words", pairs("words")))


def paragraphs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, paragraph, text) of every line that holds a word; paragraphs are numbered from 0."""
    lines = docs.select(F.col(id_column).alias("id"), F.posexplode(F.split(text_column, "\n")).alias("paragraph", "text"))
    return lines.where(F.col("text").rlike("[A-Za-z0-9]"))


def templates(spark: SparkSession) -> DataFrame:
    quoted = ", ".join("('{}', '{}')".format(family, text.replace("'", "''")) for family, text in TEMPLATES)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS templates(family, text)")


@dataclass
class LicenseModel:
    """The classifier, the names of its classes, and the probability from which a family is named."""

    regression: LogisticRegressionModel
    classes: list[str]
    least: float


def _vocabulary(known: DataFrame) -> tuple[list[str], list[str]]:
    """Words of the templates, and their word pairs, in order; other terms tell no notice from another."""
    split = known.withColumn("words", word_list(F.col("text")))
    return tuple(sorted(r[0] for r in split.select(F.explode(c)).distinct().collect()) for c in ("words", pairs("words")))


def vectors(lines: DataFrame, known: DataFrame) -> DataFrame:
    """``lines`` (with ``text``) with ``features``: which words and word pairs of the templates a paragraph holds."""
    words, both = _vocabulary(known)
    held = CountVectorizerModel.from_vocabulary(words + both, inputCol="terms", outputCol="features", binary=True)
    return held.transform(terms(lines)).drop("words", "terms")


def train(lines: DataFrame, known: DataFrame, variants: int = VARIANTS, background: int = BACKGROUND) -> LicenseModel:
    """Multinomial logistic regression with sparse weights on words and word pairs of the templates.

    Notices are variants of the templates: words left out by a hash, and foreign words around them, as
    often as the corpus has them. The class of no notice is every paragraph of the corpus (``lines``, as
    ``paragraphs`` or ``vectors`` gives them) that shares no two word pairs with a template. Paragraphs
    of the same features are one weighted row, and together they weigh ``background`` rows. Two thirds
    of the texts train; the rest calibrates the probability below which a notice is of the unknown family.
    """
    words, both = _vocabulary(known)
    lines = lines if "features" in lines.columns else vectors(lines, known)
    part = F.pmod(F.xxhash64("text"), F.lit(1000)).cast("int") if "text" in lines.columns else F.col("part")
    groups = lines.groupBy("features", (part % 3 == 1).alias("aside")).agg(F.count("*").alias("n"))
    pairs_held = F.size(F.array_remove(F.slice(vector_to_array("features"), len(words) + 1, max(len(both), 1)), 0.0))
    held = stored(groups.where(pairs_held < 2), "license-background")
    total = held.agg(F.sum("n")).first()[0] or 0
    shares = held.agg(Summarizer.mean(F.col("features"), F.col("n").cast("double"))).first()[0].toArray().tolist() if total else []
    often = [(term, round(share * 1_000_000)) for term, share in zip(words + both, shares)]
    known = known.withColumn("words", word_list(F.col("text")))
    made = known.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("variant")).select(
        "family", "variant", F.expr("filter(words, (w, i) -> variant < 8 or pmod(xxhash64(w, i, variant), 10) > 0)").alias("words")
    )
    # The name of a variant and of a term decide whether the term stands around it.
    made = made.withColumn("name", F.xxhash64("family", "words", "variant"))
    foreign = [F.when(F.pmod(F.xxhash64("name", F.lit(term)), F.lit(1_000_000)) < times, F.lit(term)) for term, times in often if times]
    around = F.when(F.pmod("variant", F.lit(4)) == 3, F.array_compact(F.array(*foreign)) if foreign else F.array().cast("array<string>"))
    own = F.concat("words", pairs("words"), F.coalesce(around, F.array().cast("array<string>")))
    model = CountVectorizerModel.from_vocabulary(words + both, inputCol="terms", outputCol="features", binary=True)
    notices = model.transform(made.where(F.size("words") > 0).withColumn("terms", own))
    notices = notices.where("variant % 3 != 1").select("family", "features", F.lit(1.0).alias("weight"))
    none = held.where("NOT aside").select(F.lit(NONE).alias("family"), "features", (F.col("n") * (background / max(total, 1))).alias("weight"))
    rows = stored(notices.union(none), "license-rows")
    indexer = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    regression = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=60, weightCol="weight")
    fitted = regression.fit(indexer.transform(rows))
    classes = list(indexer.labels)
    at = classes.index(NONE) if NONE in classes else -1
    best = F.array_max(F.transform(vector_to_array("probability"), lambda p, i: F.when(i == at, 0.0).otherwise(p)))
    # All paragraphs aside count. Probabilities are rounded up, which bounds what the percentile keeps.
    scores = fitted.transform(held.where("aside")).select((F.ceil(best * 10_000) / 10_000).alias("p"), "n")
    found = scores.agg(F.percentile("p", 1 - FALSE_SHARE, F.col("n"))).first()[0]
    return LicenseModel(fitted, classes, max(LEAST, found or 0.0))


def find_licenses(docs: DataFrame, known: DataFrame, model: LicenseModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, paragraph, family, probability, similarity) of every paragraph with a licence notice.

    ``family`` is the likeliest one if its probability reaches the calibrated value and a template of
    the family confirms it: ``similarity``, the share of the template's word pairs that the paragraph
    holds, is at least CONFIRMED. Otherwise a paragraph more likely a notice than not is ``unknown``.

    Paragraphs are lines, numbered from 0, and read whole. Null and empty texts have none; repeated
    rows are reported row by row. Other columns are ignored.
    """
    return judge(vectors(paragraphs(docs, id_column, text_column), known), known, model).withColumnRenamed("id", id_column)


def judge(lines: DataFrame, known: DataFrame, model: LicenseModel) -> DataFrame:
    """(id, paragraph, family, probability, similarity) of the notices among paragraphs with ``features``; see ``find_licenses``."""
    words, both = _vocabulary(known)
    none = model.classes.index(NONE) if NONE in model.classes else -1
    judged = model.regression.transform(lines.select("id", "paragraph", "features")).withColumn("p", vector_to_array("probability"))
    likely = judged.where(F.get("p", F.lit(none)) < 0.5) if none >= 0 else judged
    families = F.transform("p", lambda p, i: F.when(i == none, -1.0).otherwise(p))
    named = likely.withColumn("q", families).withColumn("probability", F.array_max("q"))
    named = named.withColumn("guess", F.get(F.array(*[F.lit(c) for c in model.classes]), (F.array_position("q", F.col("probability")) - 1).cast("int")))
    # Only pairs of templates can be shared with one.
    held = F.slice(vector_to_array("features"), len(words) + 1, max(len(both), 1))
    own = F.array_compact(F.zip_with(held, F.array(*[F.lit(b) for b in both]).cast("array<string>"), lambda x, b: F.when(x > 0, b)))
    shape = F.array_distinct(pairs("words"))
    shapes = known.withColumn("words", word_list(F.col("text"))).select(F.col("family").alias("guess"), shape.alias("shape"))
    by_family = shapes.groupBy("guess").agg(F.collect_list("shape").alias("shapes"))  # one row a family
    compared = named.select("id", "paragraph", "guess", "probability", own.alias("own")).join(by_family, "guess", "left")
    similar = F.array_max(F.transform("shapes", lambda s: F.size(F.array_intersect(s, F.col("own"))) / F.size(s)))
    out = compared.withColumn("similarity", F.coalesce(similar, F.lit(0.0)))
    sure = (F.col("probability") >= model.least) & (F.col("similarity") >= CONFIRMED)
    return out.select("id", "paragraph", F.when(sure, F.col("guess")).otherwise(UNKNOWN).alias("family"), "probability", "similarity")
