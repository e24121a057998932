"""Licence notices in paragraphs: sparse n-gram logistic regression, calibrated, confirmed by templates.

Only DataFrame functions and Spark's own estimators run on the rows.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import staged

UNKNOWN = "unknown"
NEGATIVES = 4000  # corpus paragraphs to train on, on average, chosen by a hash
# Function words of the templates, which are no feature by themselves.
FUNCTION = frozenset("a all along and any are as at by except have in is it may not of or should that the this to under with "
                     "without you".split())
CONFIRM = 0.6  # least share of a template's word trigrams in the paragraph
HELD_OUT = 3  # one training row in so many is for the calibration
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"

# Sentences of public licence notices by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal Public Domain Dedication.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
}

# Own sentences that have the words of notices and are none of the families.
OTHERS = (
    "All rights reserved.", "The licence fee was raised again this year.", "Apache helicopters were seen over the city.",
    "Researchers at MIT released a new version of their study.", "He lost his driving licence in May.",
    "The program runs on any work day, free of charge.", "A public domain was registered by the author.",
    "You may obtain a copy at the office.", "This software requires a commercial license from the vendor.",
    "Licensed under the terms of the partner agreement, version 7.", "Creative people share common interests.",
    "The general public was free to use the library.", "Our source code is binary and has two forms.",
    "Permission to park is granted to residents.", "The foundation published its terms in Mozilla style.",
    "Redistribution of income follows other conditions.", "Use of this file is not permitted.",
    "Universal rights are related to law.", "Released in version 4.0 of the game.", "Subject to change without notice.",
)


@dataclass
class Model:
    """Families, weight of each n-gram for each, intercepts, and slope and offset of the calibration."""

    families: list[str]
    weights: dict[str, list[float]]
    intercepts: list[float]
    slope: float
    offset: float
    words: list[str]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def grams(tokens: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The distinct word n-grams of a token list."""
    def of(n: int) -> Column:
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def _with_grams(rows: DataFrame) -> DataFrame:
    """``rows`` with tokens, trigrams and grams of ``text``, each computed once."""
    rows = _computed(rows, *rows.columns, words(F.col("text")).alias("tokens"))
    return _computed(rows, *rows.columns, grams(F.col("tokens"), (3,)).alias("trigrams"), grams(F.col("tokens")).alias("grams"))


def _rows(spark: SparkSession, values: list[dict], schema: str) -> DataFrame:
    """A small table of the program's own values."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


def _examples() -> list[dict]:
    """Each template whole, in its windows of two thirds or more of the words, and with words around it."""
    found = []
    for family, sentences in [*TEMPLATES.items(), (UNKNOWN, OTHERS)]:
        for sentence in sentences:
            tokens = sentence.split()
            least = max(3, math.ceil(len(tokens) * 2 / 3)) if family != UNKNOWN else 1
            cut = {" ".join(tokens[i:j]) for i in range(len(tokens)) for j in range(i + least, len(tokens) + 1)}
            around = {f"Copyright 2020 the authors. {sentence}", f"{sentence} See the file for details.", sentence}
            found += [{"text": t, "family": family} for t in sorted(cut | around)]
    return found


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text): the lines of each text, numbered from 0."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))


def train(documents: DataFrame, negatives: int = NEGATIVES) -> Model:
    """A model from the templates, the other sentences and about ``negatives`` paragraphs of the corpus.

    The paragraphs come from texts chosen by a hash of doc_id, whole texts each, and count as unknown unless
    they hold most of a template. Features are the templates' n-grams of one to three words that have a word
    other than FUNCTION, whatever the corpus holds, so a paragraph without any such word is unknown.
    """
    spark = documents.sparkSession
    n_texts = documents.count()
    share = F.lit(min(1.0, negatives / 4 / max(1, n_texts)) * 1e6)
    corpus = paragraphs(documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share))
    corpus = corpus.where(F.pmod(F.xxhash64("doc_id", "paragraph"), F.lit(4)) == 0).select("text")
    templates = [" ".join(re.findall(WORD, t.lower())) for sentences in TEMPLATES.values() for t in sentences]
    tokens = {w for t in templates for w in t.split(" ")}
    listed = {" ".join(t.split(" ")[i:i + n]) for t in templates for n in (1, 2, 3) for i in range(t.count(" ") + 2 - n)}
    able = tokens - FUNCTION
    vocabulary = sorted(g for g in listed if able.intersection(g.split(" ")))
    own = _rows(spark, _examples(), "text string, family string")
    families = [UNKNOWN, *TEMPLATES]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    every = tuple(t for sentences in TEMPLATES.values() for t in sentences)
    rows = _with_grams(own.union(corpus.withColumn("family", F.lit(UNKNOWN))))
    # Staged ahead of the filter, which would else be pushed into the expressions that it reads.
    rows = staged(rows.select("text", "family", label.alias("label"), _similarity(F.col("trigrams"), every).alias("similar"),
                              F.array_intersect("grams", F.array(*[F.lit(g) for g in vocabulary])).alias("grams")), "licences")
    rows = rows.where((F.col("family") != UNKNOWN) | (F.col("similar") < CONFIRM)).select("text", "label", "grams")
    featured = CountVectorizerModel.from_vocabulary(
        vocabulary, inputCol="grams", outputCol="features").setBinary(True).transform(rows)
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, elasticNetParam=0.0, maxIter=60).fit(featured.where(~held))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {g: [float(w) for w in matrix[:, i]] for i, g in enumerate(vocabulary)}
    model = Model(families, weights, [float(x) for x in intercepts], 1.0, 0.0, sorted(able))
    scored = _predicted(rows.where(held).withColumn("id", F.monotonically_increasing_id()), model, ["id", "label"])
    right = (F.get(F.array(*[F.lit(f) for f in families]), F.col("label").cast("int")) == F.col("family")).cast("double")
    margins = scored.select(F.array(F.col("margin")).alias("margins"), right.alias("label"))
    if margins.select("label").distinct().count() == 2:
        platt = LogisticRegression(regParam=1e-2).fit(margins.select(array_to_vector("margins").alias("features"), "label"))
        model.slope, model.offset = max(float(platt.coefficients[0]), 0.0), float(platt.intercept)
    return model


def _trigrams(sentence: str) -> list[str]:
    """``grams`` of a template, as a constant."""
    tokens = re.findall(WORD, sentence.lower())
    return sorted({" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)})


def _similarity(trigrams: Column, sentences: tuple[str, ...]) -> Column:
    """The greatest share of a template's word trigrams in the paragraph."""
    shares = []
    for own in map(_trigrams, sentences):
        shares.append(F.size(F.array_intersect(F.array(*[F.lit(g) for g in own]), trigrams)) / max(1, len(own)))
    return F.array_max(F.array(*shares))


def _alone(sentences: tuple[str, ...]) -> Column:
    """The greatest similarity of a single line of a run."""
    return F.array_max(F.transform("alone", lambda trigrams: _similarity(trigrams, sentences)))


def _predicted(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys``, the best family and its margin (log odds against all others) for rows with ``grams``."""
    spark = rows.sparkSession
    table = _rows(spark, [{"gram": g, "w": w} for g, w in model.weights.items()], "gram string, w array<double>")
    n = len(model.families)
    logits = F.array(*[F.coalesce(F.sum(F.get("w", F.lit(i))), F.lit(0.0)) + model.intercepts[i] for i in range(n)])
    found = (
        rows.select(*keys, F.explode_outer("grams").alias("gram")).join(F.broadcast(table), "gram", "left")
        .groupBy(*keys).agg(logits.alias("logits"))
    )
    best = F.array_max("logits")
    at = F.array_position("logits", best).cast("int") - 1
    # A class that ties with the best is one of the others.
    rest = F.aggregate(F.filter("logits", lambda x, i: i != at), F.lit(1e-300), lambda s, x: s + F.exp(x - best))
    return found.select(*keys, F.get(F.array(*[F.lit(f) for f in model.families]), at).alias("family"),
                        (-F.log(rest)).alias("margin"))


def _computed(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """A select whose expressions stay apart from those that read them, inside lambdas as well.

    Spark would put an expression in the place of its name, and compute it once for each element of a lambda.
    """
    return rows.select(F.inline(F.array(F.struct(*columns))))


def _wrapped(documents: DataFrame) -> DataFrame:
    """(doc_id, paragraph, lines, text, alone): runs of lines over whose ends a template goes on.

    Two lines belong together if a word trigram that crosses from one to the other is a template's; a run is as long
    as that goes on, and a blank line ends it. Each line is split into words once, and a line is in one run at
    most. ``alone`` holds the lines' own texts.
    """
    known = F.array(*[F.lit(g) for g in sorted({g for ss in TEMPLATES.values() for t in ss for g in _trigrams(t)})])
    found = _computed(documents, "doc_id", F.split("text", "\n").alias("line")).where(F.size("line") > 1)
    found = _computed(found, "doc_id", "line", F.transform("line", words).alias("token"))
    # The last two words of a line and the first two of the next one.
    ends = F.transform(F.sequence(F.lit(1), F.size("line") - 1), lambda i: F.struct(
        F.get("token", i - 1).alias("own"), F.get("token", i).alias("next")))
    found = _computed(found, "doc_id", "line", F.transform(ends, lambda e: F.when(
        (F.size(e["own"]) > 0) & (F.size(e["next"]) > 0),
        F.concat(F.slice(e["own"], F.greatest(F.size(e["own"]) - 1, F.lit(1)), 2), F.slice(e["next"], 1, 2)))).alias("end"))
    found = _computed(found, "doc_id", "line", F.transform("end", lambda t: F.coalesce(
        F.arrays_overlap(grams(t, (3,)), known), F.lit(False))).alias("goes_on")).where(F.array_contains("goes_on", True))
    starts = F.filter(F.sequence(F.lit(1), F.size("goes_on")),
                      lambda i: F.get("goes_on", i - 1) & ~F.coalesce(F.get("goes_on", i - 2), F.lit(False)))
    runs = F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_position(F.concat(
        F.slice("goes_on", i, F.size("goes_on")), F.array(F.lit(False))), False).cast("int").alias("lines")))
    found = found.select("doc_id", "line", F.inline(runs)).withColumn("alone", F.slice("line", F.col("start"), F.col("lines")))
    return found.select("doc_id", (F.col("start") - 1).alias("paragraph"), "lines", F.array_join("alone", "\n").alias("text"), "alone")


def scan(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, paragraph, predicted, probability, similarity, family, lines for each paragraph with a feature word.

    ``predicted`` is the regression's class, ``probability`` the calibrated chance that it is right, and
    ``similarity`` the greatest share of a template of that family in the paragraph. ``family`` is the predicted
    one if the probability is at least one half and a template confirms it, and otherwise unknown. A paragraph is
    a line; a notice wrapped over any number of lines without a blank one between is a further row, with its first
    line and how many ``lines`` it takes, if it is of a family that none of these lines confirms by itself.

    Paragraphs without any feature word are unknown by the model and not in the result, so neither are null and
    empty texts. Rows without doc_id are scanned too; repeated rows give each paragraph once.
    """
    pattern = f"(?i)(?<![a-z0-9])(?:{'|'.join(w.replace('.', '[.]') for w in model.words) or '(?!)'})(?![a-z0-9])"
    documents = documents.select("doc_id", "text").where(F.col("text").rlike(pattern))
    none = F.array().cast("array<string>")
    single = paragraphs(documents).where(F.col("text").rlike(pattern)).select(
        "doc_id", "paragraph", F.lit(1).alias("lines"), "text", none.alias("alone"))
    rows = _with_grams(single.union(_wrapped(documents)).dropDuplicates(["doc_id", "paragraph", "lines", "text"]))
    rows = _computed(rows, "doc_id", "paragraph", "lines", "trigrams", "grams", F.transform("alone", words).alias("alone"))
    rows = rows.withColumn("alone", F.transform("alone", lambda x: grams(x, (3,))))
    found = _predicted(rows, model, ["doc_id", "paragraph", "lines", "trigrams", "alone"])
    similarity = less = F.lit(0.0)
    for family, sentences in TEMPLATES.items():
        own = F.col("family") == family
        similarity = F.when(own, _similarity(F.col("trigrams"), sentences)).otherwise(similarity)
        less = F.when(own & (F.col("lines") > 1), _alone(sentences)).otherwise(less)
    probability = 1 / (1 + F.exp(-(model.slope * F.col("margin") + model.offset)))
    sure = (F.col("probability") >= 0.5) & (F.col("similarity") >= CONFIRM)
    return (
        found.withColumn("similarity", similarity).withColumn("probability", probability)
        .where((F.col("lines") == 1) | sure & (less < CONFIRM))
        .select("doc_id", "paragraph", F.col("family").alias("predicted"), "probability", "similarity",
                F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"), "lines")
    )
