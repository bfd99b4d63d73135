"""Licence notices in paragraphs, by a trained classifier that templates confirm.

A multinomial logistic regression on sparse word n-grams (one and two words,
hashed to `features` places) tells licence families and `unknown` apart. It is
fitted on what the templates below give: whole, cut, with a word left out, with
names and years around; and, for `unknown`, on paragraphs of the corpus itself
and on sentences that only speak of licences. The probability from which on a
family counts is calibrated on rows held out. A prediction stands only if the
paragraph and a template of the family share enough of their word pairs: those of
the shorter of the two if the paragraph has a cue word, those of the template if not.

A paragraph is a line. Every line with a word goes through the classifier.
Everything on the way is built-in functions and Spark's own estimator; the sample
for `unknown` is bounded by `background` rows, chosen by hash among the lines
without a cue word, less those that a template would confirm.

Defined results: null and empty texts have no paragraphs; lines of any length
are read whole; rows are judged by themselves, so repeated rows get equal
results, and other columns stay out of it; an empty table trains on templates
alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

# Notices by which licences are commonly referred to or granted.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the Apache License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license.",
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted under the terms of the BSD license.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v3 license.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Copyright notice: permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without permission.",
    ],
}
OTHER_SENTENCES = [
    "The driver lost his license after the accident last year.",
    "She renewed the fishing license at the town hall.",
    "Copyright law differs from one country to another.",
    "The museum of MIT is open to the public on Sunday.",
    "Apache helicopters were seen over the valley.",
    "Their license to sell wine was not extended, version or not.",
    "A licence fee pays for public radio in general.",
    "The committee discussed which license the project should choose.",
]
WITH_WORD = r"[\p{L}\p{N}]"
CUE = r"(?i)licen[cs]|copyright|rights reserved|\bgpl\b|\bcc[ -]by\b"
UNKNOWN = "unknown"


@dataclass(frozen=True)
class Training:
    features: int = 4096
    background: int = 1000
    precision: float = 0.99
    shared_pairs: float = 0.5


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*)"), F.lit(1))


def pairs_of(words: Column) -> Column:
    """Pairs of neighbouring words; the word itself if there is only one."""
    # Zipped, not looked up by index: an array that a lambda takes from outside may be computed once for each element.
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
    nexts = F.slice(words, F.lit(2), F.size(words))
    return F.array_distinct(F.zip_with(firsts, nexts, lambda a, b: F.concat_ws(" ", a, b)))


def _features(df: DataFrame, text: str, training: Training) -> DataFrame:
    grams = df.withColumn("words", words_of(F.col(text))).withColumn("pairs", pairs_of(F.col("words")))
    return HashingTF(numFeatures=training.features, inputCol="grams", outputCol="features").transform(
        grams.withColumn("grams", F.concat("words", "pairs"))
    )


def _lines(text: str) -> Column:
    return F.split(text, "\n", -1)


def candidate_lines(docs: DataFrame) -> DataFrame:
    """doc (id and text hash), line_no, line of every line with a word of (id, text) rows; repeated rows repeat theirs."""
    # Hashed before the lines are dealt out: beside them, the whole text would be hashed for each.
    keyed = docs.select(_key(), "text")
    lines = keyed.select("doc", F.posexplode(_lines("text")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(WITH_WORD))


def _key() -> Column:
    return F.struct("id", F.xxhash64("text").alias("hash")).alias("doc")


def _templates(spark: SparkSession) -> DataFrame:
    """family, templates (arrays of word pairs): one row for each family."""
    templates = spark.createDataFrame([(f, t) for f, texts in TEMPLATES.items() for t in texts], "family string, template string")
    return templates.select("family", pairs_of(words_of(F.col("template"))).alias("template_pairs")).groupBy("family").agg(
        F.collect_list("template_pairs").alias("templates")
    )


def _confirmed(line: str, pairs: str, templates: str, training: Training) -> Column:
    """Whether a line and one of the templates share enough pairs.

    A line with a cue word may be a part of a template, or hold one: the shorter of the two counts.
    Of other lines, a few common words would do so; they have to hold enough of the template.
    """
    held = lambda t: F.size(F.array_intersect(pairs, t))
    enough = lambda t, n: held(t) / n >= training.shared_pairs
    shorter = lambda t: F.least(F.size(pairs), F.size(t))
    has_cue = F.col(line).rlike(CUE)
    found = F.when(has_cue, F.exists(templates, lambda t: enough(t, shorter(t)))).otherwise(F.exists(templates, lambda t: enough(t, F.size(t))))
    return F.coalesce(found, F.lit(False))


def training_rows(spark: SparkSession, docs: DataFrame, training: Training) -> DataFrame:
    """family, text: made from templates, from other sentences, and from a bounded sample of the corpus's lines."""
    around = ["", "Copyright (c) 2021 The Authors. ", "Copyright 1999 Example Inc. ", "Note: "]
    rows = []
    for family, texts in [*TEMPLATES.items(), (UNKNOWN, OTHER_SENTENCES)]:
        for text in texts:
            words = text.split()
            forms = [text, text.upper(), text.rstrip(".")]
            if len(words) > 4:
                forms += [" ".join(words[:i] + words[i + 1 :]) for i in range(len(words))] + [" ".join(words[: -len(words) // 4])]
            rows += [(family, before + form) for form in forms for before in around]
    made = spark.createDataFrame(rows, "family string, text string")
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("text")).where(
        F.col("text").rlike(r"\p{L}") & ~F.col("text").rlike(CUE)
    )
    # The lines of the smallest hashes; equal ones once.
    sample = lines.groupBy(F.xxhash64("text").alias("hash")).agg(F.min("text").alias("text")).orderBy("hash").limit(training.background)
    # A notice without a cue word is no example of `unknown`.
    every = _templates(spark).agg(F.flatten(F.collect_list("templates")).alias("templates"))
    paired = sample.select("text", pairs_of(words_of(F.col("text"))).alias("pairs")).crossJoin(F.broadcast(every))
    strangers = paired.where(~_confirmed("text", "pairs", "templates", training))
    return made.unionByName(strangers.select(F.lit(UNKNOWN).alias("family"), "text"))


def fit(spark: SparkSession, docs: DataFrame, training: Training = Training()) -> tuple[LogisticRegressionModel, float]:
    """The fitted model, and the probability from which on a family counts. `docs`: (id, text) rows."""
    families = [UNKNOWN, *TEMPLATES]
    folder = shared_folder(spark, "licences")
    training_rows(spark, docs, training).write.parquet(f"{folder}/rows")
    label = (F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1).cast("double")
    rows = _features(spark.read.parquet(f"{folder}/rows"), "text", training).withColumn("label", label)
    held = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    estimator = LogisticRegression(family="multinomial", regParam=0.001, maxIter=25, probabilityCol="probability")
    model = estimator.fit(rows.where(~held))
    scored = _scored(model, rows.where(held)).where("predicted > 0").select("best", (F.col("predicted") == F.col("label")).alias("right"))
    grid = [i / 20 for i in range(10, 20)]
    at_least = [F.avg(F.when(F.col("best") >= t, F.col("right").cast("double"))).alias(f"t{i}") for i, t in enumerate(grid)]
    precisions = scored.agg(*at_least).first()
    good = [t for t, p in zip(grid, precisions, strict=True) if p is not None and p >= training.precision]
    return model, min(good, default=grid[-1])


def _scored(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    probability = model.transform(rows).withColumn("probabilities", vector_to_array("probability"))
    best = F.array_max("probabilities")
    return probability.withColumn("best", best).withColumn("predicted", F.array_position("probabilities", best).cast("int") - 1)


def _judged(rows: DataFrame, training: Training) -> DataFrame:
    """doc, line_no, line, family, probability, confirmed of every line with a word of (id, text) rows."""
    spark = rows.sparkSession
    model, threshold = fit(spark, rows, training)
    families = [UNKNOWN, *TEMPLATES]
    scored = _scored(model, _features(candidate_lines(rows), "line", training))
    family = F.when(F.col("best") >= threshold, F.get(F.array(*map(F.lit, families)), F.col("predicted"))).otherwise(UNKNOWN)
    # `inline` has each line judged once; filters on the family as a column would judge it again.
    named = scored.select("doc", "line_no", "line", "pairs", F.inline(F.array(F.struct(family.alias("family"), F.col("best").alias("probability")))))
    joined = named.join(F.broadcast(_templates(spark)), "family", "left")
    confirmed = _confirmed("line", "pairs", "templates", training)
    return joined.select("doc", "line_no", "line", "family", "probability", confirmed.alias("confirmed"))


def notices(docs: DataFrame, training: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, line_no, line, family, probability, confirmed of each line with a word; `unknown` is never confirmed."""
    return _judged(narrow(docs, id=id_col, text=text_col), training).distinct()


def scan(docs: DataFrame, training: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_candidates (lines with a word), n_confirmed, families, places (line_no, family) of every document."""
    rows = narrow(docs, id=id_col, text=text_col)
    # Repeated rows give equal notices, which count once; only those leave their task.
    found = _judged(rows, training).where("confirmed").select("doc", F.struct("line_no", "family").alias("place")).distinct()
    by_doc = found.groupBy("doc").agg(F.count("*").alias("n_confirmed"), F.array_sort(F.collect_list("place")).alias("places"))
    none = F.array().cast("array<struct<line_no:int,family:string>>")
    judged = F.size(F.filter(F.coalesce(_lines("text"), F.array().cast("array<string>")), lambda line: line.rlike(WITH_WORD)))
    every = rows.select("id", _key().alias("key"), judged.cast("long").alias("n_candidates"))
    joined = every.join(by_doc, every.key == by_doc.doc, "left").withColumn("places", F.coalesce("places", none))
    return joined.select(
        F.col("id").alias("doc_id"),
        "n_candidates",
        F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"),
        F.array_sort(F.array_distinct(F.col("places.family"))).alias("families"),
        "places",
    )
