"""Licence scan: a trained paragraph classifier whose findings templates confirm.

Only DataFrame and SQL functions and Spark's own logistic regression are used; no Python
runs on the executors.

* **Features**: distinct words and pairs of neighbouring words of a paragraph, as far as the
  templates have them.
* **Model**: one logistic regression over all licence families and the class ``unknown``,
  with an absolute-value penalty, so that few features keep a weight. It learns from the
  templates in several wrappings and with words left out, from look-alike prose, and from a
  bounded sample of the corpus' own paragraphs (``SAMPLE``) as unknown.
* **Calibration**: a temperature for the probabilities is chosen on training rows that were
  held out; a prediction needs a probability of ``CERTAIN``.
* **Confirmation**: the predicted family must have a template of whose distinct words the
  paragraph holds the share ``CONTAINED``. So a paragraph without a certain few words of
  every template can't be confirmed; the least common such words (``seldom``) are the exact
  filter before anything is split into words, and units that hold too little of every
  template are dropped before anything is written.

* **Units**: every line, and for notices that are wrapped over lines overlapping windows of
  words over the joined lines of a paragraph (up to a blank line): short windows for short
  templates, long ones for the others, each overlapping by more than its templates have words.
* **Several families**: beside the likeliest family, any family that is likelier than
  ``unknown`` counts if the unit also holds the share ``CONTAINED`` of those words of a
  template that no other family's templates have.

Equal units are classified once, however often they occur. A null or empty text has no
finding; rows that repeat an id each get the findings of the id; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectflow.llm.common import stored, text_of
from subjectflow.operators.joins import lookup_join

#: Paragraphs of the corpus that the model learns as unknown, about, at most.
SAMPLE = 2_000
CERTAIN = 0.5
CONTAINED = 0.6
UNKNOWN = "unknown"
#: Between paragraphs: a blank line.
BETWEEN = r"\n[ \t\r]*\n"
#: Words of a window; the next one begins half a window later.
WINDOWS = (24, 96)

# Notices by which works state their licence, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GPL.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "All rights reserved worldwide.",
        "Copyright 2020 by the authors. All rights reserved.",
        "Copyright holder. All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}

# Prose that looks like a notice and is none, and what notices are wrapped in.
LOOK_ALIKES = (
    "The driver must renew the license every year at the public office.",
    "A licensed physician may obtain a copy of the general report.",
    "Version 3 of the report was released to the public under new terms.",
    "The work of the foundation is free for all persons and has no conditions.",
    "She reserved a table under the name of the author.",
    "The following conditions are met with or without use of force.",
    "Software for general use is published in source form every year.",
    "The Apache helicopter was modified and released.",
    "Students at MIT released the software under pressure.",
    "All rooms are reserved.",
    "The commons is a public space and its creative use is permitted.",
)
WRAPPINGS = (
    ("", ""), ("Copyright 2020 the authors. ", ""), ("", " See the license file for details."), ("Note: ", " Thank you."),
    ("This file is part of the project. ", " It comes without any warranty."),
)
#: One word in so many is left out in copies of a template for training.
LEFT_OUT = 6


def words_of(text: Column) -> Column:
    """Lower-case words: letters and digits, and dots between digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0))


def grams_of(words: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, F.filter(pairs, lambda p: p.isNotNull())))


def _rows(spark: SparkSession, rows: list[tuple[str, ...]], names: tuple[str, ...]) -> DataFrame:
    """Literal rows without Python on the executors: one JSON literal, taken apart by SQL."""
    kind = f"array<struct<{','.join(f'{n}:string' for n in names)}>>"
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def templates(spark: SparkSession) -> DataFrame:
    """``family``, ``template``, ``words`` (distinct)."""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return _rows(spark, rows, ("family", "template")).withColumn("words", F.array_distinct(words_of(F.col("template"))))


def anchors(spark: SparkSession) -> str:
    """A pattern that every confirmable paragraph matches.

    A paragraph that holds the share ``CONTAINED`` of a template's words holds one of any set
    of more than the other words; the longest words are taken, for they are rare in prose.
    """
    found = set()
    for row in templates(spark).select("words").collect():
        words = sorted(row["words"], key=lambda w: (-len(w), w))
        may_lack = int(len(words) * (1 - CONTAINED) + 1e-9)
        found.update(words[: may_lack + 1])
    return r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(w.replace(".", r"\.") for w in sorted(found)) + r")(?![\p{L}\p{N}])"


def _training(spark: SparkSession, unknown: DataFrame) -> DataFrame:
    """``family``, ``grams``, ``held`` of the training rows."""
    # fixed, small lists
    wraps = _rows(spark, [(str(i), *w) for i, w in enumerate(WRAPPINGS)], ("w", "before", "after")).withColumn("w", F.col("w").cast("int"))
    wrapped = templates(spark).select("family", "template", F.explode(F.sequence(F.lit(0), F.lit(len(WRAPPINGS) - 1))).alias("w"))
    whole = wrapped.join(F.broadcast(wraps), "w").select("family", words_of(F.concat("before", "template", "after")).alias("words"))
    lacking = templates(spark).select("family", words_of(F.col("template")).alias("all"), F.explode(F.sequence(F.lit(0), F.lit(LEFT_OUT - 1))).alias("k"))
    lacking = lacking.filter(F.size("all") >= 5).select("family", F.filter("all", lambda _, i: (i + F.col("k")) % LEFT_OUT != 0).alias("words"))
    prose = _rows(spark, [(UNKNOWN, x) for x in LOOK_ALIKES], ("family", "text")).select("family", words_of(F.col("text")).alias("words"))
    # look-alikes weigh as much as a few templates
    prose = prose.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).select("family", "words")
    corpus = unknown.select(F.lit(UNKNOWN).alias("family"), words_of(F.col("paragraph")).alias("words"))
    rows = whole.unionByName(lacking).unionByName(prose).unionByName(corpus).select("family", grams_of(F.col("words")).alias("grams"), "words")
    return rows.select("family", "grams", (F.pmod(F.xxhash64("words"), F.lit(5)) == 0).alias("held"))


def train(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(``gram``, ``weights`` by class, already divided by the temperature; the classes, with the bias as gram '')."""
    spark = docs.sparkSession
    n = docs.count()
    threshold = min(1.0, SAMPLE / max(1, n))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) < int(threshold * (1 << 30)))
    # one line of each sampled document: the first of its first paragraph that no anchor marks (a line of a wrapped notice is not unknown)
    plain = F.filter(F.split(text_of(), BETWEEN), lambda p: (F.length(F.trim(p)) > 0) & ~p.rlike(anchors(spark)))
    plain = F.flatten(F.transform(plain, lambda p: F.filter(F.split(p, "\n"), lambda x: F.length(x) > 0)))
    unknown = some.select(F.try_element_at(plain, F.lit(1)).alias("paragraph")).filter(F.col("paragraph").isNotNull()).limit(2 * SAMPLE)
    rows = stored(_training(spark, unknown), "license-training")
    classes = [UNKNOWN, *sorted(TEMPLATES)]
    number = F.array_position(F.lit(classes), F.col("family")) - 1
    vocabulary = CountVectorizer(inputCol="grams", outputCol="x", binary=True, vocabSize=1 << 14).fit(rows.filter(F.col("family") != UNKNOWN))
    data = vocabulary.transform(rows).withColumn("y", number.cast("double"))
    fitted = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=2e-4, elasticNetParam=1.0, maxIter=80).fit(data.filter(~F.col("held")))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    table = [("", *map(float, bias))] + [(g, *map(float, matrix[:, i])) for i, g in enumerate(vocabulary.vocabulary) if matrix[:, i].any()]
    weights = _rows(spark, [(r[0], json.dumps(r[1:])) for r in table], ("gram", "w")).select("gram", F.from_json("w", "array<double>").alias("w"))
    weights = stored(weights, "license-weights")
    heat = _temperature(rows.filter("held"), weights, classes)
    return weights.select("gram", F.transform("w", lambda x: x / heat).alias("w")), classes


def _margins(rows: DataFrame, key: str, weights: DataFrame, classes: list[str]) -> DataFrame:
    """``key`` and ``m``, the margins by class, of rows with distinct keys and their ``grams``.

    The weights are at most the templates' grams (a fixed list): broadcast.
    """
    grams = rows.select(key, F.explode(F.concat(F.array(F.lit("")), "grams")).alias("gram"))
    sums = [F.sum(F.col("w")[i]).alias(f"m{i}") for i in range(len(classes))]
    return grams.join(F.broadcast(weights), "gram").groupBy(key).agg(*sums).select(key, F.array(*[F.col(f"m{i}") for i in range(len(classes))]).alias("m"))


def _softmax(m: Column) -> Column:
    top = F.array_max(m)
    return F.transform(m, lambda x: F.exp(x - top) / F.aggregate(F.transform(m, lambda y: F.exp(y - top)), F.lit(0.0), lambda a, b: a + b))


def _temperature(held: DataFrame, weights: DataFrame, classes: list[str]) -> float:
    """The divisor of the margins with the least log loss on held-out training rows."""
    keyed = held.withColumn("key", F.xxhash64("grams", "family")).dropDuplicates(["key"])
    rows = _margins(keyed, "key", weights, classes).join(keyed.select("key", "family"), "key")
    place = F.array_position(F.lit(classes), F.col("family")).cast("int")
    options = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0]

    def loss_at(heat: float) -> Column:
        return F.avg(-F.log(F.greatest(F.element_at(_softmax(F.transform("m", lambda x: x / heat)), place), F.lit(1e-9))))

    loss = [loss_at(t).alias(str(i)) for i, t in enumerate(options)]
    found = rows.agg(*loss).first()
    losses = [(x, t) for x, t in zip(found, options, strict=True) if x is not None]
    return min(losses)[1] if losses else 1.0


def classify(paragraphs: DataFrame, weights: DataFrame, classes: list[str]) -> DataFrame:
    """``key``, ``family``, ``probability``, ``template``, ``contained`` of the confirmed units, a row for each family.

    ``paragraphs``: distinct ``key``, the ``words`` and the ``window`` (0: a line) of each. A
    family that is not the likeliest has its probability against ``unknown`` alone.
    """
    rows = paragraphs.select("key", grams_of(F.col("words")).alias("grams"))
    scored = _margins(rows, "key", weights, classes).withColumn("p", _softmax(F.col("m")))
    # unknown is the first class
    against = F.transform("m", lambda x: 1 / (1 + F.exp(F.col("m")[0] - x)))
    one = F.transform(F.lit(classes), lambda c, i: F.struct(c.alias("family"), F.col("p")[i].alias("p"), against[i].alias("against"), (F.col("p")[i] == F.array_max("p")).alias("top")))
    scored = scored.select("key", F.inline(one)).withColumn("top", F.col("top") & (F.col("p") >= CERTAIN))
    scored = scored.filter((F.col("family") != UNKNOWN) & (F.col("top") | (F.col("against") >= CERTAIN)))
    likely = scored.select("key", "family", "top", F.when(F.col("top"), F.col("p")).otherwise(F.col("against")).alias("probability"))
    likely = likely.join(paragraphs.select("key", "words", "window"), "key")
    known = templates(paragraphs.sparkSession).withColumnRenamed("words", "its")
    # fixed, small lists
    owned = known.select("family", F.explode("its").alias("w")).distinct().groupBy("w").agg(F.count("*").alias("n"), F.first("family").alias("family"))
    owned = owned.filter("n = 1").groupBy("family").agg(F.collect_list("w").alias("owned"))
    known = known.join(F.broadcast(owned), "family", "left").withColumn("own", F.array_intersect("its", F.coalesce("owned", F.array().cast("array<string>")))).drop("owned")
    share = F.size(F.array_intersect("words", "its")) / F.size("its")
    # a try for no own words: null, which only the likeliest family of a unit may have
    own = F.try_divide(F.size(F.array_intersect("words", "own")), F.size("own"))
    short = F.size("its") <= WINDOWS[0] // 2
    fits = (F.col("window") == 0) | (F.col("window") == F.when(short, WINDOWS[0]).otherwise(WINDOWS[1]))
    certain = F.when(F.col("top") & (F.col("window") == 0), True).otherwise(F.coalesce(own >= CONTAINED, F.col("top")))
    held = likely.join(F.broadcast(known), "family").withColumn("contained", share).filter((F.col("contained") >= CONTAINED) & fits & certain)
    best_of = F.max(F.struct("contained", F.length("template"), "template")).alias("b")
    return held.groupBy("key", "family", "probability").agg(best_of).select("key", "family", "probability", "b.template", "b.contained")


def seldom(docs: DataFrame) -> list[str]:
    """Words of which every confirmable unit holds one, for each template those that the fewest texts hold.

    Any such choice loses nothing (see ``anchors``); how seldom a word is, is counted on about
    ``SAMPLE`` documents, for a choice with common words lets all prose through.
    """
    known = [sorted(r["words"]) for r in templates(docs.sparkSession).select("words").collect()]  # a fixed, small list
    used = Counter(w for words in known for w in words)
    share = min(1.0, SAMPLE / max(1, docs.count()))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * SAMPLE)
    has = F.transform(F.array(F.lower(text_of())), lambda t: F.filter(F.lit(sorted(used)), lambda w: F.contains(t, w)))
    texts = dict(some.select(F.explode(F.flatten(has)).alias("w")).groupBy("w").count().collect())
    found = set()
    for words in known:
        may_lack = int(len(words) * (1 - CONTAINED) + 1e-9)
        found.update(sorted(words, key=lambda w: (texts.get(w, 0), -used[w], -len(w), w))[: may_lack + 1])
    return sorted(found, key=lambda w: (-texts.get(w, 0), w))


def _any_in(text: Column, words: list[str]) -> Column:
    """The lower-case text holds one of the words (as a part of another, too). An element, so that the text is lowered once."""
    return F.exists(F.array(F.lower(text)), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in words]))


def _confirmable(spark: SparkSession) -> Column:
    """The unit's ``words`` hold the share ``CONTAINED`` of a template that may confirm units of its ``window``, as ``classify`` asks."""
    known = [sorted(r["words"]) for r in templates(spark).select("words").collect()]  # a fixed, small list

    def one_of(held: Column, some: list[list[str]]) -> Column:
        need = [next(k for k in range(len(t) + 1) if k / len(t) >= CONTAINED) for t in some]
        return (F.size(held) >= min(need)) & reduce(or_, [F.size(F.array_intersect(held, F.lit(t))) >= k for t, k in zip(some, need, strict=True)])

    held = F.array_intersect("words", F.lit(sorted(set().union(*known))))
    short = [t for t in known if len(t) <= WINDOWS[0] // 2]
    long = [t for t in known if len(t) > WINDOWS[0] // 2]
    here = F.col("window")
    return F.exists(F.array(held), lambda h: F.when(here == WINDOWS[0], one_of(h, short)).when(here == WINDOWS[1], one_of(h, long)).otherwise(one_of(h, known)))


def units(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``para``, ``line`` (from 1; 0: a window), ``window`` (its words; 0: a line), ``words`` of all units that may be confirmed.

    Texts are read once; nothing but units that hold enough of a template's words goes on.
    """
    words = seldom(docs)
    marked = docs.filter(_any_in(F.col("text"), words)).select("doc_id", F.posexplode(F.split("text", BETWEEN)).alias("para", "body"))
    marked = marked.filter(_any_in(F.col("body"), words))

    def unit(line: Column, window: int, its: Column) -> Column:
        return F.struct(line.cast("int").alias("line"), F.lit(window).alias("window"), its.alias("words"))

    lines = F.transform(F.split("body", "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i")))
    lines = F.transform(F.filter(lines, lambda x: _any_in(x["x"], words)), lambda x: unit(x["i"], 0, words_of(x["x"])))

    def windows(n: int) -> Column:
        def parts(every: Column) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.size(every), F.lit(1)), F.lit(n // 2))
            return F.transform(starts, lambda i: unit(F.lit(0), n, F.slice(every, i, n)))

        # a paragraph of one line has none
        wrapped = F.filter(F.array("body"), lambda b: F.contains(b, F.lit("\n")))
        return F.flatten(F.transform(F.transform(wrapped, words_of), parts))

    found = [lines, *[windows(n) for n in WINDOWS]]
    return marked.select("doc_id", "para", F.inline(F.concat(*found))).filter(_confirmable(docs.sparkSession))


def findings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``para``, ``line`` (0: a window), ``family``, ``probability``, ``template``, ``contained`` of all notices."""
    weights, classes = train(docs)
    key = F.md5(F.concat_ws(" ", F.col("window").cast("string"), F.array_join("words", " ")).cast("binary"))
    marked = stored(units(docs).withColumn("key", key), "license-paragraphs")
    distinct = stored(marked.groupBy("key").agg(F.first("words").alias("words"), F.first("window").alias("window")), "license-distinct")
    return _found_in(marked.select("doc_id", "para", "line", "key"), stored(classify(distinct, weights, classes), "license-classified"))


def _found_in(marked: DataFrame, classified: DataFrame) -> DataFrame:
    """The findings of each unit; a key may have several families, at most as many as there are: one row per key for the join."""
    found = F.collect_list(F.struct("family", "probability", "template", "contained")).alias("found")
    return lookup_join(marked, classified.groupBy("key").agg(found), ["key"], "inner").select("doc_id", "para", "line", F.inline("found"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``families`` (sorted, joined by a comma; null if none), ``notices``, ``probability`` (the highest)."""
    # a family that a paragraph's windows find counts once there, and not if one of its lines has it
    where = F.collect_set(F.when(F.col("line") > 0, F.col("line").cast("string")))
    places = findings(docs).groupBy("doc_id", "para", "family").agg(where.alias("lines"), F.max("probability").alias("probability"))
    places = places.withColumn("line", F.explode(F.when(F.size("lines") > 0, F.col("lines")).otherwise(F.array("family"))))
    found = places.groupBy("doc_id").agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"), F.countDistinct("para", "line").alias("notices"), F.round(F.max("probability"), 4).alias("probability")
    )
    found = found.withColumnRenamed("doc_id", "_found")
    rows = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_found")), "left")
    return rows.select("doc_id", "families", F.coalesce("notices", F.lit(0)).alias("notices"), "probability")
