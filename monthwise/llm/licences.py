"""Licence scans with DataFrame functions and Spark ML only.

Features are the two- and three-word sequences of the templates' lines, so the model is as large as the templates.
A multinomial logistic regression is trained on lines and parts of lines of the templates, on look-alikes, and on a
bounded sample of paragraphs of the scanned table (class ``unknown``); its probabilities are calibrated by one
temperature on parts kept aside.  A paragraph (line) of a document can only be other than unknown if it holds a
feature: all paragraphs are scanned for two-word features in generated code against the broadcast weights, and only
hits go on.  A family found is confirmed if the paragraph holds ``CONFIRM`` of the three-word sequences of one of the
family's lines.

Notices are often wrapped.  Each line is scanned together with the next two words of the lines after it (comment marks
and blank lines are no words; up to ``GAP`` such characters may lie between).  Where a three-word feature runs over a
line's end, the line and the next one with words belong together, and the whole run of lines is judged as one paragraph
too.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import col, written
from monthwise.llm.decontamination import BETWEEN_ANY_CASE, words

UNKNOWN = "unknown"
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS = 256, 2000
CONFIRM = 0.6
ACCEPT = 0.5
GAP = 200
NEXT_WORDS = (rf"\n+(?=((?:{BETWEEN_ANY_CASE[:-1]}{{0,{GAP}}}+[^{BETWEEN_ANY_CASE[1:-2]}]++){{0,2}}+))")

# Notices by which public licences are named or begun.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0 Universal, public domain dedication.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Released under the BSD 3-Clause License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}
# Lines that speak of licences without granting a known one.
LOOK_ALIKES = [
    "All rights reserved. No part of this work may be copied.", "Licensed under the terms of your contract.",
    "You need a license to drive a car.", "The license fee is due every month.",
    "This work is licensed under an agreement with the publisher.", "Released under the old name in May.",
    "The general public is free to use the park.", "See the license page for prices and conditions.",
]


def grams(w: Column, n: int) -> Column:
    """The ``n``-word sequences of an array of words, as text."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n),
                                              lambda p: F.array_join(F.slice(w, p + 1, n), " "))
                  ).otherwise(F.array().cast("array<string>"))


def _training_lines() -> list[tuple[str, str, int]]:
    """(family, text, part): every line, and each run of at least five words that starts or ends it; every fourth
    part is kept aside (part 1) for the calibration."""
    out = []
    for family, lines in {**TEMPLATES, UNKNOWN: LOOK_ALIKES}.items():
        for line in lines:
            w = line.split()
            out.append((family, line, 0))
            parts = [w[:n] for n in range(5, len(w))] + [w[n:] for n in range(1, len(w) - 4)]
            out += [(family, " ".join(p), int(i % 4 == 3)) for i, p in enumerate(parts)]
    return out


def train(docs: DataFrame, id_col: str, text_col: str, sample_documents: int = SAMPLE_DOCUMENTS,
          sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> dict:
    """Classes, intercepts, temperature and the weights of each feature."""
    spark = docs.sparkSession
    lines = spark.createDataFrame(_training_lines(), "family string, text string, part int")
    lines = lines.withColumn("w", words(F.col("text")))
    both = F.array_distinct(F.concat(grams(F.col("w"), 2), grams(F.col("w"), 3)))
    lines = lines.select("family", "part", both.alias("g"))
    vocabulary = [r["g"] for r in lines.where(F.col("family") != UNKNOWN).select(F.explode("g").alias("g")).distinct()
                  .orderBy("g").collect()]
    some = docs.where(col(id_col).isNotNull()).select(col(id_col).alias("id")).distinct().orderBy(
        F.xxhash64("id"), "id").limit(sample_documents)
    known = F.array(*[F.lit(g) for g in vocabulary if g.count(" ") == 2])
    sample = (docs.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(some), "id")
              .select(F.explode(F.split("text", "\n+")).alias("line"))
              .orderBy(F.xxhash64("line"), "line").limit(sample_paragraphs)
              .select(words(F.col("line")).alias("w"))
              .select(F.array_distinct(F.concat(grams(F.col("w"), 2), grams(F.col("w"), 3))).alias("g"))
              .where(~F.arrays_overlap("g", known)))
    rows = lines.unionByName(sample.select(F.lit(UNKNOWN).alias("family"),
                                           F.pmod(F.xxhash64("g"), F.lit(4)).cast("int").alias("part"), "g"))
    classes = [*TEMPLATES, UNKNOWN]
    label = F.coalesce(*[F.when(F.col("family") == c, float(i)) for i, c in enumerate(classes)])
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="g", outputCol="features")
    vectors.setBinary(True)
    rows = vectors.transform(rows.select(label.alias("label"), (F.col("part") == 1).alias("aside"), "g")).coalesce(1)
    rows = rows.select("label", "features", "aside").cache()
    try:
        model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(rows.where("NOT aside"))
        aside = [(list(r["rawPrediction"]), int(r["label"])) for r in
                 model.transform(rows.where("aside")).select("rawPrediction", "label").collect()]
    finally:
        rows.unpersist()
    matrix = model.coefficientMatrix.toArray()
    return {"classes": classes, "intercepts": model.interceptVector.toArray().tolist(),
            "temperature": temperature(aside), "weights": {g: matrix[:, i].tolist() for i, g in enumerate(vocabulary)}}


def temperature(rows: list[tuple[list[float], int]]) -> float:
    """The divisor of the logits, between 0.25 and 4, with the least log loss."""
    def loss(t: float) -> float:
        total = 0.0
        for logits, label in rows:
            z = [x / t for x in logits]
            top = max(z)
            total += top + math.log(sum(math.exp(x - top) for x in z)) - z[label]
        return total
    return min((2 ** (i / 8) for i in range(-16, 17)), key=loss) if rows else 1.0


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT,
                  confirm: float = CONFIRM, sample_documents: int = SAMPLE_DOCUMENTS,
                  sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> DataFrame:
    """Licence families named in the paragraphs (lines, and runs of lines over which a notice is wrapped) of every
    document.

    Returns per input row: the id, ``n_findings``, ``families`` (sorted, distinct, of accepted findings that a
    template confirms), ``findings``: array of (paragraph from 0, family, probability, similarity, confirmed) in
    order; a finding is a paragraph whose likeliest class is a family with at least ``accept`` probability.  A run of
    lines has the number of its first line; it takes the place of its lines' findings, but for those that confirm
    another family.

    Only the unknown class is fitted on the scanned table, by ``sample_paragraphs`` whole lines of ``sample_documents``
    documents that share no three words with a template, chosen by their hashes; every line of every document is scanned.

    Null and empty texts, and texts without licence words, have no findings.  Ties go to the family named first.
    Null ids and repeated rows get the figures of their own text.  An empty table gives an empty result.  Other
    columns are dropped, so extra names can't clash.
    """
    spark = docs.sparkSession
    model = train(docs, id_col, text_col, sample_documents, sample_paragraphs)
    return _scan(spark, docs, model, id_col, text_col, accept, confirm)


def _scan(spark: SparkSession, docs: DataFrame, model: dict, id_col: str, text_col: str, accept: float,
          confirm: float) -> DataFrame:
    weights = spark.createDataFrame([(g, g.count(" ") + 1, w) for g, w in model["weights"].items()],
                                    "g string, n int, weights array<double>")
    weights = weights.select(F.xxhash64(F.split("g", " ")).alias("key"), F.split("g", " ").alias("seq"), "n", "weights")
    lines = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(
        (f, t) for f, ts in TEMPLATES.items() for t in ts)], "line int, of string, text string")
    lines = lines.select("line", "of", F.array_distinct(grams(words(F.col("text")), 3)).alias("g"))
    lines = lines.select("line", "of", F.size("g").alias("size"), F.explode("g").alias("gram"))
    # Both tables are as large as the templates, whatever is scanned.
    two = F.broadcast(weights.where("n = 2"))
    # A line ends with \x02; after its words follow \x01 and the next two words, line ends between them included.
    marked = F.regexp_replace(F.translate(col(text_col), "\x01\x02", "  "), NEXT_WORDS, "\x01$1\x02")
    paragraphs = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"),
                             F.posexplode(F.split(F.concat(marked, F.lit("\x01")), "\x02")).alias("paragraph", "line"))
    after = F.substring_index("line", "\x01", -1)
    lines_on = F.size(F.split(F.regexp_extract(after, f"^{BETWEEN_ANY_CASE}", 0), "\n+"))
    at = (paragraphs.select("id", "h", "paragraph", words(F.col("line")).alias("w"),
                            F.size(words(after)).alias("after"), (F.col("paragraph") + lines_on).alias("next"))
          .select("id", "h", "paragraph", "w", "next", (F.size("w") - F.col("after")).alias("own"),
                  F.posexplode("w").alias("p", "first")).where("p < own AND p + 2 <= size(w)")
          .withColumn("key2", F.expr("xxhash64(slice(w, p + 1, 2))")))
    pairs = at.join(two, F.expr("key2 = key AND slice(w, p + 1, 2) = seq")).select(
        "id", "h", "paragraph", F.slice("w", F.col("p") + 1, 3).alias("three"), "seq", "weights",
        F.expr("p + 2 > own").alias("over2"), F.expr("p + 3 > own").alias("over"), "next")
    three = F.broadcast(weights.where("n = 3").select(F.col("seq").alias("seq3"), F.col("weights").alias("weights3")))
    two_words, three_words = F.struct("seq", "weights"), F.struct(F.col("seq3").alias("seq"),
                                                                  F.col("weights3").alias("weights"))
    found = lambda feature, where: F.collect_set(F.when(F.expr(where), feature))
    by_line = (pairs.join(three, F.expr("three = seq3"), "left").groupBy("id", "h", "paragraph").agg(
                   F.concat(found(two_words, "NOT over2"), found(three_words, "NOT over AND seq3 IS NOT NULL")).alias("hits"),
                   F.concat(found(two_words, "over2"), found(three_words, "over AND seq3 IS NOT NULL")).alias("over"),
                   F.max(F.expr("IF(over AND seq3 IS NOT NULL, next, NULL)")).alias("next")))
    by_line = written(by_line, "hits")  # texts are scanned once
    in_doc = Window.partitionBy("id", "h").orderBy("paragraph")
    by_line = (by_line.withColumn("joined", F.lag("next").over(in_doc).eqNullSafe(F.col("paragraph")))
               .withColumn("run", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(in_doc)))
    runs = (by_line.groupBy("id", "h", "run").agg(
                F.min("paragraph").alias("paragraph"), F.max("next").alias("next"),
                F.array_distinct(F.flatten(F.collect_list(F.concat("hits", "over")))).alias("hits"))
            .where("next IS NOT NULL").select("id", "h", "run", "paragraph", "hits", F.lit(True).alias("wide")))
    hits = by_line.where("size(hits) > 0").select("id", "h", "run", "paragraph", "hits", F.lit(False).alias("wide"))
    hits = hits.unionByName(runs)
    intercepts = F.array(*[F.lit(x) for x in model["intercepts"]])
    logits = F.aggregate("hits", intercepts, lambda a, x: F.zip_with(a, x["weights"], lambda p, q: p + q))
    scaled = F.transform(logits, lambda x: x / F.lit(model["temperature"]))
    scored = hits.withColumn("z", scaled).withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(c) for c in model["classes"]])
    scored = (scored.withColumn("probability", 1 / total)
              .withColumn("family", F.element_at(names, F.array_position("z", F.col("top")).cast("int")))
              .where((F.col("family") != UNKNOWN) & (F.col("probability") >= accept)))
    compared = (scored.select("id", "h", "paragraph", "wide", "family", "probability",
                              F.explode(F.filter("hits", lambda x: F.size(x["seq"]) == 3)["seq"]).alias("s"))
                .withColumn("gram", F.array_join("s", " ")).join(F.broadcast(lines), "gram")
                .where("of = family").groupBy("id", "h", "paragraph", "wide", "line")
                .agg((F.count_distinct("gram") / F.first("size")).alias("share"))
                .groupBy("id", "h", "paragraph", "wide").agg(F.max("share").alias("share")))
    scored = scored.alias("s").join(compared.alias("c"), F.expr(
        "s.id <=> c.id AND s.h = c.h AND s.paragraph = c.paragraph AND s.wide = c.wide"), "left").select(
        "s.id", "s.h", "s.run", "s.paragraph", "s.wide", "family", "probability",
        F.coalesce("share", F.lit(0.0)).alias("similarity"))
    # A line of a run whose family is found says no more, unless it confirms another family.
    of_run = F.max(F.when(F.col("wide"), F.col("family"))).over(Window.partitionBy("id", "h", "run"))
    scored = scored.withColumn("of_run", of_run).where(
        F.col("wide") | F.col("of_run").isNull()
        | ((F.col("of_run") != F.col("family")) & (F.col("similarity") >= confirm)))
    finding = F.struct("paragraph", "family", "probability", "similarity",
                       (F.col("similarity") >= confirm).alias("confirmed"))
    per_doc = scored.groupBy(F.col("id").alias("fid"), F.col("h").alias("fh")).agg(
        F.array_sort(F.collect_set(finding)).alias("findings"))
    none = "CAST(array() AS array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>)"
    out = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h")).join(
        per_doc, F.expr("id <=> fid AND h = fh"), "left").withColumn("findings", F.coalesce("findings", F.expr(none)))
    families = F.array_sort(F.array_distinct(F.filter("findings", lambda x: x["confirmed"])["family"]))
    return out.select(F.col("id").alias(id_col), F.size("findings").cast("long").alias("n_findings"),
                      families.alias("families"), "findings")
