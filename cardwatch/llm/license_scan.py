"""Licence notices in documents by a trained paragraph classifier, with DataFrame, SQL and Spark ML functions only.

A paragraph is a line with a word. Its features are the word pairs and triples that occur in the templates below.
A multinomial logistic regression over these sparse features tells the licence families and `unknown` apart. It
is trained on pieces of the templates (windows of several lengths) and, for the unknown class, on the paragraphs of
`SAMPLE_DOCS` documents at most (those of smallest id hash) that resemble no template. A part of
these rows is kept back: it sets the temperature of the probabilities (least log loss), and the probability
below which a paragraph counts as unknown (at most `FALSE_SHARE` of the kept back unknown paragraphs pass it).
What passes is confirmed by comparison with the templates of its family: the share of shingles of three words that a
template and the paragraph have in common, of those of the shorter one, must reach `SIMILARITY`.

All paragraphs of all documents are scored, by one join of their hashed word pairs and triples with the weights. The
weights are as many as the templates have features, so that side's size does not grow with the documents.

Defined results: a null or empty text has no paragraph. Repeated rows get equal results, a null id stays null,
an empty table gives an empty one, other columns are not read. Without any paragraph to learn from, the
unknown class has only a paragraph without features.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import save

SAMPLE_DOCS = 1000
FALSE_SHARE = 0.001
SIMILARITY = 0.8
UNKNOWN = "unknown"
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]

# Common wordings of licence notices.
TEMPLATES = [
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("public-domain", "This work has been dedicated to the public domain."),
    ("public-domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("reserved", "All rights reserved."),
    ("reserved", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher."),
]


def _words(text: Column) -> Column:
    """Words of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _grams(words: str, n: int, value: str) -> str:
    """SQL: of the array of words, `value` (in terms of i) for each run of n words."""
    return f"if(size({words}) >= {n}, transform(sequence(0, size({words}) - {n}), i -> {value}), array())"


def _hashed(words: str = "words") -> Column:
    """Hashes of all word pairs and triples."""
    w = [f"{words}[i]", f"{words}[i + 1]", f"{words}[i + 2]"]
    pairs = _grams(words, 2, f"xxhash64({w[0]}, {w[1]})")
    triples = _grams(words, 3, f"xxhash64({w[0]}, {w[1]}, {w[2]})")
    return F.expr(f"concat({pairs}, {triples})").cast("array<bigint>")


def _shingles(words: str) -> Column:
    """Distinct shingles of three words (of the whole, if shorter)."""
    return F.expr(f"""array_distinct(if(size({words}) < 3, array(concat_ws(' ', {words})),
        {_grams(words, 3, f"concat_ws(' ', slice({words}, i + 1, 3))")}))""")


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from values, inside the plan."""
    data = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1, numPartitions=1).select(F.explode(data).alias("r")).select("r.*")


def templates(spark: SparkSession) -> DataFrame:
    rows = [{"family": f, "template": t} for f, t in TEMPLATES]
    return _table(spark, rows, "family:string,template:string").select("family", _words(F.col("template")).alias("words"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line and words of every line with a word."""
    lines = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line", "body"))
    return lines.select("doc_id", "text_hash", "line", _words(F.col("body")).alias("words")).where(F.size("words") > 0)


@dataclass
class Classifier:
    families: list[str]  # the unknown class first
    weights: list[tuple[int, list[float]]]  # hashed feature: weight per class
    bias: list[float]
    temperature: float
    least: float  # probability from which a family is told


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, false_share: float = FALSE_SHARE) -> Classifier:
    """Classifier of the template families, and of what the sampled paragraphs have besides."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer
    from pyspark.ml.functions import vector_to_array

    spark = docs.sparkSession
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    label = F.array_position(F.lit(families), F.col("family")).cast("double") - 1
    known = templates(spark)
    # windows of several lengths of each template
    sizes = F.explode(F.array(*[F.lit(n) for n in (3, 5, 8, 12, 20, 40)])).alias("n")
    parts = known.select("family", "words", sizes).select("family", "words", "n", F.explode(F.expr("sequence(1, greatest(1, size(words) - n + 1))")).alias("at"))
    parts = parts.select("family", F.expr("slice(words, at, n)").alias("words")).distinct()
    # pieces that several families have tell nothing
    w = Window.partitionBy("words")
    parts = parts.withColumn("owners", F.size(F.collect_set("family").over(w))).where("owners = 1").select("family", "words")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    n = chosen.count()
    share = min(1.0, 2.0 * sample_docs / max(1, n))
    order = F.xxhash64("doc_id")
    chosen = chosen.where(order / 2.0**64 + 0.5 <= share).orderBy(order, "doc_id", "text").limit(sample_docs)
    ours = sorted({s for r in known.select(_shingles("words").alias("s")).collect() for s in r["s"]})  # of the templates
    plain = paragraphs(chosen).where(~F.arrays_overlap(_shingles("words"), F.lit(ours)))
    plain = plain.select(F.lit(UNKNOWN).alias("family"), "words")
    empty = spark.range(1).select(F.lit(UNKNOWN).alias("family"), F.array().cast("array<string>").alias("words"))
    rows = parts.unionByName(plain).unionByName(empty).select(label.alias("label"), "family", "words", _hashed().cast("array<string>").alias("grams"))
    rows = save(rows.withColumn("back", F.pmod(F.xxhash64("words"), F.lit(5)) == 0), "license-rows")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0, vocabSize=1 << 16)
    vectors = vectors.fit(known.select(_hashed().cast("array<string>").alias("grams")))
    train = vectors.transform(rows.where("NOT back OR family != 'unknown'"))
    weigh = train.groupBy("label").count().withColumn("w", 1.0 / F.sqrt("count")).select("label", "w")
    learner = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, weightCol="w", labelCol="label")
    model = learner.fit(save(train.join(weigh, "label").select("label", "features", "w"), "license-train"))
    # temperature and least probability on the rows kept back
    scored = model.transform(vectors.transform(rows.where("back"))).select("label", vector_to_array("rawPrediction").alias("z"))
    scored = save(scored, "license-back")
    t = F.explode(F.array(*[F.lit(x) for x in TEMPERATURES])).alias("t")
    loss = scored.select("label", "z", t).select("t", F.expr("aggregate(z, 0D, (a, x) -> a + exp((x - array_max(z)) / t), a -> ln(a)) - (get(z, int(label)) - array_max(z)) / t").alias("loss"))
    best = loss.groupBy("t").agg(F.avg("loss").alias("loss")).orderBy("loss", "t").first()
    temperature = best["t"] if best else 1.0
    p = F.expr(f"aggregate(z, 0D, (a, x) -> a + exp((x - array_max(z)) / {temperature}D))")
    wrong = scored.where("label = 0").select((F.expr(f"exp((array_max(slice(z, 2, size(z) - 1)) - array_max(z)) / {temperature}D)") / p).alias("p"))
    cut = wrong.agg(F.percentile("p", 1 - false_share).alias("cut")).first()["cut"]
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    return Classifier(
        families,
        [(int(g), [float(x) for x in matrix[:, k]]) for k, g in enumerate(vectors.vocabulary)],
        [float(x) for x in bias],
        float(temperature),
        max(0.5, float(cut or 0.0)),
    )


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """n_paragraphs, n_notices (confirmed), n_rejected (told but not confirmed), licenses (families of
    the confirmed ones, in order), probability and similarity (the greatest of them) and lines of each row."""
    model = model or fit(docs)
    spark = docs.sparkSession
    k = len(model.families)
    weights = [{"gram": g, "w": w, "one": 0} for g, w in model.weights] + [{"gram": None, "w": model.bias, "one": 1}]
    weights = _table(spark, weights, "gram:bigint,w:array<double>,one:int")
    weights = weights.select(F.coalesce("gram", F.lit(0)).alias("gram"), "one", *[F.get("w", F.lit(j)).alias(f"w{j}") for j in range(k)])
    para = paragraphs(docs)
    # one row per feature (each once, as in training) and one for the bias, which also counts repeated rows
    marks = para.select("doc_id", "text_hash", "line", F.explode(F.concat(F.array_distinct(_hashed()), F.array(F.lit(0).cast("bigint")))).alias("gram"))
    score = marks.join(weights, "gram").groupBy("doc_id", "text_hash", "line").agg(
        F.sum("one").alias("copies"), *[F.sum(f"w{j}").alias(f"z{j}") for j in range(k)]
    )
    z = F.array(*[F.col(f"z{j}") / F.col("copies") / model.temperature for j in range(k)])
    told = score.select("doc_id", "text_hash", "line", z.alias("z"))
    told = told.select("doc_id", "text_hash", "line", "z", F.array_max("z").alias("top"))
    told = told.where(F.col("top") > F.get("z", F.lit(0))).select(
        "doc_id",
        "text_hash",
        "line",
        F.get(F.lit(model.families), F.array_position("z", F.col("top")).cast("int") - 1).alias("family"),
        (1 / F.expr("aggregate(z, 0D, (a, x) -> a + exp(x - top))")).alias("probability"),
    )
    told = save(told.where(F.col("probability") >= model.least), "license-told")
    # the words of what was told, against the templates of its family
    lines = told.select("doc_id", "text_hash").distinct()
    same = [F.col("doc_id").eqNullSafe(F.col("t_id")), F.col("text_hash") == F.col("t_hash")]
    wanted = lines.select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").join(wanted, same, "left_semi")
    keyed = told.select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), F.col("line").alias("t_line"), "family", "probability")
    bodies = paragraphs(texts).join(keyed, [*same, F.col("line") == F.col("t_line")]).drop("t_id", "t_hash", "t_line")
    bodies = bodies.groupBy("doc_id", "text_hash", "line").agg(F.first("family").alias("family"), F.first("probability").alias("probability"), F.first("words").alias("words"))
    against = templates(spark).select(F.col("family").alias("t_family"), _shingles("words").alias("theirs"))
    pairs = bodies.withColumn("ours", _shingles("words")).join(against, F.col("family") == F.col("t_family"))
    both = F.size(F.array_intersect("ours", "theirs")) / F.least(F.size("ours"), F.size("theirs"))
    found = pairs.groupBy("doc_id", "text_hash", "line", "family", "probability").agg(F.max(both).alias("similarity"))
    sure = F.col("similarity") >= SIMILARITY
    per_doc = found.groupBy("doc_id", "text_hash").agg(
        F.count_if(sure).alias("n_notices"),
        F.count_if(~sure).alias("n_rejected"),
        F.array_sort(F.collect_set(F.when(sure, F.col("family")))).alias("licenses"),
        F.max(F.when(sure, F.col("probability"))).alias("probability"),
        F.max(F.when(sure, F.col("similarity"))).alias("similarity"),
        F.array_sort(F.collect_set(F.when(sure, F.col("line")))).alias("lines"),
    )
    per_doc = per_doc.withColumnRenamed("doc_id", "t_id").withColumnRenamed("text_hash", "t_hash")
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[\\p{L}\\p{N}]"))).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), n_lines.alias("n_paragraphs"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        "n_paragraphs",
        zero("n_notices"),
        zero("n_rejected"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        "probability",
        "similarity",
        F.coalesce("lines", F.array().cast("array<int>")).alias("lines"),
    )
