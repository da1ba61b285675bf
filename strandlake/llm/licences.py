"""Licence notices by a trained paragraph classifier (operator 8), with DataFrame functions and MLlib only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import stage
from .textkit import whole_texts

UNKNOWN = "unknown"
#: weight at most, in pieces of templates, of all corpus lines that train "no licence", however many they are
BACKGROUND = 2000
#: an n-gram in more than this share of the background says nothing and is no feature
COMMON = 0.005
#: share of a background paragraph's chance to be accepted as a family
FALSE_ALARM = 0.001
#: paragraphs as a whole that are sent to all tasks at most, by key
FEW_HITS = 1 << 20
#: a prediction is confirmed if this share of a template's n-grams is in the paragraph, or of its in a template
CONFIRM = 0.5

# fixed values: customary notices, by family
TEMPLATES = [
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC BY", "Licensed under CC BY 4.0."),
    ("CC BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0", "Released under CC0 1.0 Universal."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("MPL", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSL", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL", "SPDX-License-Identifier: BSL-1.0"),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL", "SPDX-License-Identifier: EPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("CC BY-ND", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC BY-ND", "Licensed under CC BY-ND 4.0."),
    ("CC BY-NC-SA", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC BY-NC-SA", "Licensed under CC BY-NC-SA 4.0."),
    ("CC BY-NC-ND", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC BY-NC-ND", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0", "SPDX-License-Identifier: CC0-1.0"),
    ("Reserved", "All rights reserved."),
    ("Reserved", "Copyright (c) the authors. All rights reserved."),
]


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def pairs(w: Column) -> Column:
    """Hashes of the two-word sequences, the last entry null."""
    return F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))


def grams(w: Column) -> Column:
    """Distinct hashes of the two-word and three-word sequences."""
    two = pairs(w)
    three = F.zip_with(two, F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    return F.array_compact(F.array_distinct(F.concat(two, three)))


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph (line number from 0), body: the lines of each whole text that hold a word."""
    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(
            F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")).alias("paragraph", "body"))
        .filter(F.trim("body") != "")
    )


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph (number of its first line, from 0), body: runs of lines up to a blank one, of each whole text."""
    lines, text = F.split("text", "\n"), F.col("text")
    full = lambda c: c.rlike(r"[^\x20\x09-\x0D]")
    starts = F.filter(
        F.transform("kept", lambda k, i: F.when(k & ((i == 0) | ~F.get("kept", i - 1)), i)), lambda i: i.isNotNull())
    runs = F.filter(F.split(text, r"\n(?:[\x20\x09\x0B-\x0D]*+\n)++"), full)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marked = rows.select("doc_id", F.transform(lines, full).alias("kept"), runs.alias("runs"))
    return marked.select("doc_id", F.inline(F.arrays_zip(starts.alias("paragraph"), F.col("runs").alias("body"))))


@dataclass
class LicenceModel:
    families: list[str]
    rows: list[tuple]  # (gram, weight of each class), the first class is "unknown"
    intercepts: list[float]
    thresholds: list[float]
    cues: list[int]  # hashes of two words, one of which is in every paragraph that holds a feature


def _scored(found: DataFrame, keys: list[str], spark: SparkSession, model: LicenceModel) -> DataFrame:
    """Best family and its probability of each paragraph that holds a feature; found: keys, gram."""
    n = len(model.families)
    weights = spark.createDataFrame(model.rows, "gram long, w array<double>")
    odds = found.join(F.broadcast(weights), "gram").groupBy(*keys).agg(
        *[(F.sum(F.col("w")[k]) + F.lit(model.intercepts[k])).alias(f"o{k}") for k in range(n)])
    top = F.greatest(*[F.col(f"o{k}") for k in range(n)])
    total = sum((F.exp(F.col(f"o{k}") - top) for k in range(1, n)), F.exp(F.col("o0") - top))
    best = F.greatest(*[F.struct(F.col(f"o{k}").alias("odds"), F.lit(k).alias("k")) for k in range(1, n)])
    return odds.select(*keys, best.alias("best"), top.alias("top"), total.alias("total")).select(
        *keys, F.col("best.k").alias("k"), (F.exp(F.col("best.odds") - F.col("top")) / F.col("total")).alias("probability"))


def fit(docs: DataFrame) -> LicenceModel:
    """Multinomial logistic regression on pieces of the templates and the lines of the corpus.

    The distinct lines of all whole texts are the background, half to train, half to set the
    thresholds; lines that share a three-word sequence with a template are left out of it.
    What is left holds two of the templates' sequences at most, so that equal sets of them are
    one row with a count, of which there are few however large the corpus. Many lines weigh
    as much as ``BACKGROUND`` pieces together.
    """
    spark = docs.sparkSession
    families = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES)]
    templates = spark.createDataFrame(
        [(i, families.index(f), t) for i, (f, t) in enumerate(TEMPLATES)], "template int, label int, body string"
    ).withColumn("w", F.filter(words(F.col("body")), lambda x: x != ""))
    size = F.size("w")
    pieces = (
        templates.withColumn("n", F.explode(F.array_distinct(F.array(
            size, F.ceil(size * 0.8).cast("int"), F.ceil(size * 0.6).cast("int"))))).filter("n >= 2")
        .withColumn("s", F.explode(F.sequence(F.lit(1), size - F.col("n") + 1)))
        .select("label", grams(F.slice("w", F.col("s"), F.col("n"))).alias("grams"))
    )
    known = [r["gram"] for r in templates.select(F.explode(grams(F.col("w"))).alias("gram")).distinct().collect()]
    w = F.col("w")
    # a line without a known two-word sequence holds no longer one either
    own = F.when(F.exists(pairs(w), lambda g: g.isin(known)), F.sort_array(F.filter(grams(w), lambda g: g.isin(known))))
    # words as a column of their own are made once a line
    lines = lines_of(whole_texts(docs)).select(F.xxhash64("body").alias("id"), words(F.col("body")).alias("w")).select("id", own.alias("grams"))
    half = F.pmod("id", F.lit(2)).alias("half")
    distinct = lines.groupBy("id").agg(F.any_value("grams", True).alias("grams")).select(half, F.coalesce("grams", F.array().cast("array<bigint>")).alias("grams"))
    # two shared n-grams in a row are a three-word sequence
    sets = stage(distinct.withColumn("grams", F.when(F.size("grams") < 3, F.col("grams"))).groupBy("half", "grams").agg(F.count("*").alias("n")), "background")
    n_lines = sets.agg(F.sum("n")).first()[0] or 0
    sets = sets.filter("grams is not null")
    counts = {r["gram"]: r["n"] for r in sets.select(F.explode("grams").alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    vocabulary = sorted(g for g in known if counts.get(g, 0) <= COMMON * max(1, n_lines))
    parts = templates.select(F.explode(F.arrays_zip(
        pairs(F.col("w")).alias("first"), F.slice(pairs(F.col("w")), 2, 1 << 20).alias("second"), F.slice("w", 3, 1 << 20).alias("third"))).alias("p")
    ).select("p.first", "p.second", F.when(F.col("p.third").isNotNull(), F.xxhash64("p.first", "p.third")).alias("three")).distinct().collect()
    features, cues = set(vocabulary), set()
    for r in parts:
        if r["first"] in features:
            cues.add(r["first"])
        if r["three"] in features and not {r["first"], r["second"]} & cues:
            cues.add(min(r["first"], r["second"], key=lambda g: counts.get(g, 0)))
    n_half = {r["half"]: r["n"] for r in sets.groupBy("half").agg(F.sum("n").alias("n")).collect()}
    weight = min(1.0, BACKGROUND / max(1, n_half.get(0, 0)))
    train = pieces.withColumn("weight", F.lit(1.0)).unionByName(
        sets.filter("half = 0").select(F.lit(0).alias("label"), "grams", (F.col("n") * weight).alias("weight")))
    tokens = F.transform("grams", lambda g: g.cast("string"))
    counter = CountVectorizerModel.from_vocabulary(
        [str(g) for g in vocabulary], inputCol="tokens", outputCol="features", minTF=1.0)
    counter.setBinary(True)
    features = counter.transform(train.select(F.col("label").cast("double").alias("label"), tokens.alias("tokens"), "weight")).cache()
    fitted = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, weightCol="weight").fit(features)
    features.unpersist()
    matrix = fitted.coefficientMatrix.toArray()
    model = LicenceModel(
        families, [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary)],
        [float(x) for x in fitted.interceptVector.toArray()], [0.5] * len(families), sorted(cues))
    held = sets.filter("half = 1").select(F.xxhash64("grams").alias("id"), "grams", "n")
    judged = _scored(held.select("id", "n", F.explode("grams").alias("gram")), ["id", "n"], spark, model)
    # of each family's probabilities the first, from the top, that is beyond the number allowed
    down = Window.partitionBy("k").orderBy(F.desc("probability"))
    beyond = judged.groupBy("k", "probability").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down)).filter(
        F.col("upto") > int(FALSE_ALARM * max(1, n_half.get(1, 0))))
    for r in beyond.groupBy("k").agg(F.max("probability").alias("p")).collect():
        model.thresholds[r["k"]] = max(0.5, r["p"] + 1e-9)
    return model


def _hits(rows: DataFrame, keys: list[str], spark: SparkSession, model: LicenceModel) -> DataFrame:
    """Keys, family and probability of the rows (keys, body) that reach their family's threshold; a written table."""
    features = spark.createDataFrame([(g,) for g, _ in model.rows], "gram long")
    held = rows.select(*keys, F.explode(grams(words(F.col("body")))).alias("gram")).join(F.broadcast(features), "gram", "left_semi")
    scored = _scored(held.distinct(), keys, spark, model)  # a repeated row counts once
    names, limits = F.array(*map(F.lit, model.families)), F.array(*map(F.lit, model.thresholds))
    reached = F.col("probability") >= F.element_at(limits, F.col("k") + 1)
    return stage(scored.withColumn("family", F.element_at(names, F.col("k") + 1)).filter(reached).drop("k"), "notice_hits")


def _compared(hits: DataFrame, keys: list[str], spark: SparkSession) -> DataFrame:
    """Hits (with body) with the shares that compare them with their family's templates."""
    known = spark.createDataFrame(TEMPLATES, "family string, notice string").select(
        "family", grams(F.filter(words(F.col("notice")), lambda x: x != "")).alias("theirs"))
    own = grams(F.filter(words(F.col("body")), lambda x: x != ""))
    shared = F.size(F.array_intersect("own", "theirs"))
    return (
        hits.withColumn("own", own).drop("body").join(F.broadcast(known), "family")
        .select(*keys, "family", "probability", (shared / F.greatest(F.size("theirs"), F.lit(1))).alias("a"),
                (shared / F.greatest(F.size("own"), F.lit(1))).alias("b"))
        .groupBy(*keys, "family", "probability").agg(F.max("a").alias("template_share"), F.max("b").alias("own_share"))
        .withColumn("confirmed", (F.col("template_share") >= CONFIRM) | (F.col("own_share") >= CONFIRM))
    )


def scan_licences(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """One row per notice: doc_id, paragraph, lines, family, probability, template_share, own_share, confirmed.

    A paragraph is a run of lines up to a blank one; ``paragraph`` is the number of the
    first line, ``lines`` how many the notice spans. Its two- and three-word sequences, as
    far as they occur in the training templates, are the features of a multinomial logistic
    regression over licence families and "unknown". A family is reported if its probability
    reaches a threshold set so that at most ``FALSE_ALARM`` of held-out corpus lines would.
    Comparison with the templates of that family then confirms it: ``template_share`` of a
    template's sequences are in the paragraph, or ``own_share`` of the paragraph's in a template.

    Every paragraph of every whole text is looked at; one that holds none of the model's
    two-word cues holds no feature and goes no further. The others are scored as a whole
    and line by line. A single line that is confirmed stands for itself, and its paragraph is
    not reported with that family again; a line goes whose paragraph, as a whole, agrees
    better with a template of another family.

    Null and empty texts have no paragraph. Rows that repeat an id, a place and a paragraph
    are reported once. Rows with a null id are reported with it. Empty table: no rows.
    """
    spark = docs.sparkSession
    model = model or fit(docs)
    cued = F.exists(pairs(words(F.col("body"))), lambda g: g.isin(model.cues))
    # without blank lines in front, the first line is the one that ``paragraph`` counts
    body = F.regexp_replace("body", r"^(?:[\x20\x09\x0B-\x0D]*+\n)++", "")
    runs = stage(paragraphs(docs).filter(cued).select("doc_id", F.col("paragraph").cast("long").alias("first"), body.alias("run"))
                 .withColumn("mark", F.xxhash64("run")), "notices", "zstd")
    of_run = ["doc_id", "first", "mark"]
    lines = runs.select(*of_run, F.posexplode(F.split("run", "\n")).alias("at", "body")).filter(cued)
    of_line = [*of_run, "paragraph", "body"]
    single = _hits(lines.withColumn("paragraph", F.col("first") + F.col("at")), of_line, spark, model)
    single = _compared(single, of_line[:-1], spark)
    several = runs.filter(F.trim("run").contains("\n")).select(*of_run, F.col("run").alias("body"))
    whole = _hits(several, of_run, spark, model).withColumnsRenamed({"doc_id": "_id", "first": "_first", "mark": "_mark"})
    if whole.count() <= FEW_HITS:  # else the paragraphs are shuffled to them
        whole = F.broadcast(whole)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("first") == F.col("_first")) & (F.col("mark") == F.col("_mark"))
    whole = several.join(whole, same).withColumn("lines", F.size(F.split(F.rtrim("body"), "\n")).cast("long"))
    whole = _compared(whole.select(*of_run, "lines", "body", "family", "probability"), [*of_run, "lines"], spark)
    columns = [*of_run, "paragraph", "lines", "family", "probability", "template_share", "own_share", "confirmed"]
    found = single.withColumn("lines", F.lit(1).cast("long")).select(*columns).unionByName(
        whole.withColumn("paragraph", F.col("first")).select(*columns))
    about = Window.partitionBy(*of_run)  # the notices of one paragraph
    alone = F.col("lines") == 1
    of = F.struct(F.col("template_share"), F.col("family"))
    found = found.withColumns({
        "by_line": F.collect_set(F.when(alone & F.col("confirmed"), F.col("family"))).over(about),
        "by_run": F.max(F.when(~alone & F.col("confirmed"), of)).over(about)})
    better = (F.col("by_run.family") != F.col("family")) & (F.col("by_run.template_share") > F.col("template_share"))
    keep = F.when(alone, ~F.coalesce(better, F.lit(False))).otherwise(~F.array_contains("by_line", F.col("family")))
    return found.filter(keep).select(
        "doc_id", "paragraph", "lines", "family", "probability", "template_share", "own_share", "confirmed")
