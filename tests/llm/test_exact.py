"""Exact copies beside SQL and on odd rows; licence notices; the pipeline; what is registered."""

import hashlib
import math
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from scripts.check_oracle import compare
from strandlake.llm import exact_dedup, licences, queries
from strandlake.llm.ngram_jaccard import link_components

SCHEMA = "doc_id long, text string, norm string, len int, rank int"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, duck, sf_dir, name):
    line, ok, _ = compare(spark, duck, sf_dir, name, queries.QUERIES[name], queries.ORACLE[name])
    assert ok, line


def test_odd_rows(spark):
    rows = [(4, "a b"), (2, "ab"), (3, "a  b"), (9, "a\tb\n"), (9, "a\tb\n"), (5, None), (6, ""), (7, " "), (None, "ab     "),
            (None, "only"), (8, "é" * 100_000)]
    got = exact_dedup.exact_dedup(spark.createDataFrame([(*r, "n", 1, 2) for r in rows], SCHEMA)).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_sha256, []).append((r.doc_id, r.keep_id, r.group_size, r.kept))
    of = lambda t: sorted(by_text[hashlib.sha256(t.encode()).hexdigest()], key=str)
    assert of("ab") == sorted([(4, 3, 6, False), (2, 3, 6, False), (3, 3, 6, True), (9, 3, 6, False), (9, 3, 6, False),
                               (None, 3, 6, False)], key=str)
    assert of("") == sorted([(5, 7, 3, False), (6, 7, 3, False), (7, 7, 3, True)], key=str)
    assert of("only") == [(None, None, 1, True)]
    assert of("é" * 100_000) == [(8, 8, 1, True)]
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_of_frequent_contents(spark):
    """Contents in many shares give the rows of one share; the digest stands for the text outside of them."""
    rows = [(i, ["hot text", "hottext ", "warm", f"own {i}"][0 if i % 3 == 0 else i % 4], "n", 1, 2) for i in range(600)]
    df = spark.createDataFrame(rows + rows[:7] + [(None, "hot  text", "n", 1, 2)], SCHEMA).repartition(5)
    want = sorted(map(tuple, exact_dedup.exact_dedup(df, copies=10_000).collect()), key=str)
    assert sorted(map(tuple, exact_dedup.exact_dedup(df, copies=3).collect()), key=str) == want
    best = {r[4]: r for r in want if r[3]}[hashlib.sha256(b"hottext").hexdigest()]
    assert best[0] == best[1] == 0 and best[2] > 200


def test_texts_are_shuffled_once_and_by_ranges(spark, sf_dir):
    plan = queries.op10_exact_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"rangepartitioning\(begin", plan) and not re.search(r"hashpartitioning\([^)]*norm", plan)


def test_kept_rows(spark):
    rows = [(1, "a b", "x"), (2, "ab", "y"), (1, "a b", "x"), (3, None, "z"), (None, "q", "w")]
    got = exact_dedup.keep_distinct(spark.createDataFrame(rows, "doc_id long, text string, _id string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)


def test_no_python_in_native_plans(spark, sf_dir):
    for name in ("op10_exact_dedup", "op8_licences"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


HEADERS = {
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "AGPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""",
    "Apache": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance
with the License.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSL": """Distributed under the Boost Software License,
Version 1.0. (See accompanying file
LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)""",
    "EPL": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0""",
    "CC BY-ND": """This work is licensed under a Creative Commons
Attribution-NoDerivatives 4.0 International License.""",
    "CC BY-NC-SA": """This work is licensed under a Creative Commons
Attribution-NonCommercial-ShareAlike 4.0 International License.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}


def test_wrapped_notices_of_many_families(spark):
    model = licences.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    lead = " \n\nSome words about a river.\nAnd more of them.\n\t\n"
    docs = spark.createDataFrame(
        [(k, lead + text + "\n\nThe end of it.", "x") for k, text in enumerate(HEADERS.values())]
        + [(100, "The general public may publish terms of the river foundation.", "x")], "doc_id long, text string, runs string")
    rows = licences.scan_licences(docs, model).collect()
    for k, family in enumerate(HEADERS):
        own = [r for r in rows if r.doc_id == k and r.confirmed]
        assert {r.family for r in own} == {family}, (family, own)
        assert min(r.paragraph for r in own) >= 5 and max(r.paragraph + r.lines for r in own) <= 6 + HEADERS[family].count("\n")
    assert not [r for r in rows if r.doc_id == 100]


def test_odds_equal_plain_sums(spark):
    """Probabilities from the model's weights by plain Python, for whole paragraphs and lines."""
    model = licences.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    body = HEADERS["GPL"]
    rows = spark.createDataFrame([(1, body), (2, body.split("\n")[1]), (3, "no notice at all in here")], "id long, body string")
    held = rows.select("id", F.explode(licences.grams(licences.words(F.col("body")))).alias("gram"))
    weights, sums = dict(model.rows), {}
    for r in held.collect():
        if r.gram in weights:
            sums[r.id] = [x + w for x, w in zip(sums.get(r.id, model.intercepts), weights[r.gram])]
    got = {r["id"]: (r["k"], r["probability"]) for r in licences._scored(held, ["id"], spark, model).collect()}
    assert got.keys() == sums.keys()
    for k, odds in sums.items():
        p = [math.exp(x - max(odds)) for x in odds]
        best = max(range(1, len(p)), key=lambda i: (p[i], i))
        assert got[k][0] == best and abs(got[k][1] - p[best] / sum(p)) < 1e-9


def test_cues_are_in_every_paragraph_with_a_feature(spark):
    model = licences.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    features, cues = {g for g, _ in model.rows}, set(model.cues)
    text = spark.createDataFrame([(t,) for _, t in licences.TEMPLATES], "body string").withColumn(
        "w", F.filter(licences.words(F.col("body")), lambda x: x != ""))
    some = text.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).withColumn("n", F.explode(F.array(F.lit(2), F.lit(3), F.lit(6))))
    for r in some.select(F.slice("w", F.col("i"), F.col("n")).alias("w")).select(licences.grams(F.col("w")).alias("g")).collect():
        assert not features & set(r.g) or cues & set(r.g)


def test_notices_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {(r.doc_id, k) for r in docs.collect() for k, line in enumerate(r.text.split("\n"))
            if "icensed under" in line or "MIT License" in line}
    model = licences.fit(docs)
    rows = licences.scan_licences(docs, model).collect()
    assert want and want <= {(r.doc_id, r.paragraph) for r in rows if r.confirmed}
    assert {r.family for r in rows} >= {"Apache", "GPL", "CC BY-NC"}
    odd = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "x\nReleased under the MIT License.", 1), (3, "Released under the MIT License.", 1),
         (3, "Released under the MIT License.", 1), (4, "no licence here, only prose about a river " * 5000, 1)],
        "doc_id long, text string, gram int")
    got = licences.scan_licences(odd, model).collect()
    assert sorted((str(r.doc_id), r.paragraph, r.family) for r in got) == [("3", 0, "MIT"), ("None", 1, "MIT")]
    assert licences.scan_licences(odd.filter(F.lit(False)), model).count() == 0


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    from strandlake.session import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], sf_dir), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_pipeline_stages(spark, stages, duck):
    docs, clean, distinct, apart, mixed, packed = stages
    assert [x.columns for x in stages[:-1]] == [docs.columns] * 5
    assert ids(clean) < ids(docs)
    norm = {}
    for r in clean.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        norm[key] = min(norm.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert ids(distinct) == {v[1] for v in norm.values()}
    roots = {r.doc_id: r.component_id for r in link_components(distinct).collect()}
    assert ids(apart) == set(roots.values())
    assert ids(mixed) == ids(apart) == ids(packed) and mixed.count() == apart.count()


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == stages[-1].columns
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows.collect()) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in stages[-1].collect())


def test_sequences_follow_the_mix(spark, sf_dir):
    """In every prefix of the sequences the sources have their shares of the mix, not those of the input."""
    from strandlake.llm.mixing import mix
    from strandlake.session import stage

    docs = stage(spark.createDataFrame(
        [(i, ("word " * (i % 90 + 1) if i % 500 else "word " * 3000), "en", "big" if i % 16 else "small", 1) for i in range(6000)],
        "doc_id long, text string, lang string, source string, n_chars long"), "docs")
    source = {r.doc_id: r.source for r in docs.collect()}
    plan = mix(docs).collect()
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # several files, of different sizes
    try:
        mixed = stage(corpus_pipeline.mix_sources(spark, docs, sf_dir), "mixed")
    finally:
        spark.conf.set(coalesce, "true")
    assert len(mixed.inputFiles()) > 1
    rows = corpus_pipeline.pack_sequences(spark, mixed, sf_dir).collect()
    last = max(r.slot for r in plan if r.phase == 0)
    length = sum(r.phase == 0 for r in plan)
    share = sum(r.source == "small" for r in plan if r.slot <= last) / length
    assert share > 1.8 / 16  # of 1 / 16 in the input
    order = [source[r.doc_id] for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)) if r.piece == 0]
    assert len(order) == 6000
    had = 0
    for t, s in enumerate(order[: 2048], 1):
        had += s == "small"
        assert abs(had - t * share) <= 45
    assert abs(had - 2048 * share) <= 16
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    ends = {}
    for r in rows:
        ends[r.sequence_id] = ends.get(r.sequence_id, 0) + r.length
    assert max(ends.values()) <= 1024 and len(ends) <= 1.03 * sum(ends.values()) / 1024 + 3


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10


def test_nothing_else_needs_the_subpackage(tmp_path):
    """Without llm and the pipeline the entry still imports and lists the other queries."""
    import shutil
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "strandlake", tmp_path / "strandlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_licence_background_is_the_whole_corpus(spark, monkeypatch):
    """counts, training lines and thresholds come from all distinct lines, not from a few of 1,000 documents."""
    kept, written = licences.stage, {}
    monkeypatch.setattr(licences, "stage", lambda df, name, *rest: written.setdefault(name, kept(df, name, *rest)))
    docs = spark.range(1500).selectExpr("id as doc_id", """concat_ws('\\n', transform(sequence(1, 6), i -> concat(
        'river ', id, ' ', i, if(i = 1 and id % 3 = 0, ' this software of stones', ''))), 'the same line') as text""")
    model = licences.fit(docs.union(docs))
    sets = written["background"].collect()
    assert sum(r["n"] for r in sets) == 1500 * 6 + 1
    gram = spark.sql("select xxhash64('this', 'software') as g").first()["g"]
    assert sum(r["n"] for r in sets if r["grams"] == [gram]) == 500 and gram not in dict(model.rows)
