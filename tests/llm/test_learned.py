"""Trained operators: held-out accuracy, defined results for odd rows; the pipeline against brute force."""

import itertools
import math
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from monthwise.llm import queries as Q
from monthwise.llm.licences import TEMPLATES, scan_licences
from monthwise.llm.quality import GatedAttention, encode, score_quality
from monthwise.llm.toxicity import figures, score_toxicity

from .conftest import MEDIUM, SMALL, auc
from .test_exact import plain_contamination, plain_dedup, plain_groups

LARGE = "/root/testdata/sf0.1"


def held_out(spark, name, folder, label):
    rows = Q.QUERIES[name](spark, folder).join(Q.table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    return [r.score for r in rows], [r[label] for r in rows], [r.predicted for r in rows]


def test_quality_held_out(spark):
    score, label, predicted = held_out(spark, "op3_quality", MEDIUM, "quality")
    assert auc(score, label) > 0.97
    assert np.mean(np.array(predicted) == np.array(label)) > 0.95


def test_toxicity_held_out(spark):
    score, label, predicted = held_out(spark, "op5_toxicity", LARGE, "toxic")
    assert auc(score, label) > 0.94
    assert np.mean(np.array(predicted) == np.array(label)) > 0.94


@pytest.mark.parametrize("score,label,folds,out", [(score_quality, "quality", 3, 1), (score_toxicity, "toxic", 4, 2)])
def test_scores_of_odd_rows(spark, odd_documents, score, label, folds, out):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, None), (None, 1), (8, 1), (8, 0), (77, 1), (12, 0), (4, 1)],
                                   f"doc_id long, {label} int")
    got = score(odd_documents, labels).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == out)
    assert score(odd_documents.limit(0), labels).collect() == []
    assert {r.score for r in score(odd_documents, labels.limit(0)).collect()} == {0.5}


def test_held_out_labels_teach_nothing(spark):
    docs = Q.table(spark, SMALL, "documents")
    labels = Q.table(spark, SMALL, "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, round(r.score, 6)) for r in score_quality(docs, x).collect()) for x in (labels, turned))
    assert one == two


def test_attention_gradients():
    doc, x = encode(["one two three " * 40, "", None, "### a ### b ### " * 30])
    y = np.array([1.0, 0.0, 0.0, 1.0])
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    model = GatedAttention(x.shape[1])
    loss = lambda: -np.mean(y * np.log(f := model.forward(x, doc, starts)["y"]) + (1 - y) * np.log(1 - f))
    grads = model.gradients(model.forward(x, doc, starts), y, doc, starts)
    for name, p in model.p.items():
        at = tuple(0 for _ in p.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4, name


def test_licences_found_and_others_left(spark, odd_documents):
    rng = random.Random(2)
    noise = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    rows, want = [], {}
    for i, (family, line) in enumerate((f, t) for f, ts in TEMPLATES.items() for t in ts):
        rows.append((i, f"{noise(20)}\n{line}\n{noise(30)}"))
        want[i] = family
    rows += [(500 + i, f"{noise(40)}\n{noise(10)}") for i in range(60)]
    rows += [(900, "You need a license to drive.\nAll rights reserved."), (901, "the general public and the terms of use")]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        odd_documents.select("doc_id", "text").where("doc_id = 3 OR doc_id = 4 OR doc_id IS NULL"))
    got = scan_licences(df).collect()
    assert len(got) == df.count()
    assert {r.doc_id: r.families for r in got if r.families} == {i: [f] for i, f in want.items()}
    assert all(f.paragraph == 1 and f.confirmed for r in got for f in r.findings if r.doc_id in want)
    assert scan_licences(df.limit(0)).collect() == []


def test_licences_of_the_table(spark):
    """Every line of the table that names a known licence is found, and nothing else."""
    docs = Q.table(spark, MEDIUM, "documents").select("doc_id", "text").collect()
    names = {"MIT License.": "MIT", "Apache License, Version": "Apache-2.0", "CC BY-NC": "CC-BY-NC",
             "GNU General Public License": "GPL"}
    want = {d.doc_id: ",".join(sorted(f for n, f in names.items() if n in (d.text or ""))) for d in docs}
    got = {r.doc_id: r.families for r in Q.QUERIES["op7_licence_scan"](spark, MEDIUM).collect()}
    assert got == want


# --- pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    docs = Q.table(spark, SMALL, "documents")
    bench = [tuple(r) for r in Q.table(spark, SMALL, "benchmark").collect()]
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontaminate", "packing"]
    stage = dict(P.STAGES)
    good = stage["quality"](spark, docs, SMALL).cache()
    scored = Q.QUERIES["op3_quality"](spark, SMALL)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scored.where("predicted = 1").collect()}

    near = stage["near_dedup"](spark, good, SMALL).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    want = {i for (i, _), (_, c) in zip(rows, plain_groups(rows, 5, 80)) if i == c}
    assert sorted(r.doc_id for r in near.collect()) == sorted(want)

    cut = stage["substring_dedup"](spark, near, SMALL).cache()
    rows = [(r.doc_id, r.text) for r in near.collect()]
    plain = plain_dedup(rows)
    want = {i: (t if plain[i, t][0] == len(plain[i, t][1].split()) else plain[i, t][1]) for i, t in rows}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = stage["decontaminate"](spark, cut, SMALL).cache()
    assert {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in cut.collect() if not plain_contamination(r.text, bench)[3]}

    packed = stage["packing"](spark, clean, SMALL)
    assert sorted(r.doc_id for r in packed.collect()) == sorted(r.doc_id for r in clean.collect())
    whole = P.run(spark, SMALL)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, packed.collect()))


def test_pipeline_odd_rows(spark, odd_documents):
    odd = odd_documents.withColumnRenamed("n_words", "n_chars")
    for name, stage in P.STAGES:
        for df in (odd, odd.limit(0)):
            got = stage(spark, df, SMALL)
            if name != "packing":
                assert got.columns == df.columns
            assert got.count() <= df.count()
    kept = P.near_dedup(spark, odd, SMALL).select("doc_id", "text").collect()
    assert sum(r.doc_id == 8 for r in kept) == 2 and sum(r.doc_id is None for r in kept) == 2


# --- whole results where they were cut -------------------------------------------------------------------------------

def plain_differences(rows):
    """Per level and step (its bytes) the log-likelihood difference, from (text, y) rows of plain words."""
    sizes = (3, 4, 5, 6, 8, None)
    n = Counter()
    for text, y in rows:
        paths = {tuple(w.encode()[:s] for s in sizes) for w in text.split()}
        n.update({(level, y, p[level - 1] if level else b"", p[level]) for p in paths for level in range(6)})
    steps = {(level, before, step) for level, _, before, step in n}
    under = defaultdict(list)
    for level, before, step in steps:
        under[level, before].append((n[level, 1, before, step], n[level, 0, before, step]))
    out = {}
    for level, before, step in steps:
        found = under[level, before]
        t, o = n[level, 1, before, step], n[level, 0, before, step]
        shared = (max(t + o - 0.75, 0) + 0.75 * len(found) / 64) / sum(map(sum, found))
        p = []
        for c, own in enumerate((t, o)):
            total, kinds = sum(f[c] for f in found), sum(f[c] > 0 for f in found)
            p.append((max(own - 0.75, 0) + 0.75 * kinds * shared) / total if total else shared)
        out[level, step] = math.log(p[0]) - math.log(p[1])
    return out


def test_toxicity_spellings_share_no_count(spark):
    """Of 6000 spellings some would share one of 2^20 slots; each has its own counts and totals."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789é"
    vocabulary = ["".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(6000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=60)), (0, 1, None)[i % 3]) for i in range(300)]
    want = plain_differences([(t, y) for _, t, y in rows if y is not None])
    x = {r.id: r.x for r in figures(spark.createDataFrame(rows, "id long, text string, y int")).collect()}
    for i, text, _ in rows:
        paths = [[w.encode()[:s] for s in (3, 4, 5, 6, 8, None)] for w in text.split()]
        early, whole = (np.array([sum(want.get((level, p[level]), 0) for level in range(n)) for p in paths])
                        for n in (3, 6))
        plain = [1, whole.mean()] + [math.log1p(100 * np.maximum(v - c, 0).mean()) for v in (early, whole)
                                     for c in (1, 2, 3)]
        assert np.allclose(x[i], plain, atol=1e-4), i


def test_licences_wrapped(spark):
    """Notices wrapped as source files carry them, with comment marks, count as one finding at their first line."""
    notices = {
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
               "associated documentation files (the Software), to deal in the Software without restriction",
        "GPL": TEMPLATES["GPL"][1] + ", either version 3 of the License, or (at your option) any later version.",
        "LGPL": TEMPLATES["LGPL"][0] + " as published by the Free Software Foundation; either version 2.1 of it",
        "BSD": TEMPLATES["BSD"][0] + ": redistributions of source code must retain the above copyright notice",
        "Apache-2.0": TEMPLATES["Apache-2.0"][1],
    }
    rows, want = [], {}
    for family, text in notices.items():
        for width, mark in itertools.product((40, 75), ("", " * ", "// ", "# ")):
            lines = [mark + line for line in textwrap.wrap(text, width)]
            for between in ("\n", f"\n{mark.rstrip()}\n"):
                want[len(rows)] = family
                rows.append((len(rows), f"w1 w2 w3\n\n{between.join(lines)}\n\nw4 w5 of the\nw6"))
    want |= {len(rows): "GPL,MIT"}
    rows.append((len(rows), "Released under the MIT License. This program is free software: you can\n"
                 "redistribute it and/or modify it under the terms of the GNU General Public\n"
                 "License as published by the Free Software Foundation\nReleased under the MIT License."))
    rows += [(900, "kept in the copies of\nthe general rules\n \n" * 300), (901, "\n \n" * 100_000), (902, "\x01a\x02\nb\n")]
    got = {r.doc_id: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: ",".join(r.families) for i, r in got.items() if r.families} == want
    assert all(len(got[i].findings) == 1 and got[i].findings[0].paragraph == 1 for i, f in want.items() if f != "GPL,MIT")
