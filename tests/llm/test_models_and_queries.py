"""Trained operators on held-out rows, the registered queries and the pipeline."""

import re

import pytest

import corpus_pipeline
from recordwise.llm import licenses, ngram_join, quality, queries
from verify.base import Case
from verify.check import compare, connect


@pytest.fixture(scope="module")
def large(folder):
    return folder.replace("sf0.001", "sf0.01")


def test_quality_on_rows_that_were_held_out(spark, large):
    documents, labels = (spark.read.parquet(f"{large}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.predictions(documents, labels)
    assert scored.count() == documents.count()
    held = scored.join(labels, "doc_id").where("held_out")
    right = held.where("predicted = quality").count() / held.count()
    assert held.count() > 50 and right > 0.95
    # labels of held-out rows are not used: turning them around changes nothing
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    assert (quality.train(documents, labels) == quality.train(documents, turned)).all()


def test_quality_of_odd_rows(spark, docs, large):
    documents, labels = (spark.read.parquet(f"{large}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.train(documents, labels)
    odd = docs([(1, None), (2, ""), (None, "x"), (3, "word " * 30_000), (4, "a b"), (4, "a b")])
    rows = quality.score(odd, weights).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    kept = quality.keep_good(odd, weights, 0.0)
    assert kept.columns == odd.columns and kept.count() == 6
    assert quality.keep_good(odd, weights, 1.01).count() == 0
    nothing = quality.train(documents, labels.where("doc_id < 0"))
    assert {r["score"] for r in quality.score(odd, nothing).collect()} == {0.5}
    assert quality.score(odd.where("false"), weights).count() == 0


LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
}


def test_licence_lines_of_the_documents(spark, large):
    documents = spark.read.parquet(f"{large}/documents.parquet")
    weights = licenses.train(documents)
    found = licenses.scan(documents, weights).where("confirmed").collect()
    want = {(r["doc_id"], k, LINES[line]) for r in documents.collect() for k, line in enumerate(r["text"].split("\n")) if line in LINES}
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in found} == want


def test_licence_texts_and_strangers(spark, docs, large):
    weights = licenses.train(spark.read.parquet(f"{large}/documents.parquet"))
    gpl = "\n\nIt comes under the terms of the GNU General Public License version 2 only\n"
    buried = " ".join(["filler"] * 500) + " permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files " + " ".join(["filler"] * 500)
    rows = [(1, None), (2, ""), (3, "He renewed his license in May.\nAll rights reserved."), (4, gpl), (5, buried), (None, "Released under the MIT License."),
            (6, "x " * 40_000), (4, gpl)]
    found = sorted(((r["doc_id"] or -1), r["paragraph"], r["family"]) for r in licenses.scan(docs(rows), weights).where("confirmed").collect())
    assert found == [(-1, 0, "MIT"), (4, 2, "GPL-2.0"), (4, 2, "GPL-2.0"), (5, 0, "MIT")]
    assert licenses.scan(docs(rows).where("false"), weights).count() == 0


def test_background_lines_are_distinct(spark, docs):
    lines = [f"an ordinary line of text number {k}" for k in range(50)]
    often = "\n".join(lines)
    rows = [(k, often) for k in range(40)] + [(40, None), (41, "Released under the MIT License.\nshort")]
    got = licenses.background(docs(rows), 20)
    order = spark.createDataFrame([(t,) for t in lines], "line string").selectExpr("line", "xxhash64(line) h").orderBy("h").collect()
    assert got == [r["line"] for r in order[:20]]
    assert sorted(licenses.background(docs(rows), 1000)) == sorted(lines)
    assert licenses.background(docs(rows).where("false"), 20) == []


def test_several_licences_of_one_line(spark, docs, large):
    """All pairs of notices on one line, side by side and far apart, against what each notice alone gives."""
    weights = licenses.train(spark.read.parquet(f"{large}/documents.parquet"))
    notices = [*LINES, "Distributed under the Boost Software License, Version 1.0.", "Released under the Mozilla Public License 2.0."]
    far = " ".join(["filler"] * 300)
    pairs = [(a, b) for a in range(len(notices)) for b in range(len(notices)) if a != b]
    rows = [(k, notice) for k, notice in enumerate(notices)]
    rows += [(100 + k, f"{notices[a]} {notices[b]}") for k, (a, b) in enumerate(pairs)]
    rows += [(200 + k, f"{notices[a]} {far} {notices[b]} {far}") for k, (a, b) in enumerate(pairs)]
    rows += [(300, "Licensed under the Apache License, Version 2.0 or the MIT license, at your option.")]
    rows += [(301, "Dual licensed under the GNU General Public License version 2 and the GNU General Public License version 3.")]
    rows += [(302, "MIT License, BSD License, ISC License, Apache License 2.0 and Mozilla Public License 2.0")]
    found = {}
    for r in licenses.scan(docs(rows), weights).where("confirmed").collect():
        assert r["family"] not in found.setdefault(r["doc_id"], set()) and r["paragraph"] == 0
        found[r["doc_id"]].add(r["family"])
    assert all(len(found[k]) == 1 for k in range(len(notices)))
    for first in (100, 200):
        assert [found[first + k] for k in range(len(pairs))] == [found[a] | found[b] for a, b in pairs]
    assert found[300] == {"Apache-2.0", "MIT"} and found[301] == {"GPL-2.0", "GPL-3.0"}
    assert found[302] == {"MIT", "BSD", "ISC", "Apache-2.0", "MPL-2.0"}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, folder, name):
    problem, rows = compare(spark, connect(folder), Case(name, queries.QUERIES[name], queries.SQL[name]), folder)
    assert problem is None and rows > 0


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark, folder):
    """Each stage keeps what its own decisions, taken alone, leave; the last returns lossless pieces."""
    docs = corpus_pipeline.table(spark, folder, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.createDataFrame(kept.collect(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.items() <= before.items()
        gone = {i: before[i] for i in before.keys() - after.keys()}
        if name == "exact dedup":
            bare = lambda t: re.sub(r"[\x20\x09-\x0d]", "", t)
            assert len({bare(t) for t in after.values()}) == len(after) and {bare(t) for t in gone.values()} <= {bare(t) for t in after.values()}
        if name == "n-gram Jaccard join":
            assert ngram_join.jaccard_links(docs).where("n_links > 0").count() == 0
        if name == "benchmark decontamination":
            items = [r["text"] for r in corpus_pipeline.table(spark, folder, "benchmark").collect()]
            assert gone and all(any(i in t for i in items) for t in gone.values()) and not any(i in t for i in items for t in after.values())
        sizes.append(len(after))
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == sizes[-1] and last.where("not lossless").count() == 0


def test_pipeline_without_documents(spark, folder):
    docs = corpus_pipeline.table(spark, folder, "documents").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
