"""Null ids, repeated rows, very long texts, empty tables and clashing columns, operator by operator."""

from __future__ import annotations

import random

import pytest

pytest.importorskip("public_tokenizers")

from forkwise.llm import jaccard_join, license_scan, quality_classifier, quality_rules, warc
from forkwise.llm.common import new_folder

# Columns that the operators themselves add, or use within.
SCHEMA = "doc_id long, text string, sid long, n long, h string, score double, kept boolean, words string, tag long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 0.5, True, "w", 3, "c") for r in rows], SCHEMA)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(n))


LONG = words(60_000, 1)
ROWS = [(None, "a null id of some words here"), (None, None), (1, LONG), (1, LONG), (2, "İstanbul ÀÉ Straße über İstanbul"), (3, ""), (4, "x" * 200_000)]


def test_rules(spark):
    docs = frame(spark, ROWS)
    weights = quality_rules.bucket_weights(docs, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"))
    rows = quality_rules.quality_rules(docs, weights).collect()
    assert len(rows) == len(ROWS) and [r.n_words for r in rows if r.doc_id == 1] == [60_000, 60_000]
    kept = quality_rules.kept_documents(docs, weights)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1} and kept.count() == 2
    assert quality_rules.quality_rules(docs.limit(0), weights).count() == quality_rules.kept_documents(docs.limit(0), [0] * 8).count() == 0
    assert not any(quality_rules.bucket_weights(docs.limit(0), docs.select("doc_id")))


def test_classifier(spark):
    docs = frame(spark, ROWS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (None, 1), (99, 0), (4, 1)], "doc_id long, quality int")
    ranker = quality_classifier.train(docs, labels)
    rows = quality_classifier.classify(docs, ranker).collect()
    assert len(rows) == len(ROWS) and len({r.score for r in rows if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in rows)
    kept = quality_classifier.kept_documents(docs, ranker)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.5 for r in rows)
    assert quality_classifier.classify(docs.limit(0), quality_classifier.train(docs.limit(0), labels)).count() == 0


def test_jaccard(spark):
    near = LONG.replace("a", "b", 3)
    rows = [*ROWS, (7, near), (None, near), (None, "only a null id has these words at all"), (8, "only a null id has these words at all"), (9, "İstanbul àé Straße über İstanbul"), (10, "İSTANBUL ÀÉ STRAßE über İstanbul"), (None, words(90, 5)), (None, words(90, 5) + " more")]
    docs = frame(spark, rows)
    got = jaccard_join.jaccard_components(docs).collect()
    assert len(got) == len(rows)
    by_size = {}
    for r in got:
        by_size.setdefault(r.n_shingles, set()).add(r.component_id)
    assert {r.component_id for r in got if r.n_shingles > 50_000} == {1}
    assert {r.component_id for r in got if r.doc_id == 8} == {8} and sum(r.component_id == 8 for r in got) == 2
    # Only A-Z is lower-cased: other capitals make other words, and so other sets.
    assert {r.component_id for r in got if r.doc_id in (2, 9, 10)} == {2, 9}
    assert {r.component_id for r in got if r.n_shingles in (87, 88)} == {None}
    assert [r.component_id for r in got if r.doc_id == 3] == [3]

    groups = jaccard_join.jaccard_groups(docs, 4, 85)
    kept = jaccard_join.one_of_each(docs, groups, 4)
    assert kept.columns == docs.columns
    left = sorted((str(r.doc_id), (r.text or "")[:12]) for r in kept.collect())
    assert left == sorted((str(i), (t or "")[:12]) for i, t in [ROWS[0], ROWS[1], ROWS[2], *ROWS[4:], (8, rows[10][1]), rows[11], rows[13]])
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_license(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    docs = frame(spark, [*ROWS, (None, notice), (20, f"{notice} {notice}"), (21, "license " * 20_000)])
    got = license_scan.license_scan(docs).collect()
    assert len(got) == len(ROWS) + 3
    assert [len(r.matches) for r in got if r.doc_id == 20] == [2] and [len(r.matches) for r in got if r.doc_id == 21] == [0]
    assert sum(len(r.matches) for r in got if r.doc_id is None) == 1
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_archives(spark):
    html = "<p>" + words(400, 2)
    rows = [(1, "u", html), (9, "u", html), (9, "u", html), (None, None, None)]
    pages = spark.createDataFrame([(*r, "k", 5) for r in rows], "page_id long, url string, html string, payload_digest string, chunk_no int")

    def back(rows):
        return warc.read_archives(warc.write_archives(warc.chunk_table(warc.records(rows)), new_folder(spark, "archives"))).filter("last").collect()

    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in back(pages))
    assert got == [(0, "response", 0), (1, "revisit", 9), (9, "response", 0), (9, "response", 0)]
    assert back(pages.limit(0)) == []
