"""Registered queries over the driver's smoke tables: against their SQL, and op1 by held-out labels."""

from __future__ import annotations

import os

import pytest

pytest.importorskip("public_tokenizers")
duckdb = pytest.importorskip("duckdb")

from forkwise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def connected(sf):
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    want = connected(SF).execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(repr(tuple(r[c] for c in names)) for r in got.collect()) == sorted(map(repr, want.fetchall()))


def test_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MORE}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_bradley_terry_quality"](spark, MORE).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert len(rows) > 50 and sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.95 * len(rows)
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)
