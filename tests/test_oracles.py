"""Every chain query that SQL can express, against DuckDB on the smoke set."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from forkwise.functions import scalars as X
from forkwise.operators import extract, fold
from forkwise.plans import queries, stored
from forkwise.plans.oracles import ORACLES

QUERIES = queries.QUERIES | stored.QUERIES
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def normal(rows):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) and math.isfinite(v) else v for v in r)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert normal([tuple(r[c] for c in columns) for r in got.collect()]) == normal([tuple(r[i] for i in order) for r in want.fetchall()])


def test_the_stored_chain_violates_nothing(spark):
    assert stored.stored_invariants(spark, SF).filter("violations > 0").isEmpty()
    assert stored.store_of(spark, SF).version().of("address_block_index")


def test_rows_and_their_undo_operations_come_from_one_pass(spark):
    """Undo operations are of the rows that they take back: each table is derived once, and both forms leave the same."""
    plan = queries.QUERIES["apply_revert"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_suppkey#") and sum("Relation" in line and "l_suppkey#" in line for line in plan.splitlines()) == 1
    c = queries.Chain(spark, SF)
    rows, keys = c.storage(), ["block_hash", "address", "slot"]
    rows = rows.unionByName(rows.filter("slot = '5'"))  # rows of one key go or stay together
    lost = c.blocks().filter("canonical_status = 'reorged'")
    ops = extract.storage_ops(rows.join(lost, "block_hash", "left_semi"))
    want = fold.apply_revert(rows, "storage_diffs", keys, ops).groupBy("block_number", *keys).count()
    got = fold.apply_own_revert(rows, keys, X.storage_key(*map(F.col, keys)), lost)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
