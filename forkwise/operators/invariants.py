"""Checks of the derived tables; each gives what violates it, and a report counts that."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cursors, proofs


def orphans(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows whose block is not registered."""
    return rows.join(blocks.select("block_hash"), "block_hash", "left_anti")


def visible(rows: DataFrame, blocks: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows of the blocks in ``hashes`` that a consumer can see; there must be none after a reorganisation."""
    live = blocks.filter("canonical_status = 'active'").select("block_hash")
    return rows.join(hashes.select("block_hash"), "block_hash", "left_semi").join(live, "block_hash", "left_semi")


def index_parity(index: DataFrame, diffs: DataFrame, keys: list[str]) -> DataFrame:
    """side (``index_only`` or ``diff_only``) and key of whatever one has and the other lacks."""
    both = index.select(*keys, F.lit(True).alias("indexed")).unionByName(diffs.select(*keys, F.lit(False).alias("indexed")))
    sides = both.groupBy(*keys).agg(F.max("indexed").alias("i"), F.min("indexed").alias("d"))
    return sides.filter(F.col("i") == F.col("d")).select(F.when(F.col("i"), "index_only").otherwise("diff_only").alias("side"), *keys)


def inconsistent_checkpoints(points: DataFrame) -> DataFrame:
    return points.filter(~cursors.consistent())


def wrong_roots(receipts: DataFrame) -> DataFrame:
    """Blocks whose stored root is not that of their receipts."""
    return proofs.roots_and_anchors(receipts, ["receipt_root_anchor"]).filter("NOT (receipts_root <=> receipt_root_anchor)")


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """check and violations."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()])
