"""Address and slot indexes: set-based batches over ranges of heights, and their unwinding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reads import active_blocks

MAX_BLOCKS = 1000


@dataclass(frozen=True)
class Batch:
    """Heights above ``start`` up to ``end``; ``done`` if nothing is left below the target."""

    start: int
    end: int
    done: bool


def next_batch(compacted: int, durable: int, requested: int | None = None, most: int = MAX_BLOCKS) -> Batch:
    """What one call compacts: never above the durable cursor, at most ``most`` heights."""
    target = durable if requested is None else min(requested, durable)
    end = min(compacted + most, target) if target > compacted else compacted
    return Batch(compacted, end, end >= target)


def plan(compacted: Column, durable: Column, most: int = MAX_BLOCKS) -> Column:
    """Array of all batches from ``compacted`` up to ``durable``."""
    starts = F.when(durable > compacted, F.sequence(compacted, durable - 1, F.lit(most).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(starts, lambda s: F.struct(s.alias("after"), F.least(s + most, durable).alias("up_to"), (s + most >= durable).alias("done")))


def within(batch: Batch) -> Column:
    return (F.col("block_number") > batch.start) & (F.col("block_number") <= batch.end)


def _indexed(rows: DataFrame, blocks: DataFrame, columns: list[str], tasks: int | None) -> DataFrame:
    live = active_blocks(blocks).select("block_number", "block_hash")
    rows = rows.select(*columns)
    if tasks:  # one shuffle serves the join and what follows it
        rows = rows.repartition(tasks, "block_number", "block_hash")
    return rows.join(live, ["block_number", "block_hash"], "left_semi").select(*columns).distinct()


def address_index(accounts: DataFrame, blocks: DataFrame, tasks: int | None = None) -> DataFrame:
    """Where each address changed on the canonical chain; ``tasks`` that the rows are dealt to, if not those of the session."""
    return _indexed(accounts, blocks, ["address", "block_number", "block_hash", "change_kind"], tasks)


def slot_index(storage: DataFrame, blocks: DataFrame, tasks: int | None = None) -> DataFrame:
    return _indexed(storage, blocks, ["address", "slot", "block_number", "block_hash"], tasks)


def new_rows(index: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append: insert or ignore."""
    return index.join(existing.select(*keys), keys, "left_anti")


def compact(accounts: DataFrame, storage: DataFrame, blocks: DataFrame, batch: Batch) -> tuple[DataFrame, DataFrame]:
    """Index rows of one batch; the filters reach the scans of all three tables."""
    live = blocks.filter(within(batch))
    return address_index(accounts.filter(within(batch)), live), slot_index(storage.filter(within(batch)), live)


def gap_heights(blocks: DataFrame, batch: Batch) -> DataFrame:
    """Heights of a batch that have no canonical block: they are passed over, and reported."""
    heights = blocks.sparkSession.range(batch.start + 1, batch.end + 1).select(F.col("id").alias("block_number"))
    return heights.join(active_blocks(blocks).filter(within(batch)).select("block_number"), "block_number", "left_anti")


def unwound(index: DataFrame, target: int | Column) -> DataFrame:
    """An index without what lies above ``target``."""
    return index.filter(F.col("block_number") <= target)


def unwind_cursors(checkpoint: DataFrame, target: int | Column) -> DataFrame:
    """Both stage cursors are lowered, never raised."""
    t = F.lit(target) if isinstance(target, int) else target
    return checkpoint.withColumns({c: F.least(F.col(c), t).cast("bigint") for c in ("compacted_until", "proof_indexed_until")})


def advance(checkpoint: DataFrame, end: int | Column) -> DataFrame:
    """``compacted_until`` after a batch; it never goes back."""
    e = F.lit(end) if isinstance(end, int) else end
    return checkpoint.withColumn("compacted_until", F.greatest("compacted_until", e).cast("bigint"))
