"""Canonical status as last writer wins.

Within a notification the old side comes before the new one. Status events of a block hash
are ordered by (seq, phase); the last decides. This is associative, so batches, increments
and streams agree, and late or repeated delivery does no harm. A hash that was never
committed stays out when the result is read, not when events are taken in, since its commit
may still come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X

OLD, NEW = 0, 1


def block_events_of(log: DataFrame) -> DataFrame:
    """seq, phase, kind, block_number, block_hash, parent_hash and event of each row of the log."""
    kind = X.strict_enum(F.col("kind"), ("commit", "reorg", "revert"))
    new = X.strict_enum(F.col("side"), ("old", "new")) == "new"
    return log.select("seq", F.when(new, NEW).otherwise(OLD).alias("phase"), kind.alias("kind"), "block_number", "block_hash", "parent_hash", F.when(new, "active").otherwise("reorged").alias("event"))


def block_events(log: DataFrame) -> DataFrame:
    """``block_events_of`` without repeated deliveries."""
    return block_events_of(log).dropDuplicates(["seq", "phase", "block_hash"])


def status_rows(events: DataFrame) -> DataFrame:
    """Events in the shape of the status table: what each says of its block by itself."""
    new = F.col("event") == "active"
    return events.select("block_number", "block_hash", "seq", "phase", "event", *(F.when(new, F.col(c)).alias(a) for c, a in (("seq", "active_seq"), ("phase", "active_phase"), ("parent_hash", "parent_hash"))))


def merged_status(rows: DataFrame) -> DataFrame:
    """One row for each block hash: its last event, and the last that made it active. Merging is associative, so a snapshot and later rows give what all events give."""
    last, active = F.struct("seq", "phase"), F.struct("active_seq", "active_phase")
    committed = F.col("active_seq").isNotNull()
    out = rows.groupBy("block_hash").agg(
        F.max(F.struct("seq", "phase", "event")).alias("l"),
        F.max_by(F.when(committed, F.struct("block_number", "active_seq", "active_phase", "parent_hash")), F.when(committed, active)).alias("a"),
        F.max_by("block_number", last).alias("n"),
    )
    return out.select(F.coalesce("a.block_number", "n").alias("block_number"), "block_hash", "l.seq", "l.phase", "l.event", "a.active_seq", "a.active_phase", "a.parent_hash")


def blocks_of(status: DataFrame) -> DataFrame:
    """The block table of merged status rows; hashes that were never committed are left out."""
    rows = status.filter("active_seq IS NOT NULL").select("block_number", "block_hash", "parent_hash", F.col("event").alias("canonical_status"))
    return rows.select("*", F.lit(None).cast("boolean").alias("finalized_hint"), F.lit(None).cast("bigint").alias("derived_checkpoint_id"))


def status_of_blocks(blocks: DataFrame) -> DataFrame:
    """Status rows of a block table that was kept elsewhere; any event of a log is later."""
    first = F.lit(-1).cast("bigint")
    return blocks.select("block_number", "block_hash", first.alias("seq"), F.lit(NEW).alias("phase"), F.col("canonical_status").alias("event"), first.alias("active_seq"), F.lit(NEW).alias("active_phase"), "parent_hash")


def status_after(events: DataFrame) -> DataFrame:
    """One row for each block hash that was ever committed, with its status after all events."""
    return blocks_of(merged_status(status_rows(events))).select("block_number", "block_hash", "parent_hash", "canonical_status")


def canonical_blocks(events: DataFrame) -> DataFrame:
    """``status_after`` in the shape of the block table."""
    return blocks_of(merged_status(status_rows(events)))


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: upserts over an append-only table."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("_nth", last).filter("_nth = 1").drop("_nth")


def active(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of blocks that are canonical now."""
    return rows.join(blocks.filter("canonical_status = 'active'").select("block_hash"), "block_hash", "left_semi")


def apply_revert(rows: DataFrame, table: str, keys: list[str], ops: DataFrame) -> DataFrame:
    """``rows`` without those that undo operations name by key; only operations on ``table`` count.

    Keys hold the block hash, so an operation of an unseen branch removes nothing.
    """
    part = X.parsed_key(F.col("primary_key_ref"))
    named = ops.filter(F.col("table_name") == table).select(*(part[k].alias(k) for k in keys)).distinct()
    return rows.join(named, keys, "left_anti")


def apply_own_revert(rows: DataFrame, keys: list[str], key_ref: Column, lost: DataFrame, tasks: int | None = None) -> DataFrame:
    """``apply_revert`` of the undo operations of ``lost`` blocks' own rows, of which ``key_ref`` makes their reference.

    Rows and their operations come from one pass and meet by key, inside tasks that rows are
    dealt to by block; gives block_number, ``keys`` and ``n``, the number of the rows that stay.
    """
    rows = rows.select("block_number", *keys)
    rows = rows.repartition(tasks, "block_hash") if tasks else rows.repartition("block_hash")
    marked = rows.join(lost.select("block_hash", F.lit(True).alias("_lost")), "block_hash", "left")
    marked = marked.withColumn("_named", X.parsed_key(F.when(F.col("_lost"), key_ref)))
    row = F.struct(*keys, F.lit(False).alias("undo"))
    op = F.struct(*(F.col("_named")[k].alias(k) for k in keys), F.lit(True).alias("undo"))
    both = marked.select("block_number", F.col("block_hash").alias("_block"), F.explode(F.when(F.col("_lost"), F.array(row, op)).otherwise(F.array(row))).alias("e"))
    # The block by which rows were dealt is among what they are grouped by, so nothing is dealt again.
    met = both.select("block_number", "_block", "e.*").groupBy("block_number", "_block", *keys).agg(F.max("undo").alias("undone"), F.count("*").alias("n"))
    return met.filter("NOT undone").select("block_number", *(F.col("_block").alias(k) if k == "block_hash" else k for k in keys), "n")


def mark_reorged(blocks: DataFrame, ops: DataFrame) -> DataFrame:
    """Blocks named by undo operations on the block table lose their status; unknown hashes change nothing."""
    key = X.parsed_key(F.col("primary_key_ref"))["block_hash"].alias("block_hash")
    hit = ops.filter("table_name = 'canonical_blocks'").select(key, F.lit(True).alias("hit")).distinct()
    status = F.when(F.col("hit"), "reorged").otherwise(F.col("canonical_status"))
    return blocks.join(hit, "block_hash", "left").withColumn("canonical_status", status).select(*blocks.columns)


def rollback_bases(events: DataFrame) -> DataFrame:
    """seq, base and the number of live blocks of each notification that takes back blocks that were canonical.

    ``base`` is the height below the lowest of its old blocks. A notification whose old
    blocks are none of them canonical rolls nothing back.
    """
    history = Window.partitionBy("block_hash").orderBy("seq", "phase")
    rows = events.withColumn("was", F.lag("event").over(history)).filter("event = 'reorged'")
    out = rows.groupBy("seq").agg(X.before(F.min("block_number")).alias("base"), F.count_if(F.col("was") == "active").alias("n_live"))
    return out.filter("n_live > 0")
