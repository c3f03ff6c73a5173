"""From notification logs to per-block diffs, receipts and undo operations.

The flat forms take one row for each change, so that no block has to be held in one value;
``changes_of`` and ``receipts_of`` give these rows of a nested log. A block that a segment
lists without an outcome (null changes) is an error, as the cursors would pass it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X


def committed(log: DataFrame) -> DataFrame:
    """The last committed payload of each block hash."""
    nth = F.row_number().over(Window.partitionBy("block_hash").orderBy(F.desc("seq")))
    return log.filter("side = 'new'").withColumn("nth", nth).filter("nth = 1").drop("nth")


def changes_of(log: DataFrame) -> DataFrame:
    """A row for each account change of each committed block."""
    return changes_in(committed(log))


def changes_in(new: DataFrame, *more: str) -> DataFrame:
    """``changes_of`` blocks that are ``committed`` already, with ``more`` of their columns."""
    whole = F.when(F.col("changes").isNull(), F.raise_error(F.concat(F.lit("no outcome for block "), F.col("block_hash")))).otherwise(F.col("changes"))
    rows = new.select("block_number", "block_hash", *more, F.posexplode(whole).alias("change_no", "c"))
    return rows.select("block_number", "block_hash", *more, "change_no", "c.address", "c.old", "c.new", "c.storage")


def receipts_of(log: DataFrame) -> DataFrame:
    """A row for each receipt of each committed block.

    Transactions and receipts are paired by position; what the longer list has beyond the
    shorter is left out. Where there are no transactions, receipts bring their own hashes.
    """
    return receipts_in(committed(log))


def receipts_in(new: DataFrame, *more: str) -> DataFrame:
    """``receipts_of`` blocks that are ``committed`` already, with ``more`` of their columns."""
    n = F.coalesce(F.least(F.size("transactions"), F.size("receipts")), F.size("receipts"))
    hashes = F.coalesce(F.col("transactions"), F.transform("receipts", lambda r: r["tx_hash"]))
    pairs = F.arrays_zip(F.slice(hashes, 1, n).alias("tx_hash"), F.slice("receipts", 1, n).alias("r"))
    rows = new.filter("receipts IS NOT NULL").select("block_number", "block_hash", *more, F.posexplode(pairs).alias("tx_index", "p"))
    return rows.select("block_number", "block_hash", *more, "tx_index", "p.tx_hash", "p.r.status", "p.r.cumulative_gas_used", "p.r.tx_type", "p.r.logs_rlp", "p.r.log_bloom")


def account_diffs(changes: DataFrame, *more: str) -> DataFrame:
    """Diff rows of ``changes(block_number, block_hash, address, old, new)``, with ``more`` of their columns; accounts on neither side have none."""
    rows = changes.withColumn("change_kind", X.change_kind(F.col("old"), F.col("new"))).filter("change_kind IS NOT NULL")
    return rows.select(
        "block_number", "block_hash", "address", F.col("old.balance").alias("old_balance"), F.col("new.balance").alias("new_balance"),
        F.col("old.nonce").alias("old_nonce"), F.col("new.nonce").alias("new_nonce"), F.col("old.code_hash").alias("old_code_hash"), F.col("new.code_hash").alias("new_code_hash"), "change_kind", *more,
    )


def slots_of(changes: DataFrame, *more: str) -> DataFrame:
    """Slot rows of nested changes, with ``more`` of their columns; an account on neither side drops its slots too."""
    rows = changes.filter("old IS NOT NULL OR new IS NOT NULL").select("block_number", "block_hash", "address", *more, F.explode("storage").alias("s"))
    return rows.select("block_number", "block_hash", "address", "s.slot", "s.old_value", "s.new_value", *more)


def storage_diffs(slots: DataFrame, *more: str) -> DataFrame:
    """Slots whose value changed, with ``more`` of their columns."""
    return slots.filter("NOT (old_value <=> new_value)").select("block_number", "block_hash", "address", "slot", "old_value", "new_value", *more)


def receipt_artifacts(receipts: DataFrame, *more: str) -> DataFrame:
    """Artifacts with the encoded receipt and ``more`` columns; see ``proofs.anchored`` for the root. Type, logs and bloom may be missing: legacy, none, empty."""
    there = receipts.columns
    bloom = F.col("log_bloom") if "log_bloom" in there else F.lit(None).cast("binary")
    logs = F.coalesce(F.lower(F.hex("logs_rlp")), F.lit("c0")) if "logs_rlp" in there else None
    encoded = X.receipt_rlp(F.col("status"), F.col("cumulative_gas_used"), bloom, logs, F.col("tx_type") if "tx_type" in there else None)
    return receipts.select(
        "block_number", "block_hash", "tx_index", "tx_hash", F.col("tx_index").alias("receipt_index"),
        encoded.alias("receipt_rlp"), F.lit(None).cast("string").alias("receipt_root_anchor"),
        X.bloom(bloom).alias("log_bloom"), "status", "cumulative_gas_used", *more,
    )


def _ops(rows: DataFrame, table: str, key: F.Column, phase: int, part: int, **at: F.Column) -> DataFrame:
    """Undo operations of one table, with what orders them within a block."""
    place = {"address": F.lit(""), "slot": F.lit(""), "tx": F.lit(0)} | at
    return rows.select("block_number", "block_hash", F.lit(phase).alias("phase"), F.lit(part).alias("part"), *(c.alias(n) for n, c in place.items()), F.lit(table).alias("table_name"), key.alias("primary_key_ref"), F.lit("").alias("inverse_payload"))


def account_ops(accounts: DataFrame) -> DataFrame:
    return _ops(accounts, "account_diffs", X.account_key(F.col("block_hash"), F.col("address")), 0, 0, address=F.col("address"))


def storage_ops(storage: DataFrame) -> DataFrame:
    return _ops(storage, "storage_diffs", X.storage_key(F.col("block_hash"), F.col("address"), F.col("slot")), 0, 1, address=F.col("address"), slot=F.col("slot"))


def receipt_ops(receipts: DataFrame) -> DataFrame:
    return _ops(receipts, "receipt_artifacts", X.receipt_key(F.col("block_hash"), F.col("tx_index")), 1, 2, tx=F.col("tx_index"))


def block_ops(blocks: DataFrame) -> DataFrame:
    """The kind of operation that takes a block's status back. Extraction never makes one; ``fold.mark_reorged`` applies those of other sources."""
    return _ops(blocks, "canonical_blocks", X.block_key(F.col("block_hash")), 2, 3)


def revert_ops(accounts: DataFrame, storage: DataFrame, receipts: DataFrame, tasks: int | None = None) -> DataFrame:
    """An undo operation for each diff row, numbered from 0 within its block: each account, then its slots; then the receipts.

    Slots without an account row stand where their account would. A block's gas limit bounds
    what is numbered together. ``tasks`` that the rows are dealt to, if not those of the session.
    """
    order = Window.partitionBy("block_hash").orderBy("phase", "address", "part", "slot", "tx")
    rows = account_ops(accounts).unionByName(storage_ops(storage)).unionByName(receipt_ops(receipts))
    rows = (rows.repartition(tasks, "block_hash") if tasks else rows).withColumn("op_sequence", (F.row_number().over(order) - 1).cast("bigint"))
    return rows.select(F.col("block_number").alias("reorg_target_block"), "block_hash", "op_sequence", "table_name", "primary_key_ref", "inverse_payload")


def segment_net_change(changes: DataFrame, low: int, high: int) -> DataFrame:
    """First account before and last account after of each address over a range of heights of one branch."""
    rows = changes.filter(F.col("block_number").between(low, high))
    ends = rows.groupBy("address").agg(F.min_by(F.struct("old"), "block_number").alias("first"), F.max_by(F.struct("new"), "block_number").alias("last"))
    old, new = F.col("first.old"), F.col("last.new")
    return ends.select("address", old.alias("old"), new.alias("new"), X.change_kind(old, new).alias("change_kind"))


def segment_net_slots(slots: DataFrame, low: int, high: int) -> DataFrame:
    """First value before and last value after of each slot over a range of heights of one branch; slots that end as they began are left out."""
    rows = slots.filter(F.col("block_number").between(low, high))
    ends = rows.groupBy("address", "slot").agg(F.min_by("old_value", "block_number").alias("old_value"), F.max_by("new_value", "block_number").alias("new_value"))
    return ends.filter("NOT (old_value <=> new_value)")


def block_summary(blocks: DataFrame, accounts: DataFrame, storage: DataFrame, receipts: DataFrame, *more: str) -> DataFrame:
    """How many rows of each table every block has, and ``more`` columns of the blocks."""
    names = ("account_diffs", "storage_diffs", "receipts")
    counted = [rows.groupBy("block_hash").agg(F.count("*").alias("n")).select("block_hash", *((F.col("n") if x == name else F.lit(0).cast("bigint")).alias(x) for x in names)) for name, rows in zip(names, (accounts, storage, receipts))]
    counts = counted[0].unionByName(counted[1]).unionByName(counted[2]).groupBy("block_hash").agg(*(F.sum(x).alias(x) for x in names))
    out = blocks.select("block_number", "block_hash", *more).join(counts, "block_hash", "left")
    return out.select("block_number", "block_hash", *(F.coalesce(c, F.lit(0)).alias(c) for c in names), *more)
