"""Point and range reads.

Consumer reads see canonical blocks only, by a semi join with the active view. Status is
unique for a block hash, so the semi join never multiplies rows. Filters stand on base
columns and reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import BadRequest
from ..functions import scalars as X


def active_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.filter("canonical_status = 'active'")


def block_by_hash(blocks: DataFrame, block_hash: str) -> DataFrame:
    return blocks.filter(F.col("block_hash") == block_hash.lower())


def active_blocks_above(blocks: DataFrame, height: int) -> DataFrame:
    return active_blocks(blocks).filter(F.col("block_number") > height).orderBy("block_number")


def of_block(rows: DataFrame, block_hash: str, *order: str | Column) -> DataFrame:
    """Rows of one block whatever its status."""
    return rows.filter(F.col("block_hash") == block_hash.lower()).orderBy(*order)


def account_diffs_for_block(accounts: DataFrame, block_hash: str) -> DataFrame:
    return of_block(accounts, block_hash, "address")


def storage_diffs_for_block(storage: DataFrame, block_hash: str) -> DataFrame:
    """Slots are ordered as text, so that 10 comes before 9."""
    return of_block(storage, block_hash, "address", "slot")


def receipts_for_block(receipts: DataFrame, block_hash: str) -> DataFrame:
    return of_block(receipts, block_hash, "tx_index")


def revert_ops_for_block(ops: DataFrame, block_hash: str) -> DataFrame:
    """Undo operations in the order in which they are applied."""
    return of_block(ops, block_hash, F.desc("op_sequence"))


def checked_range(low: int, high: int) -> tuple[int, int]:
    """An inclusive range of heights. An empty result is valid; an inverted range is not."""
    if low < 0 or low > high:
        raise BadRequest(f"from_block {low} is above to_block {high}" if low > high else "heights are not negative")
    return low, high


def _ranged(rows: DataFrame, blocks: DataFrame, low: int, high: int) -> DataFrame:
    low, high = checked_range(low, high)
    within = F.col("block_number").between(low, high)
    live = active_blocks(blocks).filter(within).select("block_number", "block_hash")
    return rows.filter(within).join(live, ["block_number", "block_hash"], "left_semi")


def account_diff_range(accounts: DataFrame, blocks: DataFrame, address: str, low: int, high: int) -> DataFrame:
    """Canonical changes of an account from ``low`` to ``high``, by height."""
    return _ranged(accounts.filter(F.col("address") == address.lower()), blocks, low, high).orderBy("block_number")


def storage_diff_range(storage: DataFrame, blocks: DataFrame, address: str, slot: str, low: int, high: int) -> DataFrame:
    """Canonical changes of a slot, which is named by its decimal text."""
    rows = storage.filter((F.col("address") == address.lower()) & (F.col("slot") == slot))
    return _ranged(rows, blocks, low, high).orderBy("block_number")


def by_index(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that an index names by ``keys``, block and bucket; it names canonical blocks only.

    The index rows of one address are the way in: where Spark broadcasts them, their buckets
    decide while it runs which files of the diffs are opened.
    """
    return rows.join(index, [*keys, "bucket", "block_number", "block_hash"], "left_semi").select(*rows.columns)


def account_history(accounts: DataFrame, blocks: DataFrame) -> DataFrame:
    """All canonical account changes: the range read over all addresses and heights."""
    return accounts.join(active_blocks(blocks).select("block_number", "block_hash"), ["block_number", "block_hash"], "left_semi")


def receipts_by_tx_hash(receipts: DataFrame, blocks: DataFrame, tx_hash: str) -> DataFrame:
    """The canonical receipt of a transaction; of several, that of the highest block."""
    rows = receipts.filter(F.col("tx_hash") == tx_hash.lower())
    return rows.join(active_blocks(blocks).select("block_number", "block_hash"), ["block_number", "block_hash"], "left_semi").orderBy(F.desc("block_number"), "tx_index").limit(1)


def hash_at_height(blocks: DataFrame, heights: DataFrame) -> DataFrame:
    """Active block hash at each of ``heights(block_number)``, null where there is none."""
    return heights.join(active_blocks(blocks).select("block_number", "block_hash"), "block_number", "left")


def is_canonical(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked(block_number, block_hash)`` with whether each is canonical; unknown blocks are not."""
    known = blocks.select("block_number", "block_hash", (F.col("canonical_status") == "active").alias("is_canonical"))
    return asked.join(known, ["block_number", "block_hash"], "left").withColumn("is_canonical", F.coalesce("is_canonical", F.lit(False)))


# --- aggregates ---------------------------------------------------------------


def active_block_count(blocks: DataFrame) -> DataFrame:
    return active_blocks(blocks).agg(F.count("*").alias("active_blocks"))


def canonical_tip(blocks: DataFrame) -> DataFrame:
    """Height of the highest canonical block, 0 without any."""
    return active_blocks(blocks).agg(F.coalesce(F.max("block_number"), F.lit(0)).cast("bigint").alias("canonical_tip"))


def canonical_head(blocks: DataFrame) -> DataFrame:
    return active_blocks(blocks).agg(F.max("block_number").alias("block_number"), F.max_by("block_hash", F.struct("block_number", "block_hash")).alias("block_hash"))


def finalized_height(blocks: DataFrame) -> DataFrame:
    """Highest canonical block that is hinted as final, null without any."""
    return active_blocks(blocks).agg(F.max(F.when(F.col("finalized_hint"), F.col("block_number"))).alias("finalized_height"))


def receipt_block_roots(receipts: DataFrame) -> DataFrame:
    """Each stored block with its receipts' root."""
    return receipts.select("block_number", "block_hash", "receipt_root_anchor").distinct().orderBy("block_number", "block_hash")


# --- lenient decoding of stored text ------------------------------------------


def decoded_accounts(rows: DataFrame) -> DataFrame:
    """Account rows of an old store: bad hashes and numbers become zero, bad optional ones null, bad kinds ``touched``."""
    h = lambda c: F.coalesce(X.hash_text(F.col(c)), F.lit(X.ZERO_HASH)).alias(c)
    return rows.select(
        F.expr("try_cast(block_number AS bigint)").alias("block_number"), h("block_hash"), F.coalesce(X.address_text(F.col("address")), F.lit("0x" + "0" * 40)).alias("address"),
        X.u256(F.col("old_balance")).alias("old_balance"), X.u256(F.col("new_balance")).alias("new_balance"), "old_nonce", "new_nonce",
        X.hash_text(F.col("old_code_hash")).alias("old_code_hash"), X.hash_text(F.col("new_code_hash")).alias("new_code_hash"), X.lenient_change_kind(F.col("change_kind")).alias("change_kind"),
    )


def decoded_blocks(rows: DataFrame) -> DataFrame:
    h = lambda c: F.coalesce(X.hash_text(F.col(c)), F.lit(X.ZERO_HASH)).alias(c)
    return rows.select("block_number", h("block_hash"), h("parent_hash"), X.lenient_status(F.col("canonical_status")).alias("canonical_status"), F.col("finalized_hint").cast("boolean").alias("finalized_hint"), "derived_checkpoint_id")


def decoded_storage(rows: DataFrame) -> DataFrame:
    h = F.coalesce(X.hash_text(F.col("block_hash")), F.lit(X.ZERO_HASH)).alias("block_hash")
    return rows.select("block_number", h, F.coalesce(X.address_text(F.col("address")), F.lit("0x" + "0" * 40)).alias("address"), *(X.u256_or_zero(F.col(c)).alias(c) for c in ("slot", "old_value", "new_value")))


def decoded_receipts(rows: DataFrame) -> DataFrame:
    """Bytes come as ``0x`` text; text that isn't hex becomes null, or an empty bloom."""
    h = lambda c: F.coalesce(X.hash_text(F.col(c)), F.lit(X.ZERO_HASH)).alias(c)
    return rows.select("block_number", h("block_hash"), "tx_index", h("tx_hash"), "receipt_index", X.from_hex(F.col("receipt_rlp")).alias("receipt_rlp"), h("receipt_root_anchor"), X.bloom(X.from_hex(F.col("log_bloom"))).alias("log_bloom"), (F.col("status") != 0).alias("status"), "cumulative_gas_used")


def decoded_ops(rows: DataFrame) -> DataFrame:
    """Undo operations of an old store; unknown tables read as account diffs."""
    return rows.select("reorg_target_block", "block_hash", "op_sequence", X.lenient_table(F.col("table_name")).alias("table_name"), "primary_key_ref", "inverse_payload")


#: What a store can take over.
DECODERS = {"block_status": decoded_blocks, "account_diffs": decoded_accounts, "storage_diffs": decoded_storage, "receipt_artifacts": decoded_receipts}
