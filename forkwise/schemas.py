"""Schemas of all chain tables. They are fixed; nothing is ever inferred.

Hashes and addresses are lower-case ``0x`` hex text, 256-bit numbers canonical decimal text.
"""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}


def fields(spec: str) -> T.StructType:
    """A schema from ``name kind`` pairs."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in spec.split(","))])


ACCOUNT = fields("balance string, nonce bigint, code_hash string")
SLOT_CHANGE = fields("slot string, old_value string, new_value string")
CHANGE = T.StructType([T.StructField("address", T.StringType()), T.StructField("old", ACCOUNT), T.StructField("new", ACCOUNT), T.StructField("storage", T.ArrayType(SLOT_CHANGE))])
#: Type, encoded list of logs and bloom may be null: a legacy receipt without logs.
RECEIPT = fields("tx_hash string, status boolean, cumulative_gas_used bigint, tx_type int, logs_rlp binary, log_bloom binary")

#: One row for each block on each side of a notification. A null account is absent on that side.
CHAIN_LOG = T.StructType(
    [
        *fields("seq bigint, kind string, side string, block_number bigint, block_hash string, parent_hash string"),
        T.StructField("changes", T.ArrayType(CHANGE)),
        T.StructField("receipts", T.ArrayType(RECEIPT)),
        T.StructField("transactions", T.ArrayType(T.StringType())),  # hashes; null if receipts bring them
    ]
)

CANONICAL_BLOCKS = fields("block_number bigint, block_hash string, parent_hash string, canonical_status string, finalized_hint boolean, derived_checkpoint_id bigint")
ACCOUNT_DIFFS = fields("block_number bigint, block_hash string, address string, old_balance string, new_balance string, old_nonce bigint, new_nonce bigint, old_code_hash string, new_code_hash string, change_kind string")
STORAGE_DIFFS = fields("block_number bigint, block_hash string, address string, slot string, old_value string, new_value string")
RECEIPT_ARTIFACTS = fields("block_number bigint, block_hash string, tx_index int, tx_hash string, receipt_index int, receipt_rlp binary, receipt_root_anchor string, log_bloom binary, status boolean, cumulative_gas_used bigint")
REVERT_OPS = fields("reorg_target_block bigint, block_hash string, op_sequence bigint, table_name string, primary_key_ref string, inverse_payload string")
STAGE_CHECKPOINTS = fields("id bigint, streaming bigint, durable bigint, compacted_until bigint, proof_indexed_until bigint, canonical_tip bigint, finished_height bigint")
ADDRESS_BLOCK_INDEX = fields("address string, block_number bigint, block_hash string, change_kind string")
SLOT_BLOCK_INDEX = fields("address string, slot string, block_number bigint, block_hash string")
BLOCK_EVENTS = fields("seq bigint, phase int, kind string, block_number bigint, block_hash string, parent_hash string, event string")
ROLLBACKS = fields("seq bigint, base bigint")
GAPS = fields("block_number bigint, found_at bigint")
QUARANTINE = fields("seq bigint, block_number bigint, block_hash string, reason string, file string, line string")
RESOLUTIONS = fields("line string")
BLOCK_STATUS = fields("block_number bigint, block_hash string, seq bigint, phase int, event string, active_seq bigint, active_phase int, parent_hash string")
FINISHED_HEIGHTS = fields("seq bigint, finished_height bigint")

CURSORS = ("streaming", "durable", "compacted_until", "proof_indexed_until", "canonical_tip", "finished_height")
