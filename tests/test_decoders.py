"""Lenient decoding of old stores, and receipts of other types."""

from __future__ import annotations

from forkwise import schemas
from forkwise.functions import trie
from forkwise.functions.scalars import ZERO_HASH
from forkwise.operators import extract, reads
from forkwise.sources.store import Store
from scenarios import block, block_hash, log, receipt, tx

ADDRESS = "0x" + "Ab" * 20
ACCOUNT = "block_number string, block_hash string, address string, old_balance string, new_balance string, old_nonce bigint, new_nonce bigint, old_code_hash string, new_code_hash string, change_kind string"


def test_accounts(spark):
    rows = [
        ("7", "0x" + "AA" * 32, ADDRESS, "007", str(2**256), 1, 2, "0x12", None, "modified"),
        ("x", "bad", "0x1", None, "12a", None, None, None, "0x" + "0" * 64, "no such kind"),
    ]
    a, b = reads.decoded_accounts(spark.createDataFrame(rows, ACCOUNT)).collect()
    assert (a.block_number, a.block_hash, a.address, a.old_balance, a.new_balance, a.old_code_hash, a.change_kind) == (7, "0x" + "aa" * 32, ADDRESS.lower(), "7", None, None, "modified")
    assert (b.block_number, b.block_hash, b.address, b.new_balance, b.new_code_hash, b.change_kind) == (None, ZERO_HASH, "0x" + "0" * 40, None, "0x" + "0" * 64, "touched")


def test_blocks_storage_receipts_and_ops(spark):
    blocks = spark.createDataFrame([(1, block_hash(1), "?", "lost", "true", 3), (2, block_hash(2), block_hash(1), "reorged", None, None)], "block_number bigint, block_hash string, parent_hash string, canonical_status string, finalized_hint string, derived_checkpoint_id bigint")
    got = reads.decoded_blocks(blocks).collect()
    assert [(r.parent_hash, r.canonical_status, r.finalized_hint) for r in got] == [(ZERO_HASH, "active", True), (block_hash(1), "reorged", None)]
    slots = spark.createDataFrame([(1, block_hash(1), ADDRESS, "010", "-1", str(2**256 - 1))], "block_number bigint, block_hash string, address string, slot string, old_value string, new_value string")
    assert [tuple(r)[3:] for r in reads.decoded_storage(slots).collect()] == [("10", "0", str(2**256 - 1))]
    kinds = "block_number bigint, block_hash string, tx_index int, tx_hash string, receipt_index int, receipt_rlp string, receipt_root_anchor string, log_bloom string, status int, cumulative_gas_used bigint"
    r = reads.decoded_receipts(spark.createDataFrame([(1, block_hash(1), 0, tx(1), 0, "0xc0ff", None, "0x01", 1, 5), (1, block_hash(1), 1, "?", 1, "c0", None, "zz", 0, 6)], kinds)).collect()
    assert [(bytes(r[0].receipt_rlp), r[1].receipt_rlp), (r[0].status, r[1].status), r[1].tx_hash] == [(b"\xc0\xff", None), (True, False), ZERO_HASH]
    assert bytes(r[0].log_bloom) == b"\x01" + bytes(255) and bytes(r[1].log_bloom) == bytes(256)
    ops = spark.createDataFrame([(1, block_hash(1), 0, t, "{}", "") for t in ("storage_diffs", "other")], schemas.REVERT_OPS)
    assert [o.table_name for o in reads.decoded_ops(ops).collect()] == ["storage_diffs", "account_diffs"]


def test_a_store_takes_over_old_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    rows = spark.createDataFrame([("7", block_hash(7), ADDRESS, "1", "2", 0, 0, None, None, "modified")], ACCOUNT)
    store.take_over("account_diffs", rows, 0)
    assert [(r.address, r.new_balance) for r in store.physical("account_diffs").collect()] == [(ADDRESS.lower(), "2")]


def test_typed_receipts_with_logs(spark):
    """Type byte, bloom and logs are part of the encoding; positions beyond the shorter list are left out."""
    logs, bloom = b"\xc3\x82\x01\x02", bytes([1]) + bytes(255)
    typed = receipt(1) | {"tx_type": 2, "logs_rlp": logs, "log_bloom": bloom}
    items = log(("commit", [], [block(1, 0, [], [receipt(0), typed, receipt(2)])]))
    items[0]["transactions"] = [tx(10), tx(11)]
    rows = extract.receipt_artifacts(extract.receipts_of(spark.createDataFrame(items, schemas.CHAIN_LOG))).orderBy("tx_index").collect()
    assert [r.tx_hash for r in rows] == [tx(10), tx(11)]
    body = [trie.rlp_bytes(b"\x01"), trie.rlp_bytes((21000).to_bytes(2, "big"))]
    assert bytes(rows[0].receipt_rlp) == trie.rlp_items([*body, trie.rlp_bytes(bytes(256)), b"\xc0"])
    assert bytes(rows[1].receipt_rlp) == b"\x02" + trie.rlp_items([*body, trie.rlp_bytes(bloom), logs])
    assert bytes(rows[1].log_bloom) == bloom
