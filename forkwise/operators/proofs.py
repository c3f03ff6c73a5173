"""Receipt roots and inclusion proofs.

Receipts of a block come together in one row (a block's gas limit bounds them), and slices of an
Arrow batch are hashed at once, so that a task holds the tries of few blocks. Roots alone don't
keep any proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import Corrupt, NotFound
from ..functions import trie
from ..functions.keccak import keccak256_many
from . import reads


def by_block(receipts: DataFrame, *more: Column) -> DataFrame:
    """block_number, block_hash, and tx_hashes and encoded receipts in the order of their index; ``more`` aggregates."""
    whole = F.array_sort(F.collect_list(F.struct("receipt_index", "receipt_rlp", "tx_hash", "tx_index")))
    rows = receipts.groupBy("block_number", "block_hash").agg(whole.alias("r"), *more)
    return rows.select(*(c for c in rows.columns if c != "r"), F.transform("r", lambda x: x["receipt_rlp"]).alias("encoded"), F.transform("r", lambda x: x["tx_hash"]).alias("tx_hashes"), F.transform("r", lambda x: x["tx_index"]).alias("tx_indexes"))


def _hex(data: bytes) -> str:
    return "0x" + data.hex()


#: Blocks, or proofs, that are worked on together.
BLOCKS, ROWS = 256, 2048


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    return (b.slice(first, size) for b in batches for first in range(0, b.num_rows, size))


def _roots_of(grouped: DataFrame) -> DataFrame:
    """``grouped`` by block with its root and number of receipts instead of the receipts."""
    kept = [c for c in grouped.columns if c != "encoded"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, BLOCKS):
            blocks = b.column("encoded").to_pylist()
            found = [_hex(t.hash) for t in trie.tries(blocks)]
            yield pa.RecordBatch.from_arrays([*map(b.column, kept), pa.array(found, pa.string()), pa.array(map(len, blocks), pa.int64())], [*kept, "receipts_root", "n_receipts"])

    kinds = ", ".join(f"{c} {grouped.schema[c].dataType.simpleString()}" for c in kept)
    return grouped.mapInArrow(made, f"{kinds}, receipts_root string, n_receipts bigint")


def roots(receipts: DataFrame) -> DataFrame:
    """block_number, block_hash, receipts_root and n_receipts of every block that has receipts."""
    return _roots_of(by_block(receipts).select("block_number", "block_hash", "encoded"))


def roots_and_anchors(receipts: DataFrame, anchors: list[str]) -> DataFrame:
    """``roots`` with each block's distinct combinations of stored anchors, from one pass over the receipts."""
    stored = F.collect_set(F.struct(*anchors)).alias("stored")
    rows = _roots_of(by_block(receipts, stored).select("block_number", "block_hash", "encoded", "stored"))
    return rows.withColumn("stored", F.explode("stored")).select("block_number", "block_hash", "receipts_root", "n_receipts", "stored.*")


def roots_of_blocks(blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """block_number, block_hash, receipts_root and n_receipts of every block; one without receipts has the root of the empty trie."""
    out = blocks.select("block_number", "block_hash").join(roots(receipts), ["block_number", "block_hash"], "left")
    return out.select("block_number", "block_hash", F.coalesce("receipts_root", F.lit(_hex(trie.EMPTY_ROOT))).alias("receipts_root"), F.coalesce("n_receipts", F.lit(0).cast("bigint")).alias("n_receipts"))


def anchored(receipts: DataFrame) -> DataFrame:
    """``receipts`` with the root of their block as anchor."""
    own = roots(receipts).select("block_hash", "receipts_root")
    return receipts.join(own, "block_hash").withColumn("receipt_root_anchor", F.col("receipts_root")).select(*receipts.columns)


PROOFS = "block_number long, block_hash string, tx_hash string, tx_index int, receipt_index int, receipt_rlp binary, receipts_root string, nodes array<binary>"


def proofs(receipts: DataFrame) -> DataFrame:
    """The inclusion proof of every receipt: encoded nodes from the root to the leaf."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.list_(pa.binary())]
        for b in _slices(batches, BLOCKS):
            rows = b.to_pylist()
            out = [
                (row["block_number"], row["block_hash"], h, x, i, e, root, trie.proof(t, i))
                for row, t in zip(rows, trie.tries([r["encoded"] for r in rows]))
                for root in [_hex(t.hash)]
                for i, (e, h, x) in enumerate(zip(row["encoded"], row["tx_hashes"], row["tx_indexes"]))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in PROOFS.split(", ")])

    return by_block(receipts).mapInArrow(made, PROOFS)


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` of ``proofs`` with whether each proof holds. Nodes that proofs share are hashed and decoded once."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, ROWS):
            roots, indexes, receipts, given = (b.column(c).to_pylist() for c in ("receipts_root", "receipt_index", "receipt_rlp", "nodes"))
            nodes = list({n for ns in given for n in ns})
            digests, decoded = dict(zip(nodes, keccak256_many(nodes))), lru_cache(maxsize=ROWS)(trie.decode)
            ok = [trie.verify(bytes.fromhex(r[2:]), i, e, ns, digests.__getitem__, decoded) for r, i, e, ns in zip(roots, indexes, receipts, given)]
            yield b.append_column("verified", pa.array(ok, pa.bool_()))

    return rows.select(*(x.split()[0] for x in PROOFS.split(", "))).mapInArrow(made, PROOFS + ", verified boolean")


def canonical_anchor(blocks: DataFrame) -> DataFrame:
    """For every known block: whether it is canonical, the canonical head, and the finalized height."""
    one = F.lit(0).alias("_one")
    head = reads.canonical_head(blocks).select(F.col("block_number").alias("head_number"), F.col("block_hash").alias("head_hash"), one)
    final = reads.finalized_height(blocks).select("finalized_height", one)
    rows = blocks.select("block_number", "block_hash", (F.col("canonical_status") == "active").alias("is_canonical"), one)
    return rows.join(F.broadcast(head.join(final, "_one")), "_one").drop("_one")


def proof_by_tx_hash(receipts: DataFrame, blocks: DataFrame, tx_hash: str) -> dict:
    """Proof and canonical anchor of a transaction's receipt.

    The root worked out from the stored receipts must equal the stored one.
    """
    found = reads.receipts_by_tx_hash(receipts, blocks, tx_hash).collect()
    if not found:
        raise NotFound(f"no canonical receipt for transaction {tx_hash}")
    target = found[0]
    whole = receipts.filter((F.col("block_number") == target["block_number"]) & (F.col("block_hash") == target["block_hash"]))
    proof = proofs(whole).filter(F.col("receipt_index") == target["receipt_index"]).collect()[0].asDict()
    if target["receipt_root_anchor"] is not None and proof["receipts_root"] != target["receipt_root_anchor"]:
        raise Corrupt(f"receipts of block {target['block_hash']} don't give the stored root")
    anchor = canonical_anchor(blocks).filter(F.col("block_hash") == target["block_hash"]).collect()[0].asDict()
    return proof | {"anchor": anchor}
