"""All invariants over a live store, of one version of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cursors, fold, invariants
from ..streaming import ingest
from .store import KEYS, Store


def violations(store: Store) -> dict[str, DataFrame]:
    """What violates each invariant; roots, which are worked out anew, come last."""
    store = store.pinned()
    blocks = store.canonical_blocks()
    diffs = {name: store.physical(name) for name in KEYS}
    top, floor = ingest.indexed_until(store), store.floor()
    lost = blocks.filter("canonical_status = 'reorged'")
    index, slots = (store.read(name, high=top) for name in ingest.INDEXES)
    live = {name: fold.active(diffs[name], blocks).filter(F.col("block_number") <= top) for name in ("account_diffs", "storage_diffs")}
    points = store.read("stream_checkpoints").unionByName(store.read("stage_checkpoints")).unionByName(cursors.merged(store.read("stream_checkpoints"), store.read("stage_checkpoints")))
    heights = blocks.filter("canonical_status = 'active'").groupBy("block_number").agg(F.count("*").alias("n"))
    return {
        **{f"orphan_{name}": invariants.orphans(rows, blocks) for name, rows in diffs.items()},
        "two_active_blocks_of_a_height": heights.filter("n > 1"),
        "status_differs_from_the_log": _status_differences(store, blocks, floor),
        "cursors_out_of_order": invariants.inconsistent_checkpoints(points),
        "visible_rows_of_losing_blocks": invariants.visible(index.select("block_hash").unionByName(slots.select("block_hash")), blocks.withColumn("canonical_status", F.lit("active")), lost),
        "address_index": invariants.index_parity(index, live["account_diffs"], ["address", "block_number", "block_hash"]),
        "slot_index": invariants.index_parity(slots, live["storage_diffs"], ["address", "slot", "block_number", "block_hash"]),
        "index_above_cursor": store.read("address_block_index").filter(F.col("block_number") > compaction_top(store)),
        "wrong_roots": invariants.wrong_roots(diffs["receipt_artifacts"]),
    }


def compaction_top(store: Store) -> int:
    return cursors.latest(store.read("stage_checkpoints")).collect()[0]["compacted_until"]


def _status_differences(store: Store, blocks: DataFrame, floor: int) -> DataFrame:
    """Blocks above the floor whose kept status is not what the whole log gives."""
    folded = fold.canonical_blocks(store.read("block_events")).filter(F.col("block_number") > floor)
    kept = blocks.filter(F.col("block_number") > floor).select("block_hash", F.col("canonical_status").alias("kept"))
    return folded.join(kept, "block_hash", "full").filter(~F.col("canonical_status").eqNullSafe(F.col("kept")))


def check_all(store: Store) -> DataFrame:
    """check and violations of every invariant."""
    return invariants.report(violations(store))
