"""The read API: ranges, receipts with proofs, and health.

Reads return DataFrames; ``as_json`` gives what a service would send. Errors are typed. A
range goes in by the index as far as it stands, and above it by the status of blocks. Every
read is of one version of the store.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import Settings
from .errors import ApiError, BadRequest
from .operators import cursors, proofs, reads
from .sources.store import Store
from .streaming import ingest


class ChainApi:
    def __init__(self, store: Store, settings: Settings | None = None):
        self.store, self.settings = store, settings or Settings(store.root)

    def _address(self, address: str) -> str:
        if len(address) != 42 or not address.startswith("0x") or set(address[2:].lower()) - set("0123456789abcdef"):
            raise BadRequest(f"not an address: {address}")
        return address.lower()

    def _range(self, table: str, index: str, low: int, high: int, **asked: str) -> DataFrame:
        """Canonical rows of one key from ``low`` to ``high``, by height."""
        low, high = reads.checked_range(low, high)
        store, there = self.store.pinned(), F.lit(True)
        for column, value in asked.items():
            there = there & (F.col(column) == value)
        top = ingest.indexed_until(store)
        found = []
        if low <= top:
            named = store.read(index, low, min(high, top), with_bucket=True).filter(there)
            rows = store.physical(table, low, min(high, top), there, with_bucket=True)
            found.append(reads.by_index(rows, named, list(asked)).drop("bucket"))
        if high > top:
            low = max(low, top + 1)
            found.append(reads.account_history(store.physical(table, low, high, there), store.canonical_blocks(low, high)))
        return (found[0] if len(found) == 1 else found[0].unionByName(found[1])).orderBy("block_number")

    def account_diffs(self, address: str, from_block: int, to_block: int) -> DataFrame:
        return self._range("account_diffs", "address_block_index", from_block, to_block, address=self._address(address))

    def storage_diffs(self, address: str, slot: str, from_block: int, to_block: int) -> DataFrame:
        if not slot.isdigit():
            raise BadRequest(f"not a slot: {slot}")
        return self._range("storage_diffs", "slot_block_index", from_block, to_block, address=self._address(address), slot=str(int(slot)))

    def receipt_proof(self, tx_hash: str) -> dict:
        """The filter on the hash reaches the files' Bloom filters; the block's other receipts come from its bucket only."""
        store, known = self.store.pinned(), None
        if self.settings.require_compacted:
            known = cursors.latest(store.read("stage_checkpoints")).collect()[0]["compacted_until"]
        found = store.physical("receipt_artifacts", high=known, where=F.col("tx_hash") == tx_hash.lower())
        heights = [r["block_number"] for r in found.select("block_number").distinct().collect()]  # of the branches that hold it
        receipts = store.physical("receipt_artifacts", min(heights, default=0), max(heights, default=0))
        return proofs.proof_by_tx_hash(receipts.filter(F.col("block_number").isin(heights)), store.canonical_blocks(), tx_hash)

    def cursors(self) -> DataFrame:
        """One row of all cursors, those of the stream and of the index side."""
        return cursors.merged(self.store.read("stream_checkpoints"), self.store.read("stage_checkpoints"))

    def finished_height(self) -> int:
        """Height that the stream's source may forget up to; rollbacks lower it."""
        return cursors.latest(self.store.read("stream_checkpoints")).collect()[0]["finished_height"]

    def finished_heights(self) -> DataFrame:
        """What each notification that commits has reported as finished, in their order."""
        return self.store.read("finished_heights").distinct().orderBy("seq")

    def health(self) -> dict:
        return {"status": "ok"}


def _plain(value: object) -> object:
    if isinstance(value, (bytes, bytearray)):
        return "0x" + bytes(value).hex()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def as_json(call, *args) -> tuple[int, str]:
    """Status and JSON body of an API call."""
    try:
        got = call(*args)
        body = {"rows": [r.asDict(recursive=True) for r in got.collect()]} if isinstance(got, DataFrame) else got
        return 200, json.dumps(_plain(body))
    except ApiError as e:
        return e.status, json.dumps(e.body())
