"""Whole logs through the store: statuses, visible rows, cursors, indexes, proofs."""

from __future__ import annotations

import random
import time

import pytest

from forkwise import schemas
from forkwise.api import ChainApi, as_json
from forkwise.config import Settings
from forkwise.errors import Quarantined
from forkwise.operators import cursors, extract, fold, invariants, proofs
from forkwise.sources import audit
from forkwise.sources.store import Store
from forkwise.streaming import ingest
from scenarios import addr, block, block_hash, change, log, plain, receipt, tx

FORK = lambda *n: [plain(i, 1) for i in n]
BASE = lambda *n: [plain(i) for i in n]

# name: log, active, reorged, visible accounts, durable
SCENARIOS = {
    "linear": ([("commit", [], BASE(1, 2, 3))], 3, 0, {1, 2, 3}, 3),
    "depth_1": ([("commit", [], BASE(1)), ("reorg", BASE(1), FORK(1))], 1, 1, {11}, 1),
    "depth_3": ([("commit", [], BASE(1, 2, 3)), ("reorg", BASE(1, 2, 3), FORK(1, 2, 3))], 3, 3, {11, 12, 13}, 3),
    "partial": ([("commit", [], BASE(1, 2, 3, 4, 5)), ("reorg", BASE(3, 4, 5), FORK(3, 4, 5))], 5, 3, {1, 2, 13, 14, 15}, 5),
    "duplicate": ([("commit", [], BASE(1)), ("commit", [], BASE(1))], 1, 0, {1}, 1),
    "depth_10": ([("commit", [], BASE(*range(1, 11))), ("reorg", BASE(*range(1, 11)), FORK(*range(1, 11)))], 10, 10, set(range(11, 21)), 10),
    "phantom": ([("commit", [], BASE(1, 2, 3)), ("revert", FORK(1, 2, 3), [])], 3, 0, {1, 2, 3}, 3),
    "shortening": ([("commit", [], BASE(1, 2)), ("revert", BASE(2), [])], 1, 1, {1}, 1),
    "back_again": ([("commit", [], BASE(1)), ("reorg", BASE(1), FORK(1)), ("reorg", FORK(1), BASE(1))], 1, 1, {1}, 1),
}


def last_cursors(events):
    """Id, streaming, canonical_tip and finished_height after a whole fold."""
    end = cursors.timeline(events).orderBy("seq", "step", "block_number").collect()[-1]
    return cursors.latest(cursors.checkpoints(events)).collect()[0].id, end.streaming, end.canonical_tip, end.finished_height


def stored_cursors(store):
    point = cursors.latest(store.read("stream_checkpoints")).collect()[0]
    assert point.durable == point.streaming
    return point.id, point.streaming, point.canonical_tip, point.finished_height


def frame(spark, items):
    return spark.createDataFrame(log(*items), schemas.CHAIN_LOG)


@pytest.mark.parametrize("name", SCENARIOS)
def test_status_and_cursors(spark, name):
    items, active, reorged, visible, durable = SCENARIOS[name]
    rows = frame(spark, items)
    events = fold.block_events(rows)
    status = fold.status_after(events).collect()
    assert sorted([r.canonical_status for r in status]) == ["active"] * active + ["reorged"] * reorged
    diffs = fold.active(extract.account_diffs(extract.changes_of(rows)), fold.canonical_blocks(events))
    assert sorted(r.address for r in diffs.collect()) == sorted(map(addr, visible))
    last = cursors.on_restart(cursors.checkpoints(events, span=2)).collect()[0]
    assert last.durable == last.streaming == durable


def reference_fold(items):
    """Plain sequential fold of a log: status of each hash, and (streaming, finished) after it."""
    status, streaming, finished = {}, 0, 0
    for _, old, new in items:
        if any(status.get(b["block_hash"]) == "active" for b in old):
            base = max(0, min(b["block_number"] for b in old) - 1)
            streaming, finished = base, min(finished, base)
        for b in old:
            if b["block_hash"] in status:
                status[b["block_hash"]] = "reorged"
        for b in new:
            status[b["block_hash"]] = "active"
            streaming = max(streaming, b["block_number"])
        if new:
            finished = max(b["block_number"] for b in new)
    return status, streaming, finished


def test_random_logs(spark):
    rng = random.Random(4)
    for _ in range(4):
        items = []
        for _ in range(25):
            low = rng.randint(1, 9)
            run = range(low, low + rng.randint(1, 3))
            old, new = ([plain(i, rng.randint(0, 2)) for i in run] for _ in range(2))
            items.append(rng.choice([("commit", [], new), ("reorg", old, new), ("revert", old, [])]))
        status, streaming, finished = reference_fold(items)
        rows = log(*items)
        rows += rng.sample(rows, 8)  # delivered again
        rng.shuffle(rows)
        events = fold.block_events(spark.createDataFrame(rows, schemas.CHAIN_LOG))
        assert {r.block_hash: r.canonical_status for r in fold.status_after(events).collect()} == status
        last = cursors.timeline(events, span=3).orderBy("seq", "step", "block_number").collect()[-1]
        assert (last.streaming, last.finished_height) == (streaming, finished)


def test_changes_of_every_kind(spark):
    storage = [("9", "0", "5"), ("10", "7", "7")]
    rows = frame(spark, [("commit", [], [block(1, 0, [change(1, None, 5, storage), change(2, 5, None), change(3, 5, 5), change(4, 5, 6), change(5, None, None, storage)], [receipt(1)])])])
    changes = extract.changes_of(rows)
    assert {r.address: r.change_kind for r in extract.account_diffs(changes).collect()} == {addr(1): "created", addr(2): "destroyed", addr(3): "touched", addr(4): "modified"}
    slots = extract.storage_diffs(extract.slots_of(changes))
    assert [(r.address, r.slot) for r in slots.collect()] == [(addr(1), "9")]
    ops = extract.revert_ops(extract.account_diffs(changes), slots, extract.receipts_of(rows)).orderBy("op_sequence").collect()
    assert [o.table_name for o in ops] == ["account_diffs", "storage_diffs", "account_diffs", "account_diffs", "account_diffs", "receipt_artifacts"]


def test_block_without_outcome_is_an_error(spark):
    items = log(("commit", [], [plain(1)]))
    items[0]["changes"] = None
    with pytest.raises(Exception, match="no outcome"):
        extract.account_diffs(extract.changes_of(spark.createDataFrame(items, schemas.CHAIN_LOG))).collect()


def test_stream_store_index_and_api(spark, tmp_path):
    settings = Settings(store=str(tmp_path / "store"), max_files_per_trigger=1, poll_seconds=0.5)
    folder, state = str(tmp_path / "log"), str(tmp_path / "state")

    def send(items, first):
        rows = [r | {"seq": r["seq"] + first - 1} for r in log(*items)]
        spark.createDataFrame(rows, schemas.CHAIN_LOG).coalesce(1).write.mode("append").parquet(folder)
        ingest.ingest(spark, folder, settings, state, drain=True).awaitTermination()
        assert stored_cursors(Store(spark, settings.store)) == last_cursors(Store(spark, settings.store).read("block_events"))

    send([("commit", [], BASE(1, 2, 3, 4, 5))], 1)
    store = Store(spark, settings.store)
    assert ingest.compact_all(store, settings, 3) == 3
    assert ingest.indexes(store)[0].count() == 3
    before = store.pinned()
    send([("reorg", BASE(3, 4, 5), FORK(3, 4, 5))], 2)
    # The stage's cursor goes back below the reorganised heights and then up again.
    assert ingest.indexes(store)[2] == 2  # what the reorganisation took back is not shown, though it is still there
    assert store.read("address_block_index").count() == 3
    assert ingest.stage_step(store, settings, 2).end == 2
    assert ingest.indexes(store)[0].count() == 2 and store.read("address_block_index").count() == 2  # now it is gone
    assert before.read("address_block_index").count() == 3 and before.canonical_blocks().count() == 5  # an earlier reader keeps its version
    # The index query is woken at its interval until it has caught up.
    query = ingest.follow(spark, settings, str(tmp_path / "follow"))
    deadline = time.time() + 120
    while ingest.indexes(store)[2] < 5 and time.time() < deadline and query.isActive:
        time.sleep(0.5)
    query.stop()
    assert ingest.compact_all(store, settings) == 5
    index, _, top = ingest.indexes(store)
    assert top == 5
    assert invariants.index_parity(index, store.active("account_diffs"), ["address", "block_number", "block_hash"]).isEmpty()
    assert invariants.wrong_roots(store.physical("receipt_artifacts")).isEmpty()
    assert invariants.orphans(store.physical("account_diffs"), store.canonical_blocks()).isEmpty()

    api = ChainApi(store)
    merged = api.cursors().collect()
    assert api.cursors().filter(~cursors.consistent()).isEmpty()
    assert [(r.streaming, r.durable, r.compacted_until, r.canonical_tip, r.finished_height) for r in merged] == [(5, 5, 5, 5, 5)] and api.finished_height() == 5
    assert audit.check_all(store).filter("violations > 0").isEmpty()
    assert store.read("index_gaps").isEmpty() and store.read("address_block_index").count() == store.read("address_block_index").distinct().count()
    assert [r.block_number for r in api.account_diffs(addr(13), 1, 5).collect()] == [3]
    assert api.account_diffs(addr(3), 1, 5).isEmpty()
    assert as_json(api.account_diffs, addr(3), 5, 1)[0] == 400
    assert api.storage_diffs(addr(3), "1", 1, 5).isEmpty() and as_json(api.storage_diffs, addr(3), "x", 1, 5)[0] == 400
    assert as_json(api.account_diffs, "0x12", 1, 5)[0] == 400
    assert as_json(api.receipt_proof, tx(3))[0] == 404
    found = api.receipt_proof(tx(13))
    assert found["block_hash"] == block_hash(3, 1) and found["anchor"]["is_canonical"] and found["anchor"]["head_number"] == 5
    assert as_json(api.receipt_proof, tx(13))[0] == 200


def test_checkpoints_of_batches_equal_the_whole_fold(spark, tmp_path):
    """A random log in three batches, the last of which repeats notifications of the first."""
    rng, items = random.Random(9), []
    for _ in range(12):
        low = rng.randint(1, 6)
        run = range(low, low + rng.randint(1, 3))
        old, new = ([plain(i, rng.randint(0, 1)) for i in run] for _ in range(2))
        items.append(rng.choice([("commit", [], new), ("reorg", old, new), ("revert", old, [])]))
    rows = log(*items)
    store = Store(spark, str(tmp_path / "store")).create()
    for batch, part in enumerate(([r for r in rows if r["seq"] <= 5], [r for r in rows if 5 < r["seq"] <= 9], [r for r in rows if r["seq"] > 9 or r["seq"] in (2, 3)])):
        ingest.apply_log(store, spark.createDataFrame(part, schemas.CHAIN_LOG), batch)
        events = store.read("block_events").distinct()
        assert stored_cursors(store) == last_cursors(events)
        assert {(r.seq, r.base) for r in store.read("rollbacks").collect()} >= {(r.seq, r.base) for r in fold.rollback_bases(events).collect()}


def test_unfit_batches_are_quarantined(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    items = log(("commit", [], [plain(1), plain(2), plain(4)]))
    items[1]["changes"] = None
    with pytest.raises(Quarantined, match="no outcome"):
        ingest.apply_log(store, spark.createDataFrame(items, schemas.CHAIN_LOG), 0)
    assert {(r.block_number, r.reason) for r in store.read("quarantine").collect()} == {(2, "no outcome"), (1, "the segment has holes")}
    assert store.read("block_events").isEmpty() and "ingest" not in store.committed()


def test_operations_on_the_block_table(spark):
    blocks = fold.canonical_blocks(fold.block_events(frame(spark, [("commit", [], BASE(1, 2, 3))])))
    ops = extract.block_ops(spark.createDataFrame([(2, block_hash(2)), (9, block_hash(9, 5))], "block_number bigint, block_hash string"))
    marked = {r.block_number: r.canonical_status for r in fold.mark_reorged(blocks, ops).collect()}
    assert marked == {1: "active", 2: "reorged", 3: "active"}


def test_proofs_of_many_receipts(spark):
    receipts = [receipt(i, i % 3 > 0, 21000 * (i + 1)) for i in range(130)]
    rows = extract.receipt_artifacts(extract.receipts_of(frame(spark, [("commit", [], [block(1, 0, [], receipts)])])))
    checked = proofs.verified(proofs.proofs(rows)).collect()
    assert len(checked) == 130 and all(r.verified for r in checked)


def test_roots_of_blocks_without_receipts(spark):
    """A block without receipts has the public root of the empty trie; a segment without blocks is refused."""
    rows = frame(spark, [("commit", [], [block(1, 0, [], [receipt(1)]), block(2)])])
    receipts = extract.receipt_artifacts(extract.receipts_of(rows))
    got = {r.block_number: (r.receipts_root, r.n_receipts) for r in proofs.roots_of_blocks(fold.canonical_blocks(fold.block_events(rows)), receipts).collect()}
    assert got[2] == ("0x56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421", 0)
    assert got[1] == (proofs.roots(receipts).collect()[0].receipts_root, 1)
    for items in (("commit", [], []), ("reorg", [], BASE(1)), ("reorg", BASE(1), []), ("revert", [], [])):
        with pytest.raises(ValueError, match="without blocks"):
            log(items)


def test_a_task_gets_no_more_of_a_longer_chain(spark):
    from forkwise.operators import compaction
    from forkwise.sources import projection as P

    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert P.tasks_for(spark, 1) is None
    for heights in (P.HEIGHTS_IN_TASK * few * 3, P.HEIGHTS_IN_TASK * few * 60):
        assert heights / P.tasks_for(spark, heights) <= P.HEIGHTS_IN_TASK
    rows = spark.createDataFrame([("a", "1", n, f"h{n}") for n in range(20)], "address string, slot string, block_number long, block_hash string")
    blocks = rows.select("block_number", "block_hash").selectExpr("*", "'active' AS canonical_status")
    index = compaction.slot_index(rows, blocks, few + 3)
    assert sorted(index.collect()) == sorted(rows.collect())
    assert f", {few + 3})" in index._jdf.queryExecution().toString()


def test_wrong_roots_reads_the_receipts_once_and_sees_missing_anchors(spark):
    from forkwise.functions import trie
    from forkwise.operators import invariants

    right = "0x" + trie.root_hash([b"r" * 40]).hex()
    rows = [(n, f"h{n}", 0, "t", 0, bytearray(b"r" * 40), anchor) for n, anchor in enumerate([right, "0x00", None])]
    receipts = spark.createDataFrame(rows, "block_number long, block_hash string, tx_index int, tx_hash string, receipt_index int, receipt_rlp binary, receipt_root_anchor string")
    wrong = invariants.wrong_roots(receipts)
    assert {r["block_hash"] for r in wrong.collect()} == {"h1", "h2"}
    assert "Join" not in wrong._jdf.queryExecution().toString()
