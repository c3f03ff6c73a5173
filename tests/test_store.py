"""The store: versions, buckets, folding, snapshots of status, unwinding, damage and retention."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from forkwise import schemas
from forkwise.api import ChainApi
from forkwise.config import Settings
from forkwise.errors import Damaged, Quarantined
from forkwise.operators import cursors, fold, reads
from forkwise.sources import audit
from forkwise.sources.manifest import Conflict
from forkwise.sources.store import Store
from forkwise.streaming import ingest, signals
from scenarios import addr, block_hash, log, plain, tx
from test_scenarios import last_cursors, stored_cursors


def frame(spark, items, first=1):
    return spark.createDataFrame([r | {"seq": r["seq"] + first - 1} for r in log(*items)], schemas.CHAIN_LOG).coalesce(1)


def scan_metrics(df):
    """Files and rows that the scans of a run read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    todo, out = [plan], {"files": 0, "rows": 0}
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name in ("FileSourceScanExec", "BatchScanExec"):
            for key, metric in (("files", "numFiles"), ("rows", "numOutputRows")):
                out[key] += node.metrics().get(metric).get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())] + ([node.plan()] if name.endswith("QueryStageExec") else [])
    return out


def test_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket=10).create()
    rows = lambda *n: spark.createDataFrame([(i, i) for i in n], schemas.GAPS)
    assert store.read("index_gaps").isEmpty() and store.version().number == -1
    first = store.append("a", 0, index_gaps=rows(1))
    assert store.append("a", 0, index_gaps=rows(5)) is None  # a batch takes effect once
    old = store.pinned()
    store.append("b", 0, index_gaps=rows(2))
    assert sorted(r.block_number for r in store.read("index_gaps").collect()) == [1, 2] and store.committed() == {"a": 0, "b": 0}
    assert [r.block_number for r in old.read("index_gaps").collect()] == [1]
    # Written and never published, as by a crash: nobody sees it.
    store.put("index_gaps", rows(9))
    assert store.read("index_gaps").count() == 2
    # A half-written record is no version either.
    open(tmp_path / "s" / "manifest" / ".000000000002.json.x", "w").write('{"version": 2, "com')
    assert store.version().number == 1
    # What another writer has replaced can't be replaced again.
    parts = store.version().of("index_gaps")
    store.publish(store.rewritten("index_gaps", parts), parts)
    with pytest.raises(Conflict):
        store.publish([], parts)
    assert store.read("index_gaps").count() == 2
    for n in range(40):  # past several full records
        store.publish(committed={"c": n})
    assert Store(spark, str(tmp_path / "s")).committed() == {"a": 0, "b": 0, "c": 39} and store.read("index_gaps").count() == 2
    assert store.vacuum(keep=1, older_than_hours=0) == 3 and store.read("index_gaps").count() == 2  # two replaced, one lost
    with pytest.raises(LookupError):
        store.pinned(10**6).version()
    assert first.number == 0


def test_two_writers_of_one_version(spark, tmp_path):
    a, b = (Store(spark, str(tmp_path / "s")).create() for _ in range(2))
    known = a.manifest.load
    taken = []

    def behind(number=None):
        """The first load is overtaken by the other writer."""
        out = known(number)
        if not taken:
            taken.append(b.publish(committed={"b": 1}))
        return out

    a.manifest.load = behind
    assert a.publish(committed={"a": 1}).number == 1
    assert b.committed() == {"a": 1, "b": 1}


def test_two_hundred_batches_fold_into_few_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket=50).create()
    for n in range(200):
        events = spark.createDataFrame([(n, 1, "commit", n, block_hash(n), block_hash(n - 1), "active")], schemas.BLOCK_EVENTS).coalesce(1)
        store.append("w", n, block_events=events)
        store.fold(most=8, tables=["block_events"])
    parts = store.version().of("block_events")
    assert {p.bucket for p in parts} == {0, 1, 2, 3} and sum(p.files for p in parts) <= 4 * 8
    assert sorted(r.block_number for r in store.read("block_events").collect()) == list(range(200))
    assert len(os.listdir(tmp_path / "s" / "manifest")) >= 200 and "all" in json.load(open(tmp_path / "s" / "manifest" / "000000000016.json"))


def test_a_range_opens_its_buckets_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket=10).create()
    for n in range(50):  # each batch spreads over three buckets
        rows = [(10 * b + n % 10, block_hash(10 * b + n % 10), addr(n), None, "1", None, 0, None, None, "created", n) for b in (n % 5, 5 + n % 5, 10 + n % 5)]
        store.append("w", n, account_diffs=spark.createDataFrame(rows, store.read("account_diffs").schema))
    ranged = store.read("account_diffs", 70, 79)
    assert scan_metrics(ranged) == {"files": 10, "rows": 10}  # of 150 files
    assert ranged.count() == 10 and {r.block_number // 10 for r in ranged.collect()} == {7}
    assert scan_metrics(store.physical("account_diffs", 65, 84))["files"] == 30
    assert store.read("account_diffs", 400, 500).isEmpty() and store.read("account_diffs").count() == 150


def random_items(rng, n, top=9):
    items = []
    for _ in range(n):
        low = rng.randint(1, top)
        run = range(low, low + rng.randint(1, 3))
        old, new = ([plain(i, rng.randint(0, 2)) for i in run] for _ in range(2))
        items.append(rng.choice([("commit", [], new), ("reorg", old, new), ("revert", old, [])]))
    return items


def test_status_is_kept_and_not_folded_anew(spark, tmp_path):
    """A random log in batches, late and repeated ones among them: snapshot and later rows give what the whole log gives."""
    rng = random.Random(11)
    items, settings = random_items(rng, 12), Settings(str(tmp_path / "s"), heights_per_bucket=4)
    store, rows = ingest.store_of(spark, settings).create(), log(*items)
    batches = [[r for r in rows if lo < r["seq"] <= lo + 3] for lo in range(0, 12, 3)]
    batches[2] += [r for r in rows if r["seq"] in (2, 7)]  # late
    for n, part in enumerate(batches):
        ingest.apply_log(store, spark.createDataFrame(part, schemas.CHAIN_LOG), n)
        if n % 2:
            store.fold(most=1)  # a snapshot of each bucket
            assert all(len([p for p in store.version().of("block_status") if p.bucket == b]) == 1 for b in {p.bucket for p in store.version().of("block_status")})
        events = store.read("block_events")
        assert {tuple(r) for r in store.canonical_blocks().collect()} == {tuple(r) for r in fold.canonical_blocks(events).collect()}
        assert stored_cursors(store) == last_cursors(events.dropDuplicates(["seq", "phase", "block_hash"]))
        assert {(r.seq, r.base) for r in store.read("rollbacks").collect()} >= {(r.seq, r.base) for r in fold.rollback_bases(events).collect()}


def test_steps_do_not_read_history(spark, tmp_path, monkeypatch):
    """A batch in order opens the status of the buckets that it touches and no events, however long the log is."""
    settings = Settings(str(tmp_path / "s"), heights_per_bucket=10)
    store = ingest.store_of(spark, settings).create()
    read, opened = Store._rows, []
    monkeypatch.setattr(Store, "_rows", lambda self, table, parts: (opened.append((table, sorted({p.bucket for p in parts}))), read(self, table, parts))[1])
    for n in range(4):
        opened.clear()
        run = [plain(i) for i in range(10 * n + 1, 10 * n + 11)]
        items = [("commit", [], run)] + ([("reorg", run[-2:], [plain(i, 1) for i in range(10 * n + 9, 10 * n + 11)])] if n % 2 else [])
        ingest.apply_log(store, frame(spark, items, 1 + 2 * n), n)
        assert all(set(b) <= {n, n + 1} for t, b in opened if t == "block_status")
        assert not [t for t, _ in opened if t == "block_events"]
        work = ingest.stage_step(store, settings)
        assert work.end == 10 * n + 10 and all(set(b) <= {n, n + 1} for t, b in opened if t in ("block_status", "account_diffs", "storage_diffs"))
    monkeypatch.undo()
    assert store.canonical_blocks().filter("canonical_status = 'active'").count() == 40
    assert audit.check_all(store).filter("violations > 0").isEmpty()


def test_a_batch_takes_its_tables_from_one_dealing(spark, tmp_path, monkeypatch):
    """Rows keep their block's place in the log: no join brings it to them, and that of the roots is the only one."""
    store, put, plans = ingest.store_of(spark, Settings(str(tmp_path / "s"))).create(), Store.put, {}
    monkeypatch.setattr(Store, "put", lambda self, table, rows: (plans.update({table: rows._jdf.queryExecution().optimizedPlan().toString()}), put(self, table, rows))[1])
    ingest.apply_log(store, frame(spark, [("commit", [], [plain(1), plain(2)]), ("commit", [], [plain(2)])]), 0)
    assert [plans[t].count("Join") for t in ("account_diffs", "storage_diffs", "receipt_artifacts")] == [0, 0, 1]
    for table in ("account_diffs", "receipt_artifacts"):
        assert {(r.block_number, r.seq) for r in store.read(table).collect()} == {(1, 1), (2, 2)}


def test_unwinding_removes_rows_at_once(spark, tmp_path, monkeypatch):
    settings = Settings(str(tmp_path / "s"), heights_per_bucket=4)
    store = ingest.store_of(spark, settings).create()
    ingest.apply_log(store, frame(spark, [("commit", [], [plain(i) for i in range(1, 16)])]), 0)
    assert ingest.compact_all(store, settings) == 15
    ingest.apply_log(store, frame(spark, [("reorg", [plain(i) for i in range(7, 16)], [plain(i, 1) for i in range(7, 18)])], 2), 1)
    kept = {(p.bucket, p.set) for p in store.version().of("address_block_index") if p.bucket < 1}
    # A crash before publication leaves all as it was.
    publish = Store.publish
    monkeypatch.setattr(Store, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest.stage_step(store, settings)
    monkeypatch.setattr(Store, "publish", publish)
    assert store.read("address_block_index").count() == 15 and audit.compaction_top(store) == 15 and ingest.indexed_until(store) == 6
    ingest.stage_step(store, settings, requested=6)
    assert sorted(r.block_number for r in store.read("address_block_index").collect()) == list(range(1, 7)) and audit.compaction_top(store) == 6
    assert {(p.bucket, p.set) for p in store.version().of("address_block_index")} >= kept  # lower buckets are not touched
    assert ingest.compact_all(store, settings) == 17
    assert {(r.block_number, r.block_hash) for r in store.read("address_block_index").collect()} == {(i, block_hash(i, i > 6)) for i in range(1, 18)}
    assert audit.check_all(store).filter("violations > 0").isEmpty()


def test_the_index_is_the_way_in(spark, tmp_path):
    """The plan of a range prunes buckets by the index rows of its address; the result is that of the status join."""
    settings = Settings(str(tmp_path / "s"), heights_per_bucket=5)
    store = ingest.store_of(spark, settings).create()
    blocks = [plain(i) for i in range(1, 61)]
    for b in blocks[::20]:
        b["changes"] += plain(99)["changes"]  # an address that changes at heights 1, 21 and 41
    ingest.apply_log(store, frame(spark, [("commit", [], blocks)]), 0)
    ingest.apply_log(store, frame(spark, [("reorg", blocks[58:], [plain(59, 1), plain(60, 1)])], 2), 1)
    api = ChainApi(store, settings)
    plainly = api.account_diffs(addr(99), 1, 60).collect()
    assert [r.block_number for r in plainly] == [1, 21, 41]
    ingest.compact_all(store, settings, 50)
    both = api.account_diffs(addr(99), 1, 60)  # by the index up to 50, by status above
    assert both.collect() == plainly
    ranged = api.account_diffs(addr(99), 1, 50)
    assert "dynamicpruning" in ranged._jdf.queryExecution().toString().lower()
    assert ranged.collect() == plainly
    index, diffs = store.read("address_block_index", with_bucket=True).filter(F.col("address") == addr(99)), store.read("account_diffs", with_bucket=True)
    met = reads.by_index(diffs, F.broadcast(index), ["address"])
    assert scan_metrics(met)["files"] < scan_metrics(diffs)["files"] and met.count() == 3
    assert api.account_diffs(addr(59), 1, 60).isEmpty() and api.account_diffs(addr(69), 1, 60).count() == 1


def test_bloom_filters_skip_what_order_does_not(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), bucket=100_000).create()
    rows = spark.range(40_000).select((F.col("id") % 1000).alias("block_number"), F.concat(F.lit("0x"), F.sha2((F.col("id") % 1000).cast("string"), 256)).alias("block_hash"), F.floor(F.col("id") / 1000).cast("int").alias("tx_index"), F.concat(F.lit("0x"), F.sha2(F.col("id").cast("string"), 256)).alias("tx_hash"),
        F.floor(F.col("id") / 1000).cast("int").alias("receipt_index"), F.lit(b"r").alias("receipt_rlp"), F.lit("0x0").alias("receipt_root_anchor"), F.lit(b"").alias("log_bloom"), F.lit(True).alias("status"), F.lit(1).cast("bigint").alias("cumulative_gas_used"), F.lit(1).cast("bigint").alias("seq"))
    store.append("w", 0, receipt_artifacts=rows)
    absent = "0x7" + "f" * 63  # between the least and the greatest hash
    found = store.physical("receipt_artifacts", where=F.col("tx_hash") == absent)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "false")
    assert scan_metrics(found)["rows"] == 0
    there = store.read("receipt_artifacts").filter("block_number = 7 AND tx_index = 3").collect()[0]
    assert [(r.block_number, r.tx_index) for r in store.physical("receipt_artifacts", where=F.col("tx_hash") == there.tx_hash).collect()] == [(7, 3)]
    assert store.read("receipt_artifacts").filter(F.col("tx_hash") > absent).count() not in (0, 40_000)


def test_json_log_with_broken_lines(spark, tmp_path):
    settings = Settings(str(tmp_path / "s"), log_format="json", max_files_per_trigger=1)
    folder, state = tmp_path / "log", str(tmp_path / "state")
    folder.mkdir()

    def line(row):
        return json.dumps({k: v for k, v in row.items()})

    def run():
        ingest.ingest(spark, str(folder), settings, state, drain=True).awaitTermination()

    (folder / "1.json").write_text("\n".join(map(line, log(("commit", [], [plain(1), plain(2)])))))
    run()
    store = ingest.store_of(spark, settings)
    assert store.canonical_blocks().count() == 2
    rows = [r | {"seq": 2} for r in log(("commit", [], [plain(3)]))]
    (folder / "2.json").write_text(line(rows[0]) + '\n{"seq": 2, "kind": "comm\n')
    with pytest.raises(Exception, match="can't be read"):
        run()
    bad = store.read("quarantine").collect()
    assert [(r.reason, r.line) for r in bad] == [("the line can't be read", '{"seq": 2, "kind": "comm')] and bad[0].file.endswith("2.json")
    assert store.canonical_blocks().count() == 2  # nothing of the batch
    ingest.resolve(store)
    rows = [r | {"seq": 3} for r in log(("commit", [], [plain(4)]))]
    (folder / "3.json").write_text(line(rows[0]))
    run()
    assert sorted(r.block_number for r in store.canonical_blocks().collect()) == [1, 2, 3, 4]
    assert [r.block_number for r in ChainApi(store, settings).account_diffs(addr(3), 1, 9).collect()] == [3]
    assert [(r.seq, r.finished_height) for r in ChainApi(store, settings).finished_heights().collect()] == [(1, 2), (2, 3), (3, 4)]


def test_damage_is_named(spark, tmp_path):
    settings = Settings(str(tmp_path / "s"), heights_per_bucket=10)
    store = ingest.store_of(spark, settings).create()
    ingest.apply_log(store, frame(spark, [("commit", [], [plain(i) for i in range(1, 6)])]), 0)
    ingest.compact_all(store, settings)
    assert {r.check for r in audit.check_all(store).filter("violations > 0").collect()} == set()
    # Faulty rows are refused while they are written, and nothing of them is seen.
    with pytest.raises(Damaged, match="unchanged value"):
        store.append("x", 0, storage_diffs=spark.createDataFrame([(1, block_hash(1), addr(1), "1", "5", "5", 1)], store.read("storage_diffs").schema))
    assert store.read("storage_diffs").isEmpty() and "x" not in store.committed()

    def broken(**tables):
        return {r.check: r.violations for r in audit.check_all(_with(store, **tables)).filter("violations > 0").collect()}

    accounts, receipts = store.read("account_diffs"), store.read("receipt_artifacts")
    stray = accounts.limit(1).withColumn("block_hash", F.lit(block_hash(3, 7)))
    assert broken(account_diffs=stray) == {"orphan_account_diffs": 1}
    assert broken(receipt_artifacts=receipts.limit(1).withColumn("block_hash", F.lit(block_hash(3, 7))))["orphan_receipt_artifacts"] == 1
    assert broken(block_status=spark.createDataFrame([(3, block_hash(3, 7), 9, 1, "active", 9, 1, block_hash(2))], schemas.BLOCK_STATUS)) == {"two_active_blocks_of_a_height": 1, "status_differs_from_the_log": 1}
    index = store.read("address_block_index")
    assert broken(address_block_index=index.limit(1).withColumn("address", F.lit(addr(77)))) == {"address_index": 1}
    assert broken(address_block_index=index.limit(1).withColumn("block_number", F.lit(9))) == {"index_above_cursor": 1}
    assert broken(slot_block_index=spark.createDataFrame([(addr(1), "1", 1, block_hash(1))], schemas.SLOT_BLOCK_INDEX)) == {"slot_index": 1}
    wrong = receipts.filter("block_number = 2").withColumn("receipt_root_anchor", F.lit("0x00")).withColumn("seq", F.lit(9).cast("bigint"))
    assert broken(receipt_artifacts=wrong) == {"wrong_roots": 1}
    lost = spark.createDataFrame([(5, block_hash(5), 9, 0, "reorged", None, None, None)], schemas.BLOCK_STATUS)
    assert {"visible_rows_of_losing_blocks", "address_index", "status_differs_from_the_log"} <= set(broken(block_status=lost))


class _with(Store):
    """A store that has some more rows, as damage."""

    def __init__(self, store, **tables):
        super().__init__(store.spark, store.root, store.bucket)
        self.more = tables

    def pinned(self, number=None):
        return self

    def read(self, table, low=None, high=None, with_bucket=False):
        rows = super().read(table, low, high, with_bucket)
        more = self.more.get(table)
        if more is None:
            return rows
        for ok in ([] if low is None else [F.col("block_number") >= low]) + ([] if high is None else [F.col("block_number") <= high]):
            more = more.filter(ok)
        return rows.unionByName(more.withColumn("bucket", self.bucket_of(F.col("block_number"))) if with_bucket else more)


def test_retention(spark, tmp_path):
    settings = Settings(str(tmp_path / "s"), heights_per_bucket=5)
    store = ingest.store_of(spark, settings).create()
    old = [plain(i) for i in range(1, 21)]
    ingest.apply_log(store, frame(spark, [("commit", [], old), ("reorg", old[2:], [plain(i, 1) for i in range(3, 21)])]), 0)
    ingest.compact_all(store, settings)
    before = {t: {tuple(r) for r in store.active(t).collect()} for t in ("account_diffs", "receipt_artifacts")}
    above = {tuple(r) for r in store.physical("account_diffs", 10).collect()}
    reader = store.pinned()
    assert store.retain(12) == 9 and store.floor() == 9  # whole buckets end at 4, 9, 14
    assert store.retain(11) == 9
    assert {r.block_hash for r in store.physical("account_diffs", 0, 9).collect()} == {block_hash(i, i > 2) for i in range(1, 10)}
    assert {tuple(r) for r in store.physical("account_diffs", 10).collect()} == above
    assert {t: {tuple(r) for r in store.active(t).collect()} for t in before} == before
    assert reader.physical("account_diffs", 0, 9).count() == 16
    assert audit.check_all(store).filter("violations > 0").isEmpty()
    with pytest.raises(Quarantined, match="below the floor"):
        ingest.apply_log(store, frame(spark, [("revert", [plain(i, 1) for i in range(9, 21)], [])], 3), 1)
    assert store.canonical_blocks().filter("canonical_status = 'active'").count() == 20
    ingest.apply_log(store, frame(spark, [("revert", [plain(i, 1) for i in range(10, 21)], [])], 3), 1)
    assert store.canonical_blocks().filter("canonical_status = 'active'").count() == 9


def test_rollback_signals_by_keyed_state(spark, tmp_path):
    """The stream's rollbacks are those of the whole fold; a late notification is marked."""
    rng = random.Random(5)
    items = random_items(rng, 12)
    rows, folder, told = log(*items), str(tmp_path / "log"), []
    settings = Settings(str(tmp_path / "s"), max_files_per_trigger=1)
    late = items.index(next(i for i in items[1:] if i[1])) + 1

    def send(part):
        spark.createDataFrame(part, schemas.CHAIN_LOG).coalesce(1).write.mode("append").parquet(folder)
        signals.watch(spark, folder, settings, str(tmp_path / "state"), lambda df, batch: told.extend(df.collect()), drain=True).awaitTermination()

    parts = [[r for r in rows if lo < r["seq"] <= lo + 4] for lo in (0, 4, 8)]
    for part in parts:
        send(part + part[:2])  # repeated within the batch
    events = fold.block_events(spark.createDataFrame(rows, schemas.CHAIN_LOG))
    assert {(r.seq, r.base, r.n_live) for r in told} == {tuple(r) for r in fold.rollback_bases(events).collect()} and not any(r.late for r in told)
    told.clear()
    send([r for r in rows if r["seq"] == late])
    assert told and all(r.late and r.seq == late for r in told)


def test_old_stores_are_taken_over(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s")).create()
    blocks = spark.createDataFrame([(1, block_hash(1), block_hash(0), "active", None, None), (1, block_hash(1, 1), block_hash(0), "reorged", 1, None), (2, "odd", block_hash(1), "what", None, None)], "block_number bigint, block_hash string, parent_hash string, canonical_status string, finalized_hint int, derived_checkpoint_id bigint")
    store.take_over("block_status", blocks, 0)
    assert {(r.block_number, r.canonical_status) for r in store.canonical_blocks(1, 1).collect()} == {(1, "active"), (1, "reorged")}
    ingest.apply_log(store, frame(spark, [("reorg", [plain(1)], [plain(1, 1)])]), 0)
    assert {(r.block_hash, r.canonical_status) for r in store.canonical_blocks(1, 1).collect()} == {(block_hash(1), "reorged"), (block_hash(1, 1), "active")}
    assert [(r.seq, r.base) for r in store.read("rollbacks").collect()] == [(1, 0)]
    assert cursors.latest(store.read("stream_checkpoints")).collect()[0].streaming == 1
    assert tx(1)


def test_parts_and_steps_do_not_grow_with_the_chain():
    from forkwise.operators import compaction
    from forkwise.plans import stored

    for heights in (1, 75, 1600, 45_000, 2_700_000):
        settings = stored.settings_for("somewhere", heights)
        assert heights // settings.heights_per_bucket < stored.MOST_BUCKETS
        assert compaction.next_batch(0, heights, None, settings.max_blocks_per_batch).done
