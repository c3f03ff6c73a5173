"""The notification log as a stream, and the index side that follows it.

``ingest`` reads log files, Parquet or JSON, and each micro-batch writes payloads, status rows,
the stream's checkpoint and rollbacks, and publishes them in one version of the store. Status
is decided by (seq, phase), so neither the order of rows in a batch nor repeated delivery
matters. What was canonical before a batch is looked up in the status table, in the buckets of
heights that the batch touches; only a batch with notifications from before the last
checkpoint makes the history be folded anew.

A batch with blocks that have no outcome, segments with holes, lines that can't be read, or
reverts of final blocks fails, and leaves a quarantine row for each. Broken lines that have been
looked at are passed over once ``resolve`` says so.

``follow`` is the second query: it is woken at an interval, removes from its indexes what was
rolled back since, and compacts ranges of heights up to the durable cursor.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import Settings
from ..errors import Quarantined
from ..operators import compaction, cursors, extract, fold, proofs
from ..sources.store import Store

INGEST, STAGE, QUARANTINE, RESOLVED = "ingest", "stage", "quarantine", "resolved"
#: Columns that a log may have besides its own: a line that could not be read, and its file.
BROKEN, FILE = "_broken", "_file"


def check_order(log: DataFrame) -> DataFrame:
    """Block order within a side has no holes: a segment is a run of heights."""
    runs = log.groupBy("seq", "side").agg(F.min("block_number").alias("low"), F.max("block_number").alias("high"), F.count_distinct("block_number").alias("n"))
    return runs.filter("high - low + 1 <> n")


def _unfit(rows: DataFrame, reason: str, **known: Column) -> DataFrame:
    kinds = {f.name: f.dataType for f in schemas.QUARANTINE}
    return rows.select(*(F.lit(reason).alias(n) if n == "reason" else known.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()))


def unfit(log: DataFrame, floor: int = -1) -> DataFrame:
    """What can't be taken in: committed blocks without an outcome, the lowest height of segments with holes, and blocks taken back at or below the floor."""
    at = {c: F.col(c) for c in ("seq", "block_number", "block_hash")}
    missing = _unfit(log.filter("side = 'new' AND changes IS NULL"), "no outcome", **at)
    holes = _unfit(check_order(log), "the segment has holes", seq=F.col("seq"), block_number=F.col("low"))
    final = _unfit(log.filter((F.col("side") == "old") & (F.col("block_number") <= floor)), "below the floor", **at)
    return missing.unionByName(holes).unionByName(final)


def readable(store: Store, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a log that could be read, and quarantine rows of those that could not and have not been resolved."""
    if BROKEN not in log.columns:
        return log, store.spark.createDataFrame([], schemas.QUARANTINE)
    broken = log.filter(F.col(BROKEN).isNotNull()).join(store.read("resolutions").select(F.col("line").alias(BROKEN)), BROKEN, "left_anti")
    return log.filter(F.col(BROKEN).isNull()).drop(BROKEN, FILE), _unfit(broken, "the line can't be read", file=F.col(FILE), line=F.col(BROKEN))


def resolve(store: Store, lines: DataFrame | None = None) -> None:
    """Let broken lines be passed over: those given by ``line``, or all in quarantine."""
    lines = (store.read("quarantine") if lines is None else lines).filter("line IS NOT NULL").select("line").distinct()
    store.append(RESOLVED, store.committed().get(RESOLVED, -1) + 1, resolutions=lines)


def _known_before(store: Store, events: DataFrame, touched: set[int]) -> DataFrame:
    """The last event of each block that these events name, from the status table's buckets of their heights."""
    parts = [p for p in store.version().of("block_status") if p.bucket in touched]
    rows = store._rows("block_status", parts).join(events.select("block_hash").distinct(), "block_hash", "left_semi")
    last = fold.merged_status(rows)
    return last.select("seq", "phase", F.lit(None).cast("string").alias("kind"), "block_number", "block_hash", "parent_hash", "event")


def _new_checkpoint(store: Store, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stream's checkpoint after these events and the rollbacks among them, which are kept as several tables need them."""
    point = store.read("stream_checkpoints")
    last = cursors.latest(point).select(cursors.seq_of(F.col("id")).alias("seq")).collect()[0]["seq"]
    here = events.agg(F.min("seq").alias("first"), F.collect_set(store.bucket_of(F.col("block_number"))).alias("buckets")).collect()[0]
    if here["first"] is not None and here["first"] <= last:
        every = store.read("block_events").unionByName(events).dropDuplicates(["seq", "phase", "block_hash"])
        bases = fold.rollback_bases(every).persist()
        return cursors.advanced(point.filter("false"), cursors.steps_of(every, bases)), bases
    known = _known_before(store, events, set(here["buckets"]))
    bases = fold.rollback_bases(known.unionByName(events)).join(events.select("seq").distinct(), "seq", "left_semi").persist()
    return cursors.advanced(point, cursors.steps_of(events, bases)), bases


def apply_log(store: Store, log: DataFrame, batch: int) -> None:
    """Write what a piece of the log says as one batch; one that is in already is passed over.

    The log is dealt by block once, and all tables of the batch are taken from there.
    """
    if store.committed().get(INGEST, -1) >= batch:
        return
    log = log.repartition("block_hash").persist()
    kept = [log]
    try:
        rows, broken = readable(store, log)
        bad = unfit(rows, store.floor()).unionByName(broken)
        if not bad.isEmpty():
            store.append(QUARANTINE, store.committed().get(QUARANTINE, -1) + 1, quarantine=bad)
            raise Quarantined(", ".join(f"{r.reason}: {r.block_hash or r.block_number or r.file}" for r in bad.orderBy("block_number").limit(5).collect()))
        events = fold.block_events(rows).persist()
        kept.append(events)
        new = extract.committed(rows)
        changes = extract.changes_in(new, "seq")
        receipts = extract.receipt_artifacts(extract.receipts_in(new, "seq"), "seq")
        point, bases = _new_checkpoint(store, events)
        kept.append(bases)
        store.append(
            INGEST, batch,
            receipt_artifacts=proofs.anchored(receipts),
            account_diffs=extract.account_diffs(changes, "seq"),
            storage_diffs=extract.storage_diffs(extract.slots_of(changes, "seq"), "seq"),
            block_events=events,
            block_status=fold.merged_status(fold.status_rows(events)),
            finished_heights=events.filter("event = 'active'").groupBy("seq").agg(F.max("block_number").alias("finished_height")),
            stream_checkpoints=point,
            rollbacks=bases,
        )
        store.fold()
    finally:
        for rows in kept:
            rows.unpersist()


def log_stream(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", settings.max_files_per_trigger)
    if settings.log_format == "parquet":
        return reader.schema(schemas.CHAIN_LOG).parquet(folder)
    schema = T.StructType([*schemas.CHAIN_LOG, T.StructField(BROKEN, T.StringType())])
    rows = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN).json(folder)
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def store_of(spark: SparkSession, settings: Settings) -> Store:
    return Store(spark, settings.store, settings.heights_per_bucket)


def ingest(spark: SparkSession, folder: str, settings: Settings, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Start the log query; with ``drain`` it takes what is there and ends."""
    store_of(spark, settings).create()
    writer = log_stream(spark, folder, settings).writeStream.foreachBatch(lambda df, batch: apply_log(store_of(df.sparkSession, settings), df, batch))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=settings.poll_interval)).start()


def _pending_base(store: Store, seen: int) -> int | None:
    """The lowest base rolled back since the ``seq`` that the index side has seen."""
    return store.read("rollbacks").filter(F.col("seq") > seen).agg(F.min("base").alias("base")).collect()[0]["base"]


def indexed_until(store: Store) -> int:
    """Up to which height the indexes hold what is canonical: not above what was rolled back and awaits the index side."""
    point = cursors.latest(store.read("stage_checkpoints")).collect()[0]
    top, base = point["compacted_until"], _pending_base(store, point["id"] >> 32)
    return top if base is None else min(top, base)


def indexes(store: Store) -> tuple[DataFrame, DataFrame, int]:
    """Address index, slot index and the height up to which they stand. Rows of losing blocks have been removed below it."""
    store = store.pinned()
    top = indexed_until(store)
    return store.read("address_block_index", high=top), store.read("slot_block_index", high=top), top


INDEXES = ("address_block_index", "slot_block_index")


def stage_step(store: Store, settings: Settings, requested: int | None = None, batch: int | None = None) -> compaction.Batch:
    """One call of the index side.

    The lowest base rolled back since its last checkpoint lowers the cursor first, and rows
    above it are removed: buckets above the base are dropped, the one that the base lies in is
    rewritten. Heights above the cursor are then compacted again. What was removed, what was
    added and the cursor are published in one version.
    """
    now = store.pinned()
    batch = now.committed().get(STAGE, -1) + 1 if batch is None else batch
    before = cursors.latest(now.read("stage_checkpoints"))
    stood = before.collect()[0]
    seen = stood["id"] >> 32
    base = _pending_base(now, seen)
    point = before if base is None else compaction.unwind_cursors(before, base)
    start = stood["compacted_until"] if base is None else min(stood["compacted_until"], base)
    stream = cursors.latest(now.read("stream_checkpoints")).collect()[0]
    work = compaction.next_batch(start, stream["durable"], requested, settings.max_blocks_per_batch)
    writes, drop = [], []
    for table in INDEXES if base is not None else ():
        above = now.parts(table, low=start + 1)
        cut = [p for p in above if p.bucket == start // now.bucket]
        writes += [partial(store.rewritten, table, cut, lambda rows: compaction.unwound(rows, start))] if cut else []
        drop += above
    low, high = work.start + 1, max(work.start + 1, work.end)
    blocks = now.canonical_blocks(low, high)
    if work.end > work.start:
        a, s = compaction.compact(now.physical("account_diffs", low, high), now.physical("storage_diffs", low, high), blocks, work)
        gaps = compaction.gap_heights(blocks, work).withColumn("found_at", F.lit(batch))
        writes += [partial(store.put, "address_block_index", a), partial(store.put, "slot_block_index", s), partial(store.put, "index_gaps", gaps)]
    top = max(seen, stream["id"] >> 32)
    after = compaction.advance(point, work.end).withColumn("id", F.lit((top << 32) + batch)).withColumns({c: F.lit(stream[c]) for c in ("streaming", "durable", "canonical_tip", "finished_height")})
    store.publish(store.at_once(*writes, partial(store.put, "stage_checkpoints", after)), drop, committed={STAGE: batch})
    store.fold(tables=(*INDEXES, "stage_checkpoints", "index_gaps"))
    return work


def compact_all(store: Store, settings: Settings, requested: int | None = None) -> int:
    """Call the index side until it has caught up; returns the compacted height."""
    while True:
        work = stage_step(store, settings, requested)
        if work.done:
            return work.end


def follow(spark: SparkSession, settings: Settings, checkpoint: str) -> StreamingQuery:
    """Start the index query, woken at the poll interval."""
    store_of(spark, settings).create()

    def woken(df: DataFrame, batch: int) -> None:
        store = store_of(df.sparkSession, settings)
        if store.version().of("block_events"):
            compact_all(store, settings)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(woken).option("checkpointLocation", checkpoint).trigger(processingTime=settings.poll_interval).start()
