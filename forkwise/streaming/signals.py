"""Rollbacks of the log as they are seen, by state that is kept for each block hash.

A stateful operator remembers the last event of every hash, and gives each event with the one
before it. From these, and nothing else, follow the rollbacks of a notification: no history is
read. A late event, from before what the state remembers, is marked as such and leaves the
state as it is; ``rollbacks`` of it need the fold of the whole log (``fold.rollback_bases``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Settings
from ..functions import scalars as X
from ..operators import fold
from . import ingest

SEEN = "block_hash string, seq long, phase int, block_number long, event string, was string, late boolean"
STATE = "seq long, phase int, event string"


def followed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Each event of one hash with the event before it."""
    seq, phase, last = state.get if state.exists else (-1, -1, None)
    rows = pd.concat(list(frames)).drop_duplicates(["seq", "phase"]).sort_values(["seq", "phase"])  # a hash's events of one batch
    out = []
    for r in rows.itertuples():
        late = (r.seq, r.phase) <= (seq, phase)
        out.append((key[0], r.seq, r.phase, r.block_number, r.event, None if late else last, late))
        if not late:
            seq, phase, last = int(r.seq), int(r.phase), r.event
    state.update((seq, phase, last))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in SEEN.split(", ")])


def seen_events(log: DataFrame) -> DataFrame:
    """Streamed events of a log with what each hash's last event was."""
    events = fold.block_events_of(log).select("block_hash", "seq", "phase", "block_number", "event")
    return events.groupBy("block_hash").applyInPandasWithState(followed, SEEN, STATE, "append", GroupStateTimeout.NoTimeout)


def rollbacks(seen: DataFrame) -> DataFrame:
    """seq, base, how many of the blocks taken back were canonical, and whether any event was late, of a batch of ``seen_events``."""
    rows = seen.filter("event = 'reorged'").groupBy("seq")
    out = rows.agg(X.before(F.min("block_number")).alias("base"), F.count_if(F.col("was") == "active").alias("n_live"), F.max("late").alias("late"))
    return out.filter("n_live > 0 OR late")


def watch(spark: SparkSession, folder: str, settings: Settings, checkpoint: str, told, drain: bool = False) -> StreamingQuery:
    """Call ``told`` with the rollbacks of each batch of the log as it comes in."""
    log = ingest.log_stream(spark, folder, settings)
    if ingest.BROKEN in log.columns:
        log = log.filter(F.col(ingest.BROKEN).isNull())
    writer = seen_events(log.select("seq", "kind", "side", "block_number", "block_hash", "parent_hash")).writeStream.outputMode("append")
    writer = writer.foreachBatch(lambda df, batch: told(rollbacks(df), batch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=settings.poll_interval)).start()
