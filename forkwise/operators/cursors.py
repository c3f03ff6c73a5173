"""Cursors and checkpoints.

A cursor's value is a running maximum or minimum since its last reset, so a log of any
length is folded in two steps: inside ranges of ``seq``, each a task of its own, and over
one summary row for each range. Nothing is ordered in one task but these summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from . import fold

#: Values of ``seq`` that share a range.
RANGE = 1 << 14


def running_since(rows: DataFrame, order: list[str], reset: str, value: str, take: str, out: str, first: int | None = None) -> DataFrame:
    """Adds ``out``: the running ``take`` (max or min) of ``value`` since the last row where ``reset`` holds.

    A reset row's own value counts. Before any reset the value is ``first`` throughout, or,
    if that is None, the running ``take`` from the start. ``rows`` has a column ``range``
    that follows the order.
    """
    agg = {"max": F.max, "min": F.min}[take]
    within = Window.partitionBy("range").orderBy(*order)
    rows = rows.withColumn("_part", F.sum(F.col(reset).cast("int")).over(within))
    inner = Window.partitionBy("range", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", agg(value).over(inner))

    ends = rows.groupBy("range").agg(F.max("_part").alias("_parts"), F.max_by(F.struct("_own"), F.struct(*order)).alias("_end"))
    ends = ends.withColumn("_since", F.sum((F.col("_parts") > 0).cast("int")).over(Window.orderBy("range")))
    before = Window.partitionBy("_since").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("_value", agg("_end._own").over(before))
    at = Window.orderBy("range")
    carried = ends.select("range", F.lag("_value").over(at).alias("_carried"), F.coalesce(F.lag("_since").over(at), F.lit(0)).alias("_resets"))

    pick = {"max": F.greatest, "min": F.least}[take]
    value_now = F.when(F.col("_part") > 0, F.col("_own")).otherwise(pick("_own", "_carried"))
    if first is not None:
        value_now = F.when((F.col("_part") == 0) & (F.col("_resets") == 0), F.lit(first)).otherwise(value_now)
    joined = rows.join(F.broadcast(carried), "range", "left")
    return joined.withColumn(out, value_now).drop("_part", "_own", "_carried", "_resets")


# Steps of a notification, in order.
ROLLBACK, COMMIT, FINISH = 0, 1, 2


def steps(events: DataFrame, span: int = RANGE) -> DataFrame:
    """seq, step and block_number of everything that moves a cursor.

    A rollback's block is its base; a finish, after each notification that commits, has the
    highest committed block.
    """
    return steps_of(events, fold.rollback_bases(events)).withColumn("range", F.floor(F.col("seq") / span))


def steps_of(events: DataFrame, bases: DataFrame) -> DataFrame:
    """``steps`` of events whose rollbacks' bases are known."""
    back = bases.select("seq", F.lit(ROLLBACK).alias("step"), F.col("base").alias("block_number"))
    new = events.filter("event = 'active'")
    commit = new.select("seq", F.lit(COMMIT).alias("step"), "block_number").distinct()
    finish = new.groupBy("seq").agg(F.max("block_number").alias("block_number")).select("seq", F.lit(FINISH).alias("step"), "block_number")
    return back.unionByName(commit).unionByName(finish)


def timeline(events: DataFrame, span: int = RANGE) -> DataFrame:
    """Cursors after every step: streaming, durable, canonical_tip and finished_height.

    Durable is lowered by rollbacks only. Finished is set when a notification that commits is
    over, and lowered to the base of a rollback.
    """
    order = ["seq", "step", "block_number"]
    rows = steps(events, span)
    rows = rows.withColumn("_back", F.col("step") == ROLLBACK).withColumn("_moved", F.when(F.col("step") != FINISH, F.col("block_number")))
    rows = running_since(rows, order, "_back", "_moved", "max", "streaming")
    rows = rows.withColumn("_end", F.col("step") == FINISH).withColumn("_kept", F.when(F.col("step") != COMMIT, F.col("block_number")))
    rows = running_since(rows, order, "_end", "_kept", "min", "finished_height", first=0)
    name = F.when(F.col("_back"), "rollback").when(F.col("step") == COMMIT, "commit").otherwise("finish")
    streaming = F.coalesce("streaming", F.lit(0)).cast("bigint")
    return rows.select("seq", "step", name.alias("operation"), "block_number", streaming.alias("streaming"), streaming.alias("durable"), streaming.alias("canonical_tip"), F.col("finished_height").cast("bigint").alias("finished_height"))


def _id(seq: Column, step: Column, block_number: Column) -> Column:
    """A checkpoint's place in the log. Heights from 2**31 on don't fit beside the step and are an error."""
    block_number = F.when(block_number >= 1 << 31, F.raise_error(F.lit("heights from 2**31 on have no checkpoint id"))).otherwise(block_number)
    return (seq * F.lit(1 << 32) + step * F.lit(1 << 31) + block_number).cast("bigint").alias("id")


def seq_of(point_id: Column) -> Column:
    return F.shiftright(point_id, 32)


def checkpoints(events: DataFrame, span: int = RANGE) -> DataFrame:
    """The stream's checkpoint after each commit and rollback; ids follow the order of the log."""
    rows = timeline(events, span).filter(F.col("step") != FINISH)
    zero = F.lit(0).cast("bigint")
    return rows.select(_id(F.col("seq"), F.col("step"), F.col("block_number")), "streaming", "durable", zero.alias("compacted_until"), zero.alias("proof_indexed_until"), "canonical_tip", "finished_height")


def latest(points: DataFrame) -> DataFrame:
    """The checkpoint with the largest id; that of the genesis if there is none."""
    last = points.agg(F.max_by(F.struct(*points.columns), "id").alias("c"))
    return last.select(*(F.coalesce(F.col(f"c.{c}"), F.lit(0)).cast("bigint").alias(c) for c in schemas.STAGE_CHECKPOINTS.fieldNames()))


def advanced(point: DataFrame, later: DataFrame) -> DataFrame:
    """The checkpoint after the ``later`` steps, which all follow those that ``point``, one row, stands for.

    As cursors are maxima and minima since their last reset, one pass over the steps gives
    the resets and a second what came after them.
    """
    at, one = F.struct("seq", "step", "block_number"), F.lit(0).alias("_one")
    resets = later.agg(F.max(F.when(F.col("step") == ROLLBACK, at)).alias("back"), F.max(F.when(F.col("step") == FINISH, at)).alias("end"), F.max(F.when(F.col("step") != FINISH, at)).alias("last"), one)
    since = later.withColumn("_one", F.lit(0)).join(F.broadcast(resets), "_one")
    moved = F.when((F.col("step") != FINISH) & (F.col("back").isNull() | (at >= F.col("back"))), F.col("block_number"))
    kept = F.when((F.col("step") != COMMIT) & (F.col("end").isNull() | (at >= F.col("end"))), F.col("block_number"))
    tops = since.groupBy("_one").agg(F.max(moved).alias("top"), F.min(kept).alias("low"))
    rows = latest(point).withColumn("_one", F.lit(0)).join(F.broadcast(resets), "_one").join(F.broadcast(tops), "_one", "left")
    streaming = F.when(F.col("back").isNull(), F.greatest("streaming", "top")).otherwise(F.col("top"))
    finished = F.when(F.col("end").isNull(), F.least("finished_height", "low")).otherwise(F.col("low"))
    new_id = F.coalesce(_id(F.col("last.seq"), F.col("last.step"), F.col("last.block_number")), F.col("id"))
    return rows.select(new_id.alias("id"), *(x.cast("bigint").alias(n) for n, x in (("streaming", streaming), ("durable", streaming), ("compacted_until", F.lit(0)), ("proof_indexed_until", F.lit(0)), ("canonical_tip", streaming), ("finished_height", finished))))


def on_restart(points: DataFrame) -> DataFrame:
    """Cursors as a restarted stream has them: what wasn't durable is streamed again."""
    return latest(points).withColumn("streaming", F.col("durable"))


def merged(stream: DataFrame, stage: DataFrame) -> DataFrame:
    """One row of all cursors: each side owns its own, and the index side never stands above durable."""
    s = latest(stream).select("id", "streaming", "durable", "canonical_tip", "finished_height", F.lit(0).alias("_one"))
    g = latest(stage).select("compacted_until", "proof_indexed_until", F.lit(0).alias("_one"))
    compacted = F.least("compacted_until", "durable")
    return s.join(F.broadcast(g), "_one").select("id", "streaming", "durable", compacted.alias("compacted_until"), F.least("proof_indexed_until", compacted).alias("proof_indexed_until"), "canonical_tip", "finished_height")


def consistent() -> Column:
    """proof <= compacted <= durable <= streaming."""
    return (F.col("proof_indexed_until") <= F.col("compacted_until")) & (F.col("compacted_until") <= F.col("durable")) & (F.col("durable") <= F.col("streaming"))

