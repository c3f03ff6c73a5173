"""Tables kept as Parquet files that a versioned manifest names.

What a batch writes is seen once its version is published, whole and once. Tables with
heights are cut into buckets of ``bucket`` heights each, and a read of a range of heights
opens no files of other buckets. Within files rows are ordered, so that row groups that can't
hold what is asked for are skipped; hashes, which no order helps, have Bloom filters.

Small batches leave small files. ``fold`` merges a bucket's files once it has more than
``most`` parts, by the rule that makes a later row replace an earlier one, so that the number
of files follows the buckets and not the batches. Replaced files stay until ``vacuum``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..errors import Damaged
from ..operators import cursors, fold, reads
from .manifest import Conflict, Folder, Manifest, Part, Version

TABLES: dict[str, T.StructType] = {
    "block_events": schemas.BLOCK_EVENTS,
    "block_status": schemas.BLOCK_STATUS,
    "account_diffs": T.StructType([*schemas.ACCOUNT_DIFFS, T.StructField("seq", T.LongType())]),
    "storage_diffs": T.StructType([*schemas.STORAGE_DIFFS, T.StructField("seq", T.LongType())]),
    "receipt_artifacts": T.StructType([*schemas.RECEIPT_ARTIFACTS, T.StructField("seq", T.LongType())]),
    "stage_checkpoints": schemas.STAGE_CHECKPOINTS,
    "stream_checkpoints": schemas.STAGE_CHECKPOINTS,
    "rollbacks": schemas.ROLLBACKS,
    "index_gaps": schemas.GAPS,
    "quarantine": schemas.QUARANTINE,
    "resolutions": schemas.RESOLUTIONS,
    "address_block_index": T.StructType([*schemas.ADDRESS_BLOCK_INDEX]),
    "slot_block_index": T.StructType([*schemas.SLOT_BLOCK_INDEX]),
    "finished_heights": schemas.FINISHED_HEIGHTS,
}
#: A payload's key. The height, which the hash decides, is among the columns so that filters on it reach the scan below ``latest``.
KEYS = {"account_diffs": ["block_number", "block_hash", "address"], "storage_diffs": ["block_number", "block_hash", "address", "slot"], "receipt_artifacts": ["block_number", "block_hash", "tx_index"]}
#: Tables in buckets of heights, with the order within a bucket.
ORDER = {
    "block_events": ["seq", "phase"], "block_status": ["block_number"],
    "account_diffs": ["address", "block_number"], "storage_diffs": ["address", "slot", "block_number"], "receipt_artifacts": ["block_number", "tx_index"],
    "address_block_index": ["address", "block_number"], "slot_block_index": ["address", "slot", "block_number"],
}
BLOOMS = {"block_status": ["block_hash"], "account_diffs": ["block_hash"], "storage_diffs": ["block_hash"], "receipt_artifacts": ["block_hash", "tx_hash"]}

_last = lambda keys: lambda rows: fold.latest(rows, keys, "seq")
#: How a table's rows are merged; the others' as they are.
MERGES: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{name: _last(keys) for name, keys in KEYS.items()},
    "block_events": lambda rows: rows.dropDuplicates(["seq", "phase", "block_hash"]), "block_status": fold.merged_status,
    "stage_checkpoints": cursors.latest, "stream_checkpoints": cursors.latest, "rollbacks": DataFrame.distinct, "finished_heights": DataFrame.distinct,
}
_DISORDER = "NOT (proof_indexed_until <= compacted_until AND compacted_until <= durable AND durable <= streaming)"
#: What no row may be; counted while a batch is written, which costs no pass of its own.
FAULTS: dict[str, dict[str, str]] = {
    "account_diffs": {"no key": "block_hash IS NULL OR address IS NULL", "no kind": "change_kind IS NULL", "an account on neither side": "old_balance IS NULL AND new_balance IS NULL"},
    "storage_diffs": {"no key": "block_hash IS NULL OR address IS NULL OR slot IS NULL", "unchanged value": "old_value <=> new_value"},
    "receipt_artifacts": {"no key": "block_hash IS NULL OR tx_index IS NULL", "no root": "receipt_root_anchor IS NULL", "no receipt": "receipt_rlp IS NULL"},
    "block_events": {"no key": "block_hash IS NULL OR seq IS NULL"},
    "stream_checkpoints": {"cursors out of order": _DISORDER},
    "stage_checkpoints": {"cursors out of order": _DISORDER},
}
MOST = 8
#: Tasks, and so files, that a bucket of a large batch is dealt to.
SPREAD = 8
#: Tables of a batch that are written at the same time, as most are short.
AT_ONCE = 8


def _observed(seen: Observation) -> dict[str, int]:
    """What was counted while rows were written; Spark observes nothing where it knows beforehand that there are none."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "assertion failed" not in str(e):
            raise
        return {"rows": 0}


class Store:
    """Chain tables under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, bucket: int = 1000, version: int | None = None):
        self.spark, self.root, self.bucket = spark, root.rstrip("/"), bucket
        self.manifest, self._pinned = Manifest(spark, self.root), version

    def create(self) -> "Store":
        """Make what is missing; may be repeated."""
        self.manifest.make()
        return self

    def version(self) -> Version:
        return self.manifest.load(self._pinned)

    def pinned(self, number: int | None = None) -> "Store":
        """The store as it is now, or was at a version, whatever is published afterwards."""
        out = Store(self.spark, self.root, self.bucket, self.version().number if number is None else number)
        out.manifest = self.manifest
        return out

    def committed(self) -> dict[str, int]:
        """Last committed batch of each writer. A writer numbers its batches upwards."""
        return self.version().committed

    def floor(self) -> int:
        return self.version().floor

    # --- writing ------------------------------------------------------------------

    def bucket_of(self, height: Column) -> Column:
        return F.floor(height / self.bucket).cast("bigint").alias("bucket")

    def put(self, table: str, rows: DataFrame) -> list[Part]:
        """Write rows, which nobody sees before their parts are published. Faulty ones are an error."""
        rows = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table]))
        name, seen = "s" + uuid.uuid4().hex, Observation()
        faults = FAULTS.get(table, {})
        rows = rows.observe(seen, F.count("*").alias("rows"), *(F.count_if(F.coalesce(F.expr(c), F.lit(True))).alias(n) for n, c in faults.items()))
        path = f"{self.root}/{table}/set={name}"
        if table in ORDER:
            by = ["bucket", *ORDER[table]]
            salt = F.pmod(F.xxhash64(*ORDER[table]), F.lit(SPREAD))
            rows = rows.withColumn("bucket", self.bucket_of(F.col("block_number"))).repartition("bucket", salt).sortWithinPartitions(*by)
            options = {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOMS.get(table, ())}
            rows.write.options(**options).partitionBy("bucket").parquet(path)
        else:
            rows.coalesce(1).write.parquet(path)
        metrics = _observed(seen)
        if bad := {n: metrics[n] for n in faults if metrics.get(n)}:
            Folder(self.spark, path).delete()
            raise Damaged(f"{table}: " + ", ".join(f"{k} rows with {n}" for n, k in bad.items()))
        if not metrics.get("rows", 1):
            return []
        found = Folder(self.spark, path).files_below()
        return [Part(table, name, int(folder.rpartition("=")[2]) if folder else None, n, len(found)) for folder, n in sorted(found.items())]

    def publish(self, add: Iterable[Part] = (), drop: Iterable[Part] = (), committed: dict[str, int] | None = None, floor: int | None = None) -> Version | None:
        return self.manifest.publish(add, drop, committed, floor)

    def append(self, writer: str, batch: int, **tables: DataFrame) -> Version | None:
        """Rows of several tables as one batch; one that is in already is passed over."""
        if self.committed().get(writer, -1) >= batch:
            return None
        return self.publish(self.at_once(*(partial(self.put, table, rows) for table, rows in tables.items())), committed={writer: batch})

    def at_once(self, *writes: Callable[[], list[Part]]) -> list[Part]:
        """The parts that these write, side by side."""
        run = inheritable_thread_target(self.spark)(lambda write: write())
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return [p for own in pool.map(run, writes) for p in own]

    def take_over(self, table: str, rows: DataFrame, batch: int) -> None:
        """Write rows of an old store, decoded leniently, as a batch that any later payload of the same keys replaces."""
        decoded = reads.DECODERS[table](rows)
        if table == "block_status":
            decoded = fold.status_of_blocks(decoded)
        self.append("old-" + table, batch, **{table: decoded if "seq" in decoded.columns else decoded.withColumn("seq", F.lit(0))})

    # --- reading ------------------------------------------------------------------

    def _rows(self, table: str, parts: list[Part]) -> DataFrame:
        """Rows of these parts, with their bucket."""
        schema = T.StructType([*TABLES[table], T.StructField("bucket", T.LongType())])
        if not parts:
            return self.spark.createDataFrame([], schema)
        sets: dict[str, list[Part]] = {}
        for p in parts:
            sets.setdefault(p.set, []).append(p)
        # A set of which all buckets are read is one path.
        paths = [path for own in sets.values() for path in ([f"{self.root}/{table}/set={own[0].set}"] if len(own) == own[0].of else [p.path(self.root) for p in own])]
        found = self.spark.read.schema(T.StructType([*TABLES[table], T.StructField("set", T.StringType()), T.StructField("bucket", T.LongType())])) if table in ORDER else self.spark.read.schema(TABLES[table])
        rows = found.option("basePath", f"{self.root}/{table}").parquet(*paths) if table in ORDER else found.parquet(*paths).withColumn("bucket", F.lit(None).cast("bigint"))
        return rows.select(*schema.names)

    def parts(self, table: str, low: int | None = None, high: int | None = None) -> list[Part]:
        first, last = (None if h is None else h // self.bucket for h in (low, high))
        return [p for p in self.version().of(table) if p.bucket is None or (first is None or p.bucket >= first) and (last is None or p.bucket <= last)]

    def read(self, table: str, low: int | None = None, high: int | None = None, with_bucket: bool = False) -> DataFrame:
        """Rows of a table, of heights from ``low`` to ``high`` only if given: files of other buckets are not opened."""
        rows = self._rows(table, self.parts(table, low, high))
        if low is not None:
            rows = rows.filter(F.col("block_number") >= low)
        if high is not None:
            rows = rows.filter(F.col("block_number") <= high)
        return rows if with_bucket else rows.drop("bucket")

    def canonical_blocks(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """The block table: each hash's status, merged from the snapshot and what batches have added to it."""
        return fold.blocks_of(fold.merged_status(self.read("block_status", low, high)))

    def physical(self, table: str, low: int | None = None, high: int | None = None, where: Column | None = None, with_bucket: bool = False) -> DataFrame:
        """All history, the last payload of each key. ``where`` may name columns that a block's hash and the key decide; it reaches the scan."""
        rows = self.read(table, low, high, with_bucket)
        if where is not None:
            rows = rows.filter(where)
        return fold.latest(rows, [*KEYS[table], *(["bucket"] if with_bucket else [])], "seq").drop("seq")

    def active(self, table: str, low: int | None = None, high: int | None = None) -> DataFrame:
        return fold.active(self.physical(table, low, high), self.canonical_blocks(low, high))

    # --- upkeep -------------------------------------------------------------------

    def rewritten(self, table: str, parts: list[Part], change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[Part]:
        """The rows of these parts merged and changed, as new parts that are not yet published."""
        rows = self._rows(table, parts).drop("bucket")
        return self.put(table, change(MERGES[table](rows) if table in MERGES else rows))

    def fold(self, most: int = MOST, tables: Iterable[str] = tuple(TABLES)) -> int:
        """Merge the parts of buckets that have more than ``most``; returns how many were replaced."""
        replaced, now = 0, self.version()
        for table in tables:
            by: dict[int | None, list[Part]] = {}
            for p in now.of(table):
                by.setdefault(p.bucket, []).append(p)
            many = [p for own in by.values() if len(own) > most for p in own]
            if many:
                try:
                    self.publish(self.rewritten(table, many), many)
                    replaced += len(many)
                except Conflict:
                    pass  # whoever was first has merged or removed them
        return replaced

    def vacuum(self, keep: int = 10, older_than_hours: float = 24.0) -> int:
        """Delete files that the last ``keep`` versions don't name and that are too old to be on their way; returns how many folders went."""
        numbers = self.manifest.numbers()
        named: set[str] = set()
        for n in numbers[-keep:]:
            named |= {p.path("") for p in self.manifest.load(n).parts}
        gone, before = 0, time.time() * 1000 - older_than_hours * 3_600_000
        for table in TABLES:
            for folder in Folder(self.spark, f"{self.root}/{table}").files_below():
                at = Folder(self.spark, f"{self.root}/{table}/{folder}")
                if f"/{table}/{folder}" not in named and at.changed_ms() <= before:
                    at.delete()
                    gone += 1
        return gone

    def retain(self, floor: int) -> int:
        """Drop losing blocks' rows up to height ``floor``, which is final, bucket by bucket; returns the floor.

        Only whole buckets are rewritten, so the floor is that of the last bucket that ends at or
        below the height. Rows above stay as they are, and a revert of what lies below is refused.
        """
        last = (floor + 1) // self.bucket - 1
        old, end = self.floor(), (last + 1) * self.bucket - 1
        if end <= old:
            return old
        low = old + 1
        live = self.canonical_blocks(low, end).filter("canonical_status = 'active'").select("block_hash")
        add, drop = [], []
        for table in ("account_diffs", "storage_diffs", "receipt_artifacts", "block_status"):
            parts = self.parts(table, low, end)
            if parts:
                add += self.rewritten(table, parts, lambda rows: rows.join(live, "block_hash", "left_semi"))
                drop += parts
        self.publish(add, drop, floor=end)
        return end
