"""The chain of the driver's tables taken through a store: log batches, index steps and reorganisations between them.

The store lies in the folder that driver and executors share and is made once a session for
each set of tables. Its buckets and the steps of its index side grow with the chain, so that
files, parts and jobs stay as many and each job, which Spark deals out, gets longer.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import Settings
from ..operators import cursors, reads
from ..sources import audit
from ..sources import projection as P
from ..sources.manifest import Folder
from ..sources.store import Store
from ..streaming import ingest

BATCHES, HEIGHTS_PER_BUCKET = 3, 50
#: Buckets that a chain is cut into at most.
MOST_BUCKETS = 32
_MADE: dict[tuple[str, str], Store] = {}


def _shared(spark: SparkSession) -> str:
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def settings_for(root: str, heights: int) -> Settings:
    """Those of a store that a chain of so many heights is taken into at once."""
    return Settings(root, heights_per_bucket=max(HEIGHTS_PER_BUCKET, -(-(heights + 1) // MOST_BUCKETS)), max_blocks_per_batch=max(Settings.max_blocks_per_batch, heights))


def store_of(spark: SparkSession, sf_dir: str) -> Store:
    """The whole log in batches that end between a commit and the reorganisation of its blocks, each followed by the index side."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        root, heights = f"{_shared(spark)}/store-{uuid.uuid4().hex}", P.heights_of(spark, sf_dir)
        settings = settings_for(root, heights)
        store = ingest.store_of(spark, settings).create()
        # Derived once; each batch reads its part, which is a folder of its own.
        ends = [3 * (heights // 10 * n // BATCHES) for n in range(1, BATCHES)]
        batch = sum(((F.col("seq") > end).cast("int") for end in ends), F.lit(0)).alias("batch")
        P.payload_log(spark, sf_dir, heights).select("*", batch).write.partitionBy("batch").parquet(f"{root}/log")
        log = spark.read.schema(T.StructType([*schemas.CHAIN_LOG, T.StructField("batch", T.IntegerType())])).parquet(f"{root}/log")
        for n in range(BATCHES):
            ingest.apply_log(store, log.filter(F.col("batch") == n).drop("batch"), n)
            ingest.compact_all(store, settings)
        Folder(spark, f"{root}/log").delete()
        _MADE[key] = store
    return _MADE[key]


def stored_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block's status as the store has kept it."""
    return store_of(spark, sf_dir).canonical_blocks().select("block_number", "block_hash", "parent_hash", "canonical_status")


def stored_account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All canonical account changes, which the index alone says."""
    store = store_of(spark, sf_dir).pinned()
    index = store.read("address_block_index", high=ingest.indexed_until(store), with_bucket=True)
    return reads.by_index(store.physical("account_diffs", with_bucket=True), index, ["address"]).drop("bucket")


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address index's rows as they lie in its files: what was rolled back after it had been indexed is gone."""
    return store_of(spark, sf_dir).read("address_block_index")


def stored_losing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account changes and receipts of losing blocks, which stay in the history."""
    store = store_of(spark, sf_dir)
    lost = store.canonical_blocks().filter("canonical_status = 'reorged'").select("block_hash")
    rows = [store.physical(t).join(lost, "block_hash", "left_semi").groupBy("block_number", "block_hash").agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(t)) for t in ("account_diffs", "receipt_artifacts")]
    return rows[0].unionByName(rows[1])


def stored_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = store_of(spark, sf_dir)
    return cursors.merged(store.read("stream_checkpoints"), store.read("stage_checkpoints")).drop("id")


def stored_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.check_all(store_of(spark, sf_dir))


QUERIES = {f.__name__: f for f in (stored_status, stored_account_history, stored_index, stored_losing_rows, stored_cursors, stored_invariants)}
