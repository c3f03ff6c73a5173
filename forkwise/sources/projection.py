"""Chain tables projected from the driver's tables.

Each twenty orders make a height, as a block's gas limit bounds its transactions, so the chain
grows with the tables. Heights ending in 8 and 9 are contested: fork 0 loses them to fork 1, and
wins them back if more of their orders are finished than open. Orders give receipts, their line items storage changes, and events, dealt over all heights,
account changes. A value's predecessor is that on its own branch: rows of a losing fork see
the active chain below the fork point and their own fork above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X

ORDERS_IN_BLOCK = 20
#: Block hashes of chains up to this length are broadcast (about 70 MB with their overhead).
BROADCAST_HEIGHTS = 500_000


#: Heights whose rows one task orders, some 320,000 line items.
HEIGHTS_IN_TASK = 4000


def tasks_for(spark: SparkSession, heights: int) -> int | None:
    """Tasks that a long chain's rows are dealt to, so that none gets more of a longer one; None if those of the session are enough."""
    n = -(-heights // HEIGHTS_IN_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(rows: DataFrame, spark: SparkSession, heights: int, *keys: str) -> DataFrame:
    """``rows`` shuffled once by keys that aggregates and windows after it share."""
    n = tasks_for(spark, heights)
    return rows.repartition(n, *keys) if n else rows.repartition(*keys)


def heights_of(spark: SparkSession, sf_dir: str) -> int:
    """The chain's length; 1 if there are no orders."""
    last = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.max("o_orderkey").alias("k")).collect()[0]["k"]
    return 1 + (last or 0) // ORDERS_IN_BLOCK


def height_of(order_key: str) -> Column:
    return (1 + F.floor(F.col(order_key) / ORDERS_IN_BLOCK)).cast("bigint").alias("block_number")


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair and whether fork 0 wins it back, for each pair of contested heights that has orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(height_of("o_orderkey"), "o_orderstatus")
    rows = orders.filter(contested()).groupBy(_pair())
    return rows.agg((F.count_if(F.col("o_orderstatus") == "F") > F.count_if(F.col("o_orderstatus") == "O")).alias("back"))


def contested() -> Column:
    return F.col("block_number") % 10 >= 8


def _pair() -> Column:
    """The pair of contested heights that a height belongs to or follows."""
    return F.floor((F.col("block_number") - 1) / 10).alias("pair")


def _with_winner(rows: DataFrame, spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """``rows`` with ``back``; pairs are a tenth of the heights, and few of them are broadcast."""
    won = winners(spark, sf_dir)
    return rows.withColumn("pair", _pair()).join(F.broadcast(won) if heights < BROADCAST_HEIGHTS else won, "pair", "left").withColumn("back", F.coalesce("back", F.lit(False))).drop("pair")


def _status() -> Column:
    return F.when(contested() & ((F.col("fork") == 1) == F.col("back")), "reorged").otherwise("active").alias("canonical_status")


def blocks(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """block_number, fork, status and ``back`` of every block."""
    rows = _with_winner(spark.range(1, heights + 1).select(F.col("id").alias("block_number")), spark, sf_dir, heights)
    forks = F.when(contested(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("block_number", "back", F.explode(forks).alias("fork")).select("block_number", "fork", _status(), "back")


def block_hash() -> Column:
    return X.fork_hash(F.col("block_number"), F.col("fork")).alias("block_hash")


def parent_hash() -> Column:
    n = F.col("block_number") % 10
    fork = F.when(n == 9, F.col("fork")).when((n == 0) & ~F.col("back"), F.lit(1)).otherwise(F.lit(0))
    return X.fork_hash(F.col("block_number") - 1, fork).alias("parent_hash")


def canonical_blocks(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """Every 32nd height is hinted as final."""
    hint = F.when(F.col("block_number") % 32 == 0, F.lit(True))
    return blocks(spark, sf_dir, heights).select("block_number", block_hash(), parent_hash(), "canonical_status", hint.alias("finalized_hint"), F.lit(None).cast("bigint").alias("derived_checkpoint_id"))


def chain_log(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """Notification log without payloads: each ten heights are committed, then their contested ones reorganised, and those that fork 0 wins back once more."""
    rows = blocks(spark, sf_dir, heights)
    decade = F.floor(F.col("block_number") / 10)
    base = [block_hash(), parent_hash()]
    commit = rows.filter("fork = 0").select((3 * decade).alias("seq"), F.lit("commit").alias("kind"), F.lit("new").alias("side"), "block_number", *base)

    def reorg(pairs: DataFrame, place: int, old: int) -> DataFrame:
        return pairs.select((3 * decade + place).alias("seq"), F.lit("reorg").alias("kind"), F.when(F.col("fork") == old, "old").otherwise("new").alias("side"), "block_number", *base)

    return commit.unionByName(reorg(rows.filter(contested()), 1, 0)).unionByName(reorg(rows.filter(contested() & F.col("back")), 2, 1))


def _per_block(rows: DataFrame, first: Column, second: Column, spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """Rows (with block_number) on every block that has them; contested blocks have those of ``first`` on fork 0 and of ``second`` on fork 1."""
    forks = F.when(~contested(), F.array(F.lit(0))).otherwise(F.filter(F.array(F.when(first, F.lit(0)), F.when(second, F.lit(1))), lambda x: x.isNotNull()))
    return _with_winner(rows.withColumn("fork", F.explode(forks)), spark, sf_dir, heights).withColumn("canonical_status", _status()).drop("back")


def account_changes(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """block_number, block_hash, address and the account before and after, as structs."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cents = F.round(F.col("value") * 100).cast("bigint")
    rows = events.select((1 + F.col("event_id") % heights).cast("bigint").alias("block_number"), "user_id", "event_type", cents.alias("cents"))
    rows = _per_block(rows, F.col("event_type") != "signup", F.col("event_type") != "error", spark, sf_dir, heights)
    rows = _dealt(rows, spark, heights, "user_id").groupBy("block_number", "fork", "canonical_status", "user_id").agg(F.sum("cents").alias("delta"))

    active = F.when(F.col("canonical_status") == "active", F.col("delta"))
    lost = F.when(F.col("canonical_status") == "reorged", F.col("delta"))
    history = Window.partitionBy("user_id").orderBy("block_number")
    earlier, last = history.rangeBetween(Window.unboundedPreceding, -1), history.rangeBetween(-1, -1)
    # The second block of a losing fork sees its own first block instead of the winner's.
    second = (F.col("canonical_status") == "reorged") & (F.col("block_number") % 10 == 9)
    before = F.sum(active).over(earlier)
    before_last = F.sum(active).over(history.rangeBetween(Window.unboundedPreceding, -2))
    own = F.sum(lost).over(last)
    old = F.when(second, F.when(before_last.isNotNull() | own.isNotNull(), F.coalesce(before_last, F.lit(0)) + F.coalesce(own, F.lit(0)))).otherwise(before)
    rows = rows.withColumn("old_balance", old)

    def account(balance: Column) -> Column:
        return F.struct(balance.cast("string").alias("balance"), F.lit(0).cast("bigint").alias("nonce"), F.lit(X.ZERO_HASH).alias("code_hash"))

    return rows.select(
        "block_number", block_hash(), X.number_address(F.col("user_id")).alias("address"),
        F.when(F.col("old_balance").isNotNull(), account(F.col("old_balance"))).alias("old"),
        account(F.coalesce("old_balance", F.lit(0)) + F.col("delta")).alias("new"),
    )


def storage_changes(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """block_number, block_hash, address, slot and its value before and after, unchanged ones included."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = items.select(height_of("l_orderkey"), "l_suppkey", (F.col("l_partkey") % 16).alias("slot"), "l_quantity", "l_returnflag")
    rows = _per_block(rows, F.col("l_returnflag") != "R", F.col("l_returnflag") != "A", spark, sf_dir, heights)
    rows = _dealt(rows, spark, heights, "l_suppkey", "slot").groupBy("block_number", "fork", "canonical_status", "l_suppkey", "slot").agg(F.max("l_quantity").cast("bigint").alias("value"))

    active = F.when(F.col("canonical_status") == "active", F.col("value"))
    lost = F.when(F.col("canonical_status") == "reorged", F.col("value"))
    history = Window.partitionBy("l_suppkey", "slot").orderBy("block_number")
    second = (F.col("canonical_status") == "reorged") & (F.col("block_number") % 10 == 9)
    before = F.last(active, ignorenulls=True).over(history.rangeBetween(Window.unboundedPreceding, -1))
    before_last = F.last(active, ignorenulls=True).over(history.rangeBetween(Window.unboundedPreceding, -2))
    own = F.max(lost).over(history.rangeBetween(-1, -1))
    old = F.coalesce(F.when(second, F.coalesce(own, before_last)).otherwise(before), F.lit(0))
    rows = rows.withColumn("old", old)
    return rows.select(
        "block_number", block_hash(), X.number_address(F.col("l_suppkey")).alias("address"), F.col("slot").cast("string").alias("slot"),
        F.col("old").cast("string").alias("old_value"), F.col("value").cast("string").alias("new_value"),
    )


def receipts(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """block_number, block_hash, tx_index, tx_hash, status and cumulative_gas_used."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    gas = 21000 + F.round(F.col("o_totalprice") * 100).cast("bigint") % 100000
    rows = orders.select(height_of("o_orderkey"), "o_orderkey", "o_orderstatus", gas.alias("gas"))
    rows = _per_block(rows, F.col("o_orderstatus") != "P", F.col("o_orderstatus") != "F", spark, sf_dir, heights)
    rows = _dealt(rows, spark, heights, "block_number", "fork")
    order = Window.partitionBy("block_number", "fork").orderBy("o_orderkey")
    return rows.select(
        "block_number", block_hash(), (F.row_number().over(order) - 1).cast("int").alias("tx_index"), X.number_hash(F.col("o_orderkey")).alias("tx_hash"),
        (F.col("o_orderstatus") != "F").alias("status"), F.sum("gas").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_gas_used"),
    )



def payload_log(spark: SparkSession, sf_dir: str, heights: int) -> DataFrame:
    """``chain_log`` with the account changes and receipts of every block that comes with a notification; twenty orders and their share of events bound a block."""
    key = ["block_number", "block_hash"]
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RECEIPT}
    change = F.struct("address", "old", "new", F.lit(None).cast(T.ArrayType(schemas.SLOT_CHANGE)).alias("storage"))
    changes = account_changes(spark, sf_dir, heights).groupBy(*key).agg(F.collect_list(change).alias("changes"))
    told = F.struct("tx_index", F.struct(*(c if c in ("tx_hash", "status", "cumulative_gas_used") else nothing[c] for c in schemas.RECEIPT.fieldNames())).alias("r"))
    told = receipts(spark, sf_dir, heights).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(told)), lambda x: x["r"]).alias("receipts"))
    log = chain_log(spark, sf_dir, heights)
    new = log.filter("side = 'new'").join(changes, key, "left").join(told, key, "left")
    new = new.withColumn("changes", F.coalesce("changes", F.array().cast(T.ArrayType(schemas.CHANGE))))
    out = new.unionByName(log.filter("side = 'old'"), allowMissingColumns=True).withColumn("transactions", F.lit(None).cast(T.ArrayType(T.StringType())))
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CHAIN_LOG))
