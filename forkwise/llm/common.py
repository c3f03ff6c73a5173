"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset, as in local
    tests, a temporary folder takes its place.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at durable files."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` has made, once what was made of them is written too."""
    for df in tables:
        session = df.sparkSession
        fs = session.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if folder.rpartition("/")[0].endswith(shared_dir(session).rpartition(":")[2].lstrip("/")):
                fs(folder).getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(fs(folder), True)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes a query's shuffle files as soon as its result is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column, null as empty."""
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")


def slices(batches, rows: int = 512):
    """Batches cut into parts of at most ``rows`` rows, so that what a task makes of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; looks at no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a, b)`` as ``(node, component)``.

    ``component`` is the smallest node reachable. Labels shrink by taking the least label
    among neighbours and then the label's own label (pointer jumping), so the number of
    rounds follows the logarithm of a component's diameter. Each round's labels are a
    written table; nothing is collected but one count.
    """
    spark = links.sparkSession
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, "edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    labels = written(labels, "labels")
    for _ in range(max_rounds):
        near = (
            edges.join(labels.withColumnRenamed("node", "b").withColumnRenamed("component", "c"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("c").alias("c"))
        )
        lower = labels.join(near, "node").select("node", F.least("component", "c").alias("component"), F.col("component").alias("was"))
        own = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        step = lower.join(own, "component", "left").select("node", F.least("component", F.coalesce("up", "component")).alias("component"), "was")
        step = written(step, "labels")
        discard(labels)
        labels = step.select("node", "component")
        if step.filter(F.col("component") != F.col("was")).isEmpty():
            discard(edges)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
