"""What the operators of this folder share: tables, partition counts, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join

#: A run of other bytes than space and 0x09-0x0D is a word; these separate words (Java syntax).
SPACES = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (one path on all hosts).

    Their large arrays go back to the system when freed, rather than staying with the worker.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))
        env.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
        env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def release() -> None:
    """Hand what large arrays have left free in this process back to the system, where the C library can.

    For the driver, which otherwise keeps the peak of one step through all later ones.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query has ended, and not at some garbage collection.

    For steps that write or collect what they shuffled: nothing reads these files again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def words_of(text) -> F.Column:
    """The words of a text as an array, an empty one for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+")
    return F.filter(parts, lambda w: w != "")


def let(value, body) -> F.Column:
    """``body`` of a value that is computed once, also where a lambda uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates two steps: link every larger neighbour, then every smaller one, to the smallest node
    of the neighbourhood. Neighbourhoods are never collected; a hot node is an ordinary join key.
    Each round is written to the shared folder and read from there.
    """
    pairs = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v")
        .distinct(),
        "edges",
    )
    while _linked_on(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            split_join(both.where("v > u"), least, ["u"], "inner")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = split_join(large, least, ["u"], "inner")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = materialise(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges"
        )
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()


def _linked_on(pairs: DataFrame) -> bool:
    """Whether a smaller node of some pair is the larger one of another, or a node has two pairs."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"))
    ends = ends.unionByName(pairs.select("v").distinct().select(F.col("v").alias("node"), F.lit(1).alias("up")))
    return bool(ends.groupBy("node").agg(F.sum("up").alias("n")).where("n > 1").limit(1).count())
