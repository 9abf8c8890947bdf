"""Operator 3: shards of near-equal bytes from sampled splitters.

Keys are drawn with a chance in proportion to their record's size, so quantiles of the sample cut the key
order into ranges of about equal bytes. The exact bytes of every range are then counted; a range
that is too full is sampled again and subdivided; consecutive ranges make up a shard. The key is
(hash of the text, doc_id, number among equal rows): equal texts lie side by side, and many copies of
one text, or of one whole row, can still be divided.
"""

from __future__ import annotations

import json
from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join

SHARDS = 16
RANGES = 64  # per shard
DRAWS = 16  # expected sample keys per range
ROUNDS = 4
KEY = ("h", "id", "k")
_KEY = "struct<h: bigint, id: bigint, k: bigint>"


def _draw(frame: DataFrame, rate: float, seed: int) -> list[tuple[int, ...]]:
    """Keys drawn with the chance size * rate, by a hash of the key: the same on every run."""
    chance = (F.xxhash64(F.lit(seed), *KEY).cast("double") / F.lit(2.0**64)) + 0.5
    rows = frame.where(chance < F.col("size") * rate).select(*KEY).collect()
    return sorted(tuple(r) for r in rows)


def _json(bounds: list[tuple[int, ...]]) -> str:
    return "[" + ",".join(json.dumps(dict(zip(KEY, b, strict=True))) for b in bounds) + "]"


def _ranged(frame: DataFrame, bounds: list[tuple[int, ...]]) -> DataFrame:
    """Adds the number of the range: how many bounds are at or below the key. Two short searches."""
    step = max(1, int(len(bounds) ** 0.5))
    key = F.struct(*KEY).cast(_KEY)
    if not bounds:
        return frame.withColumn("range", F.lit(0))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.from_json(F.lit(_json([p[0] for p in parts])), f"array<{_KEY}>")
    tables = F.from_json(F.lit("[" + ",".join(map(_json, parts)) + "]"), f"array<array<{_KEY}>>")
    head = F.size(F.filter(heads, lambda b: b <= key))
    last = F.filter(F.get(tables, F.col("_head") - 1), lambda b: b <= key)
    found = F.when(F.col("_head") == 0, 0).otherwise((F.col("_head") - 1) * step + F.size(last))
    return frame.withColumn("_head", head).withColumn("range", found.cast("int")).drop("_head")


def _sums(frame: DataFrame) -> list[tuple[int, int, int]]:
    rows = frame.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["range"], r.b, r.n) for r in rows)


def shard_by_bytes(frame: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """Adds shard (0 to shards - 1) and slot (gapless from 0 within it) to (h, id, k, size, ...).

    The driver holds sample keys and sums per range: about shards * ranges * DRAWS numbers, whatever
    the input. Rows with the same key stay together.
    """
    total = frame.agg(F.sum("size")).first()[0] or 0
    if not total:
        return frame.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    fair = total / (shards * ranges)
    sample = _draw(frame, DRAWS / fair, 1)
    step = max(1, len(sample) / (shards * ranges))
    bounds = sorted({sample[int(k * step)] for k in range(1, shards * ranges) if int(k * step) < len(sample)})
    for round_ in range(ROUNDS):
        cut = _ranged(frame, bounds)
        sums = _sums(cut)
        full = [r for r, b, n in sums if b > 2 * fair and n > 1]
        if not full or round_ == ROUNDS - 1:
            break
        more = _draw(cut.where(F.col("range").isin(full)), DRAWS / fair, 2 + round_)
        parts: dict[int, list] = {}
        for key in more:
            parts.setdefault(bisect_right(bounds, key), []).append(key)
        fresh = {p[i] for p in parts.values() for i in range(DRAWS // 2, len(p), DRAWS // 2)}
        if fresh <= set(bounds):
            break
        bounds = sorted(fresh | set(bounds))
    before, placed, filled = 0, [], [0] * shards
    for r, b, n in sums:
        shard = min(shards - 1, int((before + b / 2) * shards / total))
        placed.append((r, shard, filled[shard]))
        filled[shard] += n
        before += b
    spark = frame.sparkSession
    plan = spark.createDataFrame(placed, "range int, shard int, base long")
    order = Window.partitionBy("range").orderBy(*KEY)
    numbered = cut.withColumn("at", F.row_number().over(order))
    return (
        numbered.join(F.broadcast(plan), "range")  # a row per range
        .withColumn("slot", F.col("base") + F.col("at") - 1)
        .drop("range", "base", "at")
    )


def number_repeats(frame: DataFrame) -> DataFrame:
    """Adds k to a stored (h, id, part, ...): 0, 1, ... for rows with the same h and id.

    They are counted in each part; a row's number is its place in its part after the counts of the parts before. So
    no task has to hold them all, and which row gets which number depends on the parts but the numbers do not.
    """
    key = ["h", "id"]
    repeated = materialise(frame.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "repeated")
    if repeated.isEmpty():
        return frame.withColumn("k", F.lit(0).cast("long"))
    held = split_join(frame, repeated, key, "left_semi").groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(*key, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = split_join(frame, held, [*key, "part"], "left")
    place = F.row_number().over(Window.partitionBy(*key, "part").orderBy("size"))
    return (
        placed.where("before is null")
        .withColumn("k", F.lit(0).cast("long"))
        .unionByName(placed.where("before is not null").withColumn("k", F.col("before") + place - 1))
        .drop("before")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``.

    A null text has the size 1 and the checksum of no bytes. Repeated rows are rows of their own and may lie in
    several shards; a null id counts as the smallest. Extra
    columns are not read and may have any name. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"),
        F.spark_partition_id().alias("part"),
    )
    numbered = number_repeats(materialise(slim, "sizes")).drop("part")
    return shard_by_bytes(numbered, shards).drop(*KEY)
