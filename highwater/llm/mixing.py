"""Operator 9: mixing sources to target weights by capped water-filling.

Sources share a volume by weight. No source goes beyond a number of epochs of its own size; what it
cannot take is shared again by weight among the others until none is above its cap. With the sources in
the order of cap / weight, the capped ones are a prefix, so running sums give the level without a loop.

Every source then takes whole copies of all its documents and one more copy of some: those that come first
by a seeded hash until their sizes add up to the rest. Sizes are first summed in bins of that hash, so
only the documents of the bin in which the rest runs out are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.llm.common import words_of

WEIGHTS = (3, 1, 2)  # in the code-point order of sources, repeating, a null source last
VOLUME = 1.5
EPOCHS = 2
SEED = "mix-1"
_BIN_DIGITS = 3  # hex digits: 4096 bins


def water_fill(sources: DataFrame, volume: float = VOLUME, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target`` to sources (source, source_size, weight). One row per source."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), "source"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = (F.col("volume") - F.col("capped")) / F.col("open")
    filled = (
        sources.withColumn("cap", F.col("source_size") * epochs)
        .withColumn("volume", F.sum("source_size").over(everything) * F.lit(float(volume)))
        .withColumn("capped", F.sum("cap").over(order) - F.col("cap"))
        .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(order) + F.col("weight"))
        .withColumn("fits", level <= F.col("cap") / F.col("weight"))
    )
    start = F.min(F.when(F.col("fits"), F.struct("capped", "open"))).over(everything)
    shared = F.col("weight") * (F.col("volume") - F.col("start.capped")) / F.col("start.open")
    return filled.withColumn("start", start).select(
        "source",
        "source_size",
        F.when(F.col("start").isNull() | (F.col("capped") < F.col("start.capped")), F.col("cap").cast("double"))
        .otherwise(F.least(shared, F.col("cap").cast("double")))
        .alias("target"),
    )


def _with_weights(sizes: DataFrame) -> DataFrame:
    at = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    return sizes.withColumn("weight", F.get(cycle, at % len(WEIGHTS)))


def mix(docs: DataFrame, volume: float = VOLUME, epochs: int = EPOCHS) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``mixed``: size, source_size, target, copies, taken.

    The size of a document is its number of words (null: 0). ``copies`` says how often the mix takes the
    document and ``taken`` is size * copies. A null source is a source. The result is the same on every
    run; rows with the same doc_id and text are interchangeable. Columns of any other name may be
    present; an empty table gives no rows, and a source without words takes nothing.
    """
    own = F.struct(
        F.col("source").alias("source"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")).cast("binary")).alias("key"),
    )
    slim = docs.select(own.alias("m")).select("m.*")
    bin_ = F.substring("key", 1, _BIN_DIGITS)
    binned = materialise(slim.groupBy("source", bin_.alias("bin")).agg(F.sum("size").alias("size")), "bins")
    targets = water_fill(
        _with_weights(binned.groupBy("source").agg(F.sum("size").alias("source_size"))), volume, epochs
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    ends = binned.withColumn("to", running).withColumn("from", running - F.col("size"))
    same = F.col("source").eqNullSafe(F.col("s"))
    cut = (
        ends.join(targets.withColumnRenamed("source", "s"), same)
        .groupBy("s")
        .agg(
            *[F.first(c).alias(c) for c in ("source_size", "target", "whole", "rest")],
            F.max(F.when(F.col("to") < F.col("rest"), F.col("bin"))).alias("full"),  # all up to here
            F.max(F.when(F.col("from") < F.col("rest"), F.col("bin"))).alias("last"),  # none beyond
            F.max(F.when(F.col("to") < F.col("rest"), F.col("to"))).alias("base"),
        )
    )
    cut = materialise(cut, "targets").select(F.struct("*").alias("cut"))  # a row per source
    placed = docs.select(F.struct("*").alias("row"), own.alias("own")).join(
        cut, F.col("own.source").eqNullSafe(F.col("cut.s")), "left"
    )
    in_bin = F.substring("own.key", 1, _BIN_DIGITS)
    full, last = F.coalesce("cut.full", F.lit("")), F.coalesce("cut.last", F.lit(""))
    order = Window.partitionBy("own.source").orderBy("own.key", "row.doc_id", "own.size", F.xxhash64("row.text"))
    before = F.sum("own.size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = before - F.col("own.size") + F.coalesce("cut.base", F.lit(0))
    some = (in_bin > full) & (in_bin <= last)
    within = placed.where(some).withColumn("more", before + F.col("own.size") / 2 < F.col("cut.rest"))
    outside = placed.where(~some).withColumn("more", in_bin <= full)
    copies = F.col("cut.whole") + F.col("more").cast("long")
    mixed = F.struct(
        F.col("own.size").alias("size"),
        F.col("cut.source_size").alias("source_size"),
        F.col("cut.target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("own.size")).alias("taken"),
    )
    return within.unionByName(outside).select("row", mixed.alias("mixed"))


def mixed_copies(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs).where("mixed.copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "mixed.copies"))).select("row.*")


ORACLE_MIXED = r"""
SELECT d.*, s.source_size, s.target, s.whole,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size + d.size / 2.0
    < s.target - s.whole * s.source_size AS more
FROM (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR))) AS key
  FROM {docs}
) d JOIN (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM (
    SELECT source, source_size,
      CASE WHEN fst IS NULL OR capped < fst.capped THEN CAST(cap AS DOUBLE)
        ELSE least(weight * (volume - fst.capped) / fst.open, CAST(cap AS DOUBLE)) END AS target
    FROM (
      SELECT *, min(CASE WHEN (volume - capped) / open <= cap / weight
        THEN {{'capped': capped, 'open': open}} END) OVER () AS fst
      FROM (
        SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS volume,
          CAST(sum(cap) OVER o - cap AS BIGINT) AS capped,
          CAST(sum(weight) OVER () - sum(weight) OVER o + weight AS BIGINT) AS open
        FROM (
          SELECT source, source_size, 2 * source_size AS cap,
            [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
          FROM (
            SELECT source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS BIGINT)
              AS source_size
            FROM {docs} GROUP BY source))
        WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))
) s ON s.source IS NOT DISTINCT FROM d.source
"""
