"""Stored high-watermarks and the change rows beyond them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.functions.timestamps import comparable, ntz, with_ntz
from highwater.settings import WATERMARK_FLOOR

SOURCE_KEY = ["schema_name", "object_name"]


def named(column: str) -> Column:
    """An object's name; a change without one belongs to the object with the empty name."""
    return F.coalesce(F.col(column), F.lit(""))


def read_watermarks(
    sources: DataFrame, control: DataFrame, floor: datetime = WATERMARK_FLOOR
) -> DataFrame:
    """The watermark of every source, the floor where none is stored or the stored one is null.

    Both inputs are folded by key in one shuffle. Spark takes the size of the result for at most
    the sum of both (for a join it would take the product), which keeps a small one broadcastable.
    """
    stored = with_ntz(control, "last_modified_datetime").select(
        "schema_name",
        named("table_name").alias("object_name"),
        F.col("last_modified_datetime").alias("stored"),
    )
    wanted = sources.select("schema_name", named("object_name").alias("object_name"), F.lit(True).alias("wanted"))
    return (
        wanted.unionByName(stored, allowMissingColumns=True)
        .groupBy(*SOURCE_KEY)
        .agg(F.bool_or("wanted").alias("wanted"), F.max("stored").alias("stored"))
        .where("wanted")
        .select(*SOURCE_KEY, F.coalesce("stored", ntz(floor)).alias("watermark"))
    )


def stored_watermark(
    control: DataFrame, schema_name: str, table_name: str, floor: datetime = WATERMARK_FLOOR
) -> Column:
    """One source's watermark as a scalar subquery, to be compared with inside another plan.

    An aggregate without keys has exactly one row, so an absent key gives the floor.
    """
    return (
        with_ntz(control, "last_modified_datetime")
        .where((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
        .agg(F.coalesce(F.max("last_modified_datetime"), ntz(floor)).alias("watermark"))
        .scalar()
    )


def changed_since(
    change_feed: DataFrame,
    watermark: datetime | str | Column | DataFrame,
    floor: datetime = WATERMARK_FLOOR,
    *,
    listed: bool = False,
) -> DataFrame:
    """Change rows strictly newer than their watermark.

    With one value the comparison goes down into the file scan. With a frame (one row per
    source, as ``read_watermarks`` gives) each row meets its own source's watermark. Spark's size
    check decides how: a frame below the broadcast threshold leaves the feed unshuffled, beyond
    it both sides are shuffled and a hot source is split.

    A source without a row starts at the floor, so a frame alone cannot narrow the scan. With
    ``listed`` it is not read at all: then the least watermark of the frame reaches the scan, and of a feed that
    is partitioned by schema and object only the partitions of the frame's sources are opened
    (dynamic pruning, where the frame is broadcast). A change without a schema is then left out.
    """
    if not isinstance(watermark, DataFrame):
        updated, value = comparable(change_feed, "updated", watermark)
        return with_ntz(change_feed.where(updated > value), "updated")
    dated = with_ntz(change_feed.where(F.col("updated").isNotNull()), "updated")
    keys = ["schema_name", "_object"]
    mark = F.coalesce("watermark", ntz(floor)).alias("watermark")
    marks = watermark.select("schema_name", F.col("object_name").alias("_object"), mark)
    if listed:
        updated, least = comparable(change_feed, "updated", marks.agg(F.min("watermark").alias("least")).scalar())
        dated = with_ntz(change_feed.where(updated > least), "updated")
    return (
        split_join(dated.withColumn("_object", named("object_name")), marks, keys, "inner" if listed else "left")
        .where(F.col("updated") > F.coalesce("watermark", ntz(floor)))
        .select(*change_feed.columns)
    )
