"""Entities with changed objects that are ready to be loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.functions.timestamps import with_ntz
from highwater.operators.watermark import changed_since
from highwater.settings import WATERMARK_FLOOR

ENTITY_KEY = ["entity_id", "schema_name"]
KEY_HASH = "key_hash"
HASHED_KEY = [KEY_HASH, *ENTITY_KEY]


def _key_hash() -> Column:
    """A number that stands for the key, put before it in a grouping.

    Sets are collected, and large sides joined, by sorting. Ids mostly begin alike, so with the
    hash in front nearly every comparison is settled by one number and not by two texts.
    """
    return F.xxhash64(*ENTITY_KEY).alias(KEY_HASH)


def changed_objects(change_feed: DataFrame) -> DataFrame:
    """The set of changed objects per entity and schema.

    Every task folds its rows into one set per key before the shuffle, so an entity that owns
    much of the feed sends one set per task and not its rows.
    """
    return change_feed.groupBy(_key_hash(), *ENTITY_KEY).agg(
        F.collect_set(F.coalesce("object_name", F.lit(""))).alias("objects")
    )


def ready_rows(readiness: DataFrame, source: str) -> DataFrame:
    """Readiness rows that are ready, available and of the wanted source; null is not ready."""
    return with_ntz(
        readiness.where(
            F.col("ready_for_processing") & F.col("data_available") & (F.col("source") == source)
        ).select(
            *ENTITY_KEY, F.coalesce("migrated", F.lit(False)).alias("migrated"), "updated"
        ),
        "updated",
    )


def candidates(
    change_feed: DataFrame,
    readiness: DataFrame,
    watermark: datetime | str | Column | DataFrame | None,
    source: str,
    *,
    grain: str = "entity",
    floor: datetime = WATERMARK_FLOOR,
) -> DataFrame:
    """Changed and ready entities with their changed objects.

    ``grain="entity"`` gives one row per lower-case entity and schema: object lists united,
    ``migrated`` if any row says so, newest ``updated``. ``grain="raw"`` keeps a row for each
    case form, migrated state and readiness time, without exact duplicates. The two sides are
    matched on the entity id as written in both grains. ``watermark`` is None where the feed was
    filtered before.
    """
    changed = change_feed if watermark is None else changed_since(change_feed, watermark, floor)
    objects = changed_objects(changed)
    ready = ready_rows(readiness, source)
    if grain == "raw":
        return (
            split_join(ready.distinct(), objects.drop(KEY_HASH), ENTITY_KEY, "inner")
            .select(
                F.lower("entity_id").alias("entity_id"),
                "schema_name",
                F.array_sort("objects").alias("object_list"),
                F.col("migrated").cast("string").alias("migrated"),
                "updated",
            )
            .distinct()
        )
    if grain != "entity":
        raise ValueError(f"unknown grain {grain!r}")
    state = ready.groupBy(_key_hash(), *ENTITY_KEY).agg(
        F.bool_or("migrated").alias("migrated"), F.max("updated").alias("updated")
    )
    return (
        objects.join(state, HASHED_KEY)
        .withColumn("entity_id", F.lower("entity_id"))
        .groupBy(_key_hash(), *ENTITY_KEY)
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("objects")))).alias("object_list"),
            F.bool_or("migrated").cast("string").alias("migrated"),
            F.max("updated").alias("updated"),
        )
        .drop(KEY_HASH)
    )
