"""Which candidates are to be loaded, and why the others are not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.operators.history import ACTIVE, registered

NEW, INACTIVE, IN_FLIGHT, NO_HISTORY, REFRESH, UP_TO_DATE = DECISIONS = (
    "NEW",
    "INACTIVE",
    "IN_FLIGHT",
    "NO_HISTORY",
    "REFRESH",
    "UP_TO_DATE",
)


def new_entities(
    candidates: DataFrame, run_registry: DataFrame, batch_ids: Sequence[str]
) -> DataFrame:
    """Candidates that the batches do not know at all."""
    known = registered(run_registry, batch_ids).select("entity_id").distinct()
    return split_join(candidates, known, ["entity_id"], "left_anti")


def stale_entities(candidates: DataFrame, registry_refresh: DataFrame) -> DataFrame:
    """Candidates that are registered, active and changed after a known last refresh."""
    refreshed = (
        registry_refresh.where(
            (F.col("active_flag") == ACTIVE) & F.col("last_refreshed_ts").isNotNull()
        )
        .groupBy("entity_id")
        .agg(F.min("last_refreshed_ts").alias("last_refreshed_ts"))
    )
    return (
        split_join(candidates, refreshed, ["entity_id"], "inner")
        .where(F.col("updated") > F.col("last_refreshed_ts"))
        .select(*candidates.columns)
    )


def decide(candidates: DataFrame, registry_status: DataFrame, history: DataFrame) -> DataFrame:
    """One decision per candidate; ``registry_status`` and ``history`` hold one row per entity.

    The first reason that applies wins: not registered, not active, a run in flight, no usable
    history, changed since the last refresh, up to date. The registry's entities get their history
    first, so that the candidates are joined, and shuffled, once; an entity that is not registered
    is new whatever its history, and has no last refresh here.
    """
    known = registry_status.join(history, "entity_id", "left")
    return (
        split_join(candidates, known, ["entity_id"], "left")
        .withColumn(
            "decision",
            F.when(F.col("active").isNull(), NEW)
            .when(~F.col("active"), INACTIVE)
            .when(F.col("in_flight"), IN_FLIGHT)
            .when(F.col("last_refreshed_ts").isNull(), NO_HISTORY)
            .when(F.col("updated") > F.col("last_refreshed_ts"), REFRESH)
            .otherwise(UP_TO_DATE),
        )
        .select(*candidates.columns, "last_refreshed_ts", "decision")
    )
