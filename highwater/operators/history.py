"""What the run log and the registry say about each entity.

Entity ids are compared in lower case here; rows without an id are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.functions.timestamps import comparable, ntz, with_ntz
from highwater.settings import HISTORY_FLOOR, MAX_RUN_HOURS

# States of a run and of a registry row.
STARTED, COMPLETED, FAILED = "STARTED", "COMPLETED", "FAILED"
ACTIVE = "Y"


def _log_rows(run_log: DataFrame, subject_area: str) -> DataFrame:
    rows = run_log.where((F.col("subject_area") == subject_area) & F.col("entity_id").isNotNull())
    return rows.withColumn("entity_id", F.lower("entity_id"))


def _lease_is_live(run_log: DataFrame, max_hours: int, as_of: datetime) -> Column:
    """``start + max_hours >= as_of``, with the bare column on one side so that it is pushed down."""
    start, limit = comparable(run_log, "batch_start_ts", as_of - timedelta(hours=max_hours))
    return (
        (F.col("batch_status") == STARTED) & (F.col("job_status") != COMPLETED) & (start >= limit)
    )


def _keep(per_entity: DataFrame, only: DataFrame | None) -> DataFrame:
    """Keep the entities of ``only``, if given.

    Asked for right after the grouping, Spark does this before it where ``only`` is small enough
    to be broadcast: rows of all other entities are then dropped unshuffled.
    """
    if only is None:
        return per_entity
    return per_entity.join(only.select("entity_id").distinct(), "entity_id", "left_semi")


def in_flight(
    run_log: DataFrame, subject_area: str, as_of: datetime, max_hours: int = MAX_RUN_HOURS
) -> DataFrame:
    """Entities that hold a live lease: started, not completed, and not older than the lease."""
    return (
        _log_rows(run_log, subject_area)
        .where(_lease_is_live(run_log, max_hours, as_of))
        .select("entity_id")
        .distinct()
    )


def run_history(
    run_log: DataFrame,
    subject_area: str,
    as_of: datetime,
    max_hours: int = MAX_RUN_HOURS,
    floor: datetime = HISTORY_FLOOR,
    *,
    only: DataFrame | None = None,
) -> DataFrame:
    """Per entity: is a run in flight, and when was it last refreshed by a run that did not fail?

    Both answers come from one pass over the log and one shuffle of per-task partial results.
    ``last_refreshed_ts`` is the floor if all usable runs have no time, and null if there is no
    usable run or one is in flight. ``only`` keeps the result to the entities of another frame.
    """
    log = with_ntz(_log_rows(run_log, subject_area), "src_refresh_ts")
    usable = F.coalesce(F.col("batch_status") != FAILED, F.lit(False))
    live = F.coalesce(_lease_is_live(run_log, max_hours, as_of), F.lit(False))
    per_entity = log.groupBy("entity_id").agg(
        F.bool_or(live).alias("in_flight"),
        F.bool_or(usable).alias("has_history"),
        F.max(F.when(usable, F.col("src_refresh_ts"))).alias("newest"),
    )
    has_time = F.col("has_history") & ~F.col("in_flight")
    return _keep(per_entity, only).select(
        "entity_id",
        "in_flight",
        F.when(has_time, F.coalesce("newest", ntz(floor))).alias("last_refreshed_ts"),
    )


def last_refresh(history: DataFrame, candidates: DataFrame) -> DataFrame:
    """The last refresh of each candidate that has one and is not in flight."""
    return (
        history.where(F.col("last_refreshed_ts").isNotNull())
        .join(candidates.select("entity_id").distinct(), "entity_id", "left_semi")
        .select("entity_id", "last_refreshed_ts")
    )


def registered(run_registry: DataFrame, batch_ids: Sequence[str]) -> DataFrame:
    """Registry rows of the given batches."""
    return run_registry.where(
        F.col("batch_id").isin(*batch_ids) & F.col("entity_id").isNotNull()
    ).select(F.lower("entity_id").alias("entity_id"), "active_flag")


def registry_status(
    run_registry: DataFrame, batch_ids: Sequence[str], *, only: DataFrame | None = None
) -> DataFrame:
    """One row per registered entity: is any of its rows active?"""
    active = F.coalesce(F.col("active_flag") == ACTIVE, F.lit(False))
    rows = registered(run_registry, batch_ids)
    return _keep(rows.groupBy("entity_id").agg(F.bool_or(active).alias("active")), only)


def registry_refresh(
    run_registry: DataFrame, refreshed: DataFrame, batch_ids: Sequence[str]
) -> DataFrame:
    """Every registry row of the batches with its entity's last refresh, newest first, unknown last."""
    return (
        split_join(registered(run_registry, batch_ids), refreshed, ["entity_id"], "left")
        .select("entity_id", "last_refreshed_ts", "active_flag")
        .orderBy(F.col("last_refreshed_ts").desc_nulls_last(), "entity_id")
    )
