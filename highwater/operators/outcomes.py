"""Folding dispatch attempts into one outcome per entity, and the gate before a commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.settings import ACCEPTED_CODE, MAX_ATTEMPTS, RETRY_CODES

ACCEPTED, REJECTED, EXHAUSTED = "ACCEPTED", "REJECTED", "EXHAUSTED"


def outcomes(
    attempts: DataFrame,
    max_attempts: int = MAX_ATTEMPTS,
    retry_codes: Sequence[int] = RETRY_CODES,
    *,
    keys: Sequence[str] = ("entity_id",),
    order_by: Sequence[str] = ("attempted_at", "attempt_id"),
) -> DataFrame:
    """How each entity's dispatch ended within its first ``max_attempts`` attempts.

    The first attempt that is not worth repeating ends it: accepted on success, rejected on any
    other status or on no response at all. Without such an attempt it is exhausted. The row
    number is compared with a constant right away, so Spark keeps only the first attempts per
    entity on each task before it shuffles.
    """
    first = (
        attempts.withColumn(
            "n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
        )
        .where(F.col("n") <= max_attempts)
    )
    final = F.col("status_code").isNull() | ~F.col("status_code").isin(*retry_codes)
    ended = first.groupBy(*keys).agg(
        F.min(F.when(final, F.col("n"))).alias("ended_at"),
        F.min(F.when(F.col("status_code") == ACCEPTED_CODE, F.col("n"))).alias("accepted_at"),
        F.max("n").alias("last"),
    )
    return ended.select(
        *keys,
        F.coalesce("ended_at", "last").alias("attempts_used"),
        F.when(F.col("ended_at").isNull(), EXHAUSTED)
        .when(F.col("accepted_at") == F.col("ended_at"), ACCEPTED)
        .otherwise(REJECTED)
        .alias("outcome"),
    )


def may_commit(outcomes: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row: the number of outcomes, and whether there is one and all are accepted.

    With ``expected`` (the manifest) a record that has no outcome holds the commit back too.
    The two are matched on the columns that name the record in ``outcomes``.
    """
    if expected is not None:
        keys = [c for c in outcomes.columns if c not in ("attempts_used", "outcome")]
        outcomes = expected.select(*keys).distinct().join(outcomes, keys, "left")
    accepted = F.coalesce(F.col("outcome") == ACCEPTED, F.lit(False))
    return outcomes.agg(
        F.count("*").alias("n"),
        F.coalesce(F.bool_and(accepted), F.lit(False)).alias("may_commit"),
    )
