"""Joins in which one key may own a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUTE = "_route"


def split_join(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equi-join that lets adaptive execution split a hot key of ``many``.

    Spark splits a skewed partition only where both sides of the join come straight out of a
    shuffle made for it. A side that was just grouped by the same keys does not, because its
    partitioning is taken over as it is. A further key, which says nothing new, gives the join
    shuffles of its own; ``one`` has a row per key, so shuffling it again is cheap. A side below
    the broadcast threshold is broadcast as in any other join.
    """
    route = F.xxhash64(*keys)
    return (
        many.withColumn(ROUTE, route)
        .join(one.withColumn(ROUTE, route), [*keys, ROUTE], how)
        .drop(ROUTE)
    )
