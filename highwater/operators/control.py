"""The control rows after a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.functions.timestamps import comparable, ntz, with_ntz
from highwater.operators.watermark import named

CONTROL_KEY = ["schema_name", "table_name"]
STAMPS = ["created_timestamp", "updated_timestamp", "last_modified_datetime"]


def next_control(
    control: DataFrame,
    change_feed: DataFrame,
    gate: DataFrame | bool,
    as_of: datetime,
    *,
    source: tuple[str, str] | None = None,
    cutoff: datetime | str | Column | None = None,
    read_to: datetime | None = None,
    sources: DataFrame | None = None,
) -> DataFrame:
    """The control rows once the run is settled.

    With an open gate each source's watermark moves to its newest change: a known key keeps its
    creation time, an unknown one is added. A source without any dated change stays as it is. The
    gate's one boolean is read first: under a closed gate every key stays, and the feed is not
    read. ``source`` names the key under which the feed as a whole is stored; then only changes
    beyond the stored mark are read, and the mark does not move back if changes were deleted. Without
    ``source`` every (schema, object) of the feed is a source of its own and the whole feed is read.
    ``cutoff`` leaves out changes newer than what the run has read and never moves a mark back;
    without it the maximum is over all. ``read_to`` says that the newest change up to the cutoff is known: with
    ``source`` it is taken as it is and the feed is not read. ``sources`` (schema, object) are the only ones whose
    changes count where every source has its own mark; the partitions of others are not opened. Stored rows and
    the newest changes, one row per key each, are then folded by key together.
    """
    stored = with_ntz(control, *STAMPS).select(
        "schema_name", named("table_name").alias("table_name"), "entity_id", *STAMPS, F.lit(True).alias("stored")
    )
    is_open = gate if isinstance(gate, bool) else bool(gate.select("may_commit").first()[0])
    if not is_open:
        return stored.drop("stored")
    if cutoff is not None:
        updated, value = comparable(change_feed, "updated", cutoff)
        change_feed = change_feed.where(updated <= value)
    newest = F.max("updated").alias("newest")
    if source is None:
        feed = with_ntz(change_feed, "updated").withColumn("table_name", named("object_name"))
        if sources is not None:
            wanted = sources.select("schema_name", named("object_name").alias("table_name")).distinct()
            feed = split_join(feed, wanted, CONTROL_KEY, "left_semi")
        reached = feed.where(F.col("schema_name").isNotNull()).groupBy(*CONTROL_KEY).agg(newest)
    else:
        key = [F.lit(value).alias(name) for name, value in zip(CONTROL_KEY, source)]
        # One value, so that it reaches the scan; while nothing is stored, all changes count.
        mark = (
            with_ntz(control, "last_modified_datetime")
            .where((F.col("schema_name") == source[0]) & (F.col("table_name") == source[1]))
            .agg(F.max("last_modified_datetime"))
            .first()[0]
        )
        if read_to is not None:
            reached = control.sparkSession.range(1).select(*key, ntz(max(read_to, mark or read_to)).alias("newest"))
        else:
            if mark is not None:
                updated, value = comparable(change_feed, "updated", mark)
                change_feed = change_feed.where(updated > value)
                newest = F.coalesce(newest, ntz(mark)).alias("newest")
            reached = with_ntz(change_feed, "updated").agg(newest).select(*key, "newest")
    moves = F.col("newest").isNotNull()
    if cutoff is not None:
        newest_kept = F.greatest("newest", "last_modified_datetime")
    else:
        newest_kept = F.col("newest")
    return (
        stored.unionByName(reached, allowMissingColumns=True)
        .groupBy(*CONTROL_KEY)
        .agg(*[F.max(c).alias(c) for c in ("entity_id", *STAMPS, "stored", "newest")])
        .where(F.col("stored") | moves)
        .select(
            *CONTROL_KEY,
            "entity_id",
            F.when(F.col("stored"), F.col("created_timestamp"))
            .otherwise(ntz(as_of))
            .alias("created_timestamp"),
            F.when(moves, ntz(as_of))
            .otherwise(F.col("updated_timestamp"))
            .alias("updated_timestamp"),
            F.when(moves, newest_kept)
            .otherwise(F.col("last_modified_datetime"))
            .alias("last_modified_datetime"),
        )
    )
