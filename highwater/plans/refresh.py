"""One refresh run: plan it, hand the manifest out, settle the attempts, move the watermark."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.timestamps import ntz, with_ntz
from highwater.operators.candidates import candidates
from highwater.operators.control import next_control
from highwater.operators.decision import decide
from highwater.operators.history import registry_status, run_history
from highwater.operators.manifest import manifest, summary
from highwater.operators.outcomes import may_commit, outcomes
from highwater.operators.watermark import changed_since, read_watermarks, stored_watermark
from highwater.settings import RefreshSettings
from highwater.sources.control_table import upsert_control

RECORD_KEY = ("entity_id", "schema_name")


@dataclass(frozen=True)
class RefreshInputs:
    """The tables a run reads; none of them is collected.

    ``sources`` (schema, object) are the only ones that a run with a mark per source reads; None stands for
    all that the feed names.
    """

    change_feed: DataFrame
    readiness: DataFrame
    run_registry: DataFrame
    run_log: DataFrame
    control: DataFrame
    sources: DataFrame | None = None


@dataclass(frozen=True)
class RefreshPlan:
    """What a run decided. ``decisions`` is read back from files, so all parts agree.

    ``read_to`` is the newest change that the run has read (the floor if there was none), observed while it read
    them. As the ``cutoff`` of ``settle`` it keeps changes that came in later for the next run.
    """

    decisions: DataFrame
    manifest: DataFrame
    summary: DataFrame
    read_to: datetime


def watermark(inputs: RefreshInputs, settings: RefreshSettings) -> Column | DataFrame:
    """Where the last committed run stopped: one value for the feed, or one per stored source.

    A source that is not stored starts at the floor in any case, so the feed need not be read
    to list them all.
    """
    if settings.change_source is not None:
        if inputs.sources is not None:
            raise ValueError("sources are listed for runs with a mark per source, not for one mark of the feed")
        return stored_watermark(inputs.control, *settings.change_source, settings.watermark_floor)
    if inputs.sources is not None:
        return read_watermarks(inputs.sources, inputs.control, settings.watermark_floor)
    stored = inputs.control.withColumnRenamed("table_name", "object_name")
    return read_watermarks(stored, inputs.control, settings.watermark_floor)


def find(
    inputs: RefreshInputs,
    settings: RefreshSettings,
    since: datetime | str | Column | DataFrame,
    seen: Observation | None = None,
) -> DataFrame:
    """The candidates of a run. ``seen`` is told the newest change that was read, as text.

    It looks at the changes beyond the one mark, or at those of listed sources beyond theirs, so that filters
    still reach the scan; with a mark for each source of the feed, at all of them.
    """
    feed, listed = inputs.change_feed, inputs.sources is not None

    def watched(df: DataFrame) -> DataFrame:
        return df if seen is None else df.observe(seen, F.max("updated").cast("string").alias("newest"))

    if isinstance(since, DataFrame) and not listed:
        changed = changed_since(watched(with_ntz(feed, "updated")), since, settings.watermark_floor)
    else:
        changed = watched(changed_since(feed, since, settings.watermark_floor, listed=listed))
    return candidates(changed, inputs.readiness, None, settings.source)


def known(
    inputs: RefreshInputs, settings: RefreshSettings, only: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """What the registry and the run log say, one row per entity each."""
    status = registry_status(inputs.run_registry, settings.batch_ids, only=only)
    history = run_history(
        inputs.run_log,
        settings.subject_area,
        settings.as_of,
        settings.max_hours,
        settings.history_floor,
        only=only,
    )
    return status, history


def decisions(
    inputs: RefreshInputs,
    settings: RefreshSettings,
    since: datetime | str | Column | DataFrame,
) -> DataFrame:
    """From the change feed to one decision per candidate, as one lazy plan."""
    return decide(find(inputs, settings, since), *known(inputs, settings))


def judge(found: DataFrame, inputs: RefreshInputs, settings: RefreshSettings) -> DataFrame:
    """One decision per candidate, for candidates that are already written.

    Registry and run log are kept to the entities found. Spark knows the size of the written
    candidates; where they are few it broadcasts them and drops all other rows of the log before
    grouping and shuffling it.
    """
    return decide(found, *known(inputs, settings, only=found))


def newest_change(
    inputs: RefreshInputs, settings: RefreshSettings, since: datetime | str | Column | DataFrame
) -> datetime:
    """The newest change that a run from ``since`` would read, the floor without any. Reads the feed."""
    if isinstance(since, DataFrame) and inputs.sources is not None:
        changed = changed_since(inputs.change_feed, since, settings.watermark_floor, listed=True)
    else:
        changed = changed_since(inputs.change_feed, settings.watermark_floor if isinstance(since, DataFrame) else since)
    return changed.agg(F.max("updated")).first()[0] or settings.watermark_floor


def observed(seen: Observation) -> datetime | None:
    """What ``find`` told, if anything.

    Adaptive execution drops the rest of a plan once one side of a join turns out empty, and the observation with
    it; PySpark then fails to make a row of no metrics.
    """
    try:
        newest = seen.get["newest"]
    except Py4JJavaError:
        return None
    return datetime.fromisoformat(newest) if newest else None


def plan_refresh(inputs: RefreshInputs, settings: RefreshSettings) -> RefreshPlan:
    """Find and decide once, each written to the shared folder; derive manifest and report.

    The feed is read once: the newest change is observed on the way, a maximum, which a task that runs again does
    not change.
    """
    since = watermark(inputs, settings)
    seen = Observation("changes read")
    found = materialise(find(inputs, settings, since, seen), "candidates")
    read_to = max(observed(seen) or newest_change(inputs, settings, since), settings.watermark_floor)
    decided = materialise(judge(found, inputs, settings), "decisions")
    records = manifest(decided, settings.manifest, settings.run_id)
    return RefreshPlan(decided, records, summary(decided), read_to)


def settle(
    plan: RefreshPlan,
    attempts: DataFrame,
    inputs: RefreshInputs,
    settings: RefreshSettings,
    *,
    cutoff: datetime | str | Column | None = None,
) -> DataFrame:
    """The control rows after the attempts; unchanged unless every manifest record was accepted.

    Whether they were is read first (one boolean), so a run that failed does not read the feed again.
    ``attempts`` has one row per attempt with the record's entity and schema. Pass ``plan.read_to`` as
    ``cutoff`` to leave what came in during the run to the next one; with one mark for the whole feed that value is
    the next mark, and the feed is not read at all.
    """
    known_end = settings.change_source is not None and cutoff == plan.read_to > settings.watermark_floor
    ended = outcomes(attempts, settings.max_attempts, settings.retry_codes, keys=RECORD_KEY)
    return next_control(
        inputs.control,
        inputs.change_feed,
        may_commit(ended, plan.manifest),
        settings.as_of,
        source=settings.change_source,
        cutoff=cutoff,
        read_to=plan.read_to if known_end else None,
        sources=inputs.sources,
    )


def commit(
    settled: DataFrame, settings: RefreshSettings, path: str
) -> None:
    """Store the rows that moved; with a closed gate there are none and nothing is written."""
    moved = settled.where(F.col("updated_timestamp") == ntz(settings.as_of))
    upsert_control(moved, path, settings.run_id)
