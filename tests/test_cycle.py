"""Whole runs: plan, dispatch, settle, commit, and run again."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from highwater.plans.refresh import RefreshInputs, commit, plan_refresh, settle
from highwater.settings import ManifestSettings, RefreshSettings
from highwater.sources.control_table import ensure_control, read_control
from tests.conftest import rows, ts

OLD, DAY = ts("2000-01-01"), timedelta(days=1)
SETTINGS = RefreshSettings(
    source="MAIN",
    subject_area="MAIN",
    batch_ids=("B1",),
    as_of=ts("2001-06-01"),
    manifest=ManifestSettings(job_id=1),
)
BY_SOURCE = replace(SETTINGS, change_source=None)
WHOLE_FEED = replace(SETTINGS, change_source=("meta", "feed"))


@pytest.fixture
def world(spark, make, tmp_path):
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    feed = [("New", "s", "x", OLD + DAY), ("stale", "s", "x", OLD), ("done", "s", "y", OLD), ("unready", "s", "z", OLD)]
    feed.append(("New", "s", None, OLD + DAY))  # a change that names no object
    ready = [(e, "s", e != "unready", True, "MAIN", False, OLD + DAY) for e, *_ in feed]
    registry = [("STALE", "B1", "Y"), ("DONE", "B1", "Y")]
    log = [("STALE", OLD), ("DONE", OLD + 2 * DAY)]

    def inputs(extra=()):
        return RefreshInputs(
            make("change_feed", feed + list(extra)),
            make("readiness", ready),
            make("run_registry", registry),
            make("run_log", [(e, "COMPLETED", "COMPLETED", "MAIN", OLD, t) for e, t in log]),
            read_control(spark, path),
        )

    return path, inputs


def dispatched(spark, records):
    rows = [(e, "s", datetime(2001, 6, 1), i, status) for i, (e, status) in enumerate(records)]
    return spark.createDataFrame(
        rows, "entity_id string, schema_name string, attempted_at timestamp_ntz, attempt_id bigint, status_code int"
    )


def labels(plan):
    return {r.entity_id: r.decision for r in plan.decisions.collect()}


@pytest.mark.parametrize("settings", [BY_SOURCE, WHOLE_FEED], ids=["by_source", "whole_feed"])
def test_a_committed_run_leaves_nothing_for_the_next_one(spark, world, settings):
    path, inputs = world
    plan = plan_refresh(inputs(), settings)
    assert labels(plan) == {"new": "NEW", "stale": "REFRESH", "done": "UP_TO_DATE"}
    assert [r.entity_id for r in plan.manifest.orderBy("run_order").collect()] == ["new", "stale"]
    assert {r.decision: r.n for r in plan.summary.collect()} == {"NEW": 1, "REFRESH": 1, "UP_TO_DATE": 1}

    attempts = dispatched(spark, [("new", 503), ("new", 200), ("stale", 200)])
    commit(settle(plan, attempts, inputs(), settings), settings, path)
    again = plan_refresh(inputs(), settings)
    assert labels(again) == {}
    assert again.manifest.count() == again.summary.count() == 0

    changed = inputs([("done", "s", "x", OLD + 2 * DAY)])
    assert labels(plan_refresh(changed, settings)) == {"done": "UP_TO_DATE"}


@pytest.mark.parametrize(
    "records",
    [
        [("new", 200), ("stale", 400)],
        [("new", 200), ("stale", 503), ("stale", 503), ("stale", 503), ("stale", 200)],
        [("new", 200)],
        [],
    ],
    ids=["rejected", "exhausted", "never sent", "nothing sent"],
)
def test_anything_but_acceptance_holds_the_watermark(spark, world, records):
    path, inputs = world
    plan = plan_refresh(inputs(), WHOLE_FEED)
    settled = settle(plan, dispatched(spark, records), inputs(), WHOLE_FEED)
    assert rows(settled) == []
    commit(settled, WHOLE_FEED, path)
    assert rows(read_control(spark, path)) == []
    assert labels(plan_refresh(inputs(), WHOLE_FEED)) == labels(plan)


def test_rows_passed_over_are_seen_again_only_with_a_cutoff(spark, world):
    path, inputs = world
    plan = plan_refresh(inputs(), WHOLE_FEED)
    arrived = inputs([("done", "s", "x", OLD + 5 * DAY)])
    attempts = dispatched(spark, [("new", 200), ("stale", 200)])
    moved = rows(settle(plan, attempts, arrived, WHOLE_FEED))
    assert [r[5] for r in moved] == [OLD + 5 * DAY]
    moved = rows(settle(plan, attempts, arrived, WHOLE_FEED, cutoff=OLD + DAY))
    assert [r[5] for r in moved] == [OLD + DAY]


def test_a_run_knows_what_it_has_read(spark, world):
    path, inputs = world
    for settings in (WHOLE_FEED, BY_SOURCE):
        plan = plan_refresh(inputs(), settings)
        assert plan.read_to == OLD + DAY
    arrived = inputs([("done", "s", "x", OLD + 5 * DAY)])
    attempts = dispatched(spark, [("new", 200), ("stale", 200)])
    commit(settle(plan, attempts, arrived, WHOLE_FEED, cutoff=plan.read_to), WHOLE_FEED, path)
    arrived = replace(arrived, control=read_control(spark, path))
    assert labels(plan_refresh(arrived, WHOLE_FEED)) == {"done": "UP_TO_DATE"}
    nothing = replace(inputs(), change_feed=inputs().change_feed.limit(0))
    assert plan_refresh(nothing, WHOLE_FEED).read_to == WHOLE_FEED.watermark_floor


def test_a_run_over_listed_sources_leaves_the_others_alone(spark, world):
    path, inputs = world
    extra = [("other", "t", "x", OLD + 3 * DAY)]
    sources = spark.createDataFrame([("s", "x"), ("s", "never seen")], "schema_name string, object_name string")
    listed = replace(inputs(extra), sources=sources)
    plan = plan_refresh(listed, BY_SOURCE)
    assert labels(plan) == {"new": "NEW", "stale": "REFRESH"} and plan.read_to == OLD + DAY
    attempts = dispatched(spark, [("new", 200), ("stale", 200)])
    commit(settle(plan, attempts, listed, BY_SOURCE, cutoff=plan.read_to), BY_SOURCE, path)
    assert [(r.schema_name, r.table_name, r.last_modified_datetime) for r in read_control(spark, path).collect()] == [
        ("s", "x", OLD + DAY)
    ]
    assert labels(plan_refresh(replace(inputs(extra), sources=sources), BY_SOURCE)) == {}
    with pytest.raises(ValueError, match="mark per source"):
        plan_refresh(listed, WHOLE_FEED)


def test_nothing_to_read_leaves_old_marks(spark, world):
    """No change beyond the mark: the mark stays, whether it is known or the feed has to be asked."""
    path, inputs = world
    plan = plan_refresh(inputs(), WHOLE_FEED)
    attempts = dispatched(spark, [("new", 200), ("stale", 200)])
    commit(settle(plan, attempts, inputs(), WHOLE_FEED, cutoff=plan.read_to), WHOLE_FEED, path)
    again = plan_refresh(inputs(), WHOLE_FEED)
    assert again.read_to == WHOLE_FEED.watermark_floor
    settled = settle(again, attempts, inputs(), WHOLE_FEED, cutoff=again.read_to)
    assert [r.last_modified_datetime for r in settled.collect()] == [OLD + DAY]


def test_the_run_names_its_records(spark, world):
    _, inputs = world
    plan = plan_refresh(inputs(), replace(WHOLE_FEED, run_id="r1"))
    assert {r.run_id for r in plan.manifest.collect()} == {"r1"}


def test_decisions_are_read_back_from_the_shared_folder(spark, world):
    _, inputs = world
    plan = plan_refresh(inputs(), WHOLE_FEED)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(f"{shared}/decisions-" in file for file in plan.decisions.inputFiles())
