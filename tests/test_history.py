from highwater.operators.history import (
    in_flight,
    last_refresh,
    registry_refresh,
    registry_status,
    run_history,
)
from tests.conftest import rows, ts

AS_OF = ts("2001-06-01T12:00:00")
FLOOR = ts("1985-01-01")


def log(entity, status="COMPLETED", job="COMPLETED", area="MAIN", start="2001-01-01", refreshed=None):
    return (entity, status, job, area, ts(start), ts(refreshed) if refreshed else None)


def started(entity, start="2001-06-01T11:30:00", job="RUNNING", area="MAIN"):
    return log(entity, "STARTED", job, area, start)


def flying(make, runs, hours=1):
    return [r[0] for r in rows(in_flight(make("run_log", runs), "MAIN", AS_OF, hours))]


def history(make, runs, hours=1):
    return rows(run_history(make("run_log", runs), "MAIN", AS_OF, hours))


def test_lease_that_ends_now_is_still_live(make):
    runs = [started("a", "2001-06-01T11:00:00"), started("b", "2001-06-01T10:59:59.999999")]
    assert flying(make, runs) == ["a"]
    assert flying(make, runs, hours=2) == ["a", "b"]


def test_only_started_unfinished_runs_of_the_area_hold_a_lease(make):
    runs = [
        started("A"),
        started("a"),
        started("b", job="COMPLETED"),
        started("c", area="OTHER"),
        started("d", job=None),
        started(None),
        log("e", "COMPLETED", "RUNNING", start="2001-06-01T11:30:00"),
    ]
    assert flying(make, runs) == ["a"]
    assert [r[0] for r in history(make, runs) if r[1]] == ["a"]


def test_newest_usable_refresh_wins_over_case_forms(make):
    runs = [
        log("A", refreshed="2001-01-01"),
        log("a", refreshed="2001-02-01"),
        log("a", "FAILED", refreshed="2001-03-01"),
        log("a", area="OTHER", refreshed="2001-04-01"),
        log("a"),
    ]
    assert history(make, runs) == [("a", False, ts("2001-02-01"))]


def test_floor_only_when_usable_runs_have_no_time(make):
    runs = [log("a"), log("b", "FAILED", refreshed="2001-01-01"), log("c", None, refreshed="2001-01-01")]
    assert history(make, runs) == [("a", False, FLOOR), ("b", False, None), ("c", False, None)]


def test_expired_started_run_counts_as_history(make):
    runs = [("a", "STARTED", "RUNNING", "MAIN", ts("2001-01-01"), ts("2001-01-02"))]
    assert history(make, runs) == [("a", False, ts("2001-01-02"))]


def test_entity_in_flight_has_no_last_refresh_and_null_ids_hurt_nobody(make):
    runs = [started("a"), log("a", refreshed="2001-01-01"), started(None), log("b", refreshed="2001-01-01")]
    found = make("candidates", [(e, s, [], "false", None) for e in "abc" for s in "st"])
    known = last_refresh(run_history(make("run_log", runs), "MAIN", AS_OF), found)
    assert rows(known) == [("b", ts("2001-01-01"))]


def test_last_refresh_is_kept_to_candidates(make):
    runs = [log("a", refreshed="2001-01-01"), log("b", refreshed="2001-01-01")]
    found = make("candidates", [("b", "s", [], "false", None)])
    known = last_refresh(run_history(make("run_log", runs), "MAIN", AS_OF), found)
    assert rows(known) == [("b", ts("2001-01-01"))]


def test_registry_lists_every_row_newest_first_unknown_last(spark, make):
    registry = make(
        "run_registry",
        [("A", "B1", "Y"), ("b", "B1", "N"), ("c", "B2", "Y"), ("d", "B1", None), ("a", "B1", "N"), (None, "B1", "Y")],
    )
    known = spark.createDataFrame(
        [("a", ts("2001-01-01")), ("b", ts("2001-02-01"))], "entity_id string, last_refreshed_ts timestamp_ntz"
    )
    listed = [tuple(r) for r in registry_refresh(registry, known, ["B1"]).collect()]
    assert [r[0] for r in listed] == ["b", "a", "a", "d"]
    assert sorted(listed, key=repr) == sorted(
        [
            ("b", ts("2001-02-01"), "N"),
            ("a", ts("2001-01-01"), "Y"),
            ("a", ts("2001-01-01"), "N"),
            ("d", None, None),
        ],
        key=repr,
    )
    assert len(registry_refresh(registry, known, ["B1", "B2"]).collect()) == 5


def test_entity_is_active_if_any_of_its_rows_is(make):
    registry = make("run_registry", [("A", "B1", "Y"), ("a", "B1", "N"), ("b", "B1", "N"), ("d", "B1", None)])
    assert rows(registry_status(registry, ["B1"])) == [("a", True), ("b", False), ("d", False)]
