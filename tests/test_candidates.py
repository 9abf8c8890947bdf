import pytest

from highwater.operators.candidates import candidates
from tests.conftest import rows, ts

OLD, NEW = ts("2000-01-01"), ts("2001-01-01")


def ready(entity, migrated=None, updated=OLD, schema="s", ready=True, available=True, source="MAIN"):
    return (entity, schema, ready, available, source, migrated, updated)


def find(make, feed, readiness, **kw):
    return rows(candidates(make("change_feed", feed), make("readiness", readiness), OLD, "MAIN", **kw))


def test_case_forms_become_one_row_in_the_entity_grain(make):
    feed = [("Ab", "s", "y", NEW), ("Ab", "s", "x", NEW), ("ab", "s", "x", NEW), ("ab", "s", None, NEW)]
    readiness = [ready("Ab", None, OLD), ready("ab", True, NEW)]
    assert find(make, feed, readiness) == [("ab", "s", ["", "x", "y"], "true", NEW)]


def test_raw_grain_keeps_case_forms_and_states_but_no_duplicates(make):
    feed = [("Ab", "s", "x", NEW), ("ab", "s", "x", NEW), ("ab", "s", "x", NEW)]
    readiness = [ready("Ab", None), ready("Ab", False), ready("Ab", True), ready("ab", None, NEW), ready("ab", False)]
    assert find(make, feed, readiness, grain="raw") == sorted(
        [
            ("ab", "s", ["x"], "false", OLD),
            ("ab", "s", ["x"], "true", OLD),
            ("ab", "s", ["x"], "false", NEW),
        ],
        key=repr,
    )


def test_raw_grain_keeps_different_object_lists_apart(make):
    feed = [("Ab", "s", "x", NEW), ("ab", "s", "y", NEW)]
    assert find(make, feed, [ready("Ab"), ready("ab")], grain="raw") == [
        ("ab", "s", ["x"], "false", OLD),
        ("ab", "s", ["y"], "false", OLD),
    ]


def test_sides_are_matched_on_the_id_as_written_and_the_schema(make):
    feed = [("Ab", "s", "x", NEW), ("cd", "s", "x", NEW)]
    assert find(make, feed, [ready("ab"), ready("cd", schema="t")]) == []


@pytest.mark.parametrize(
    "state",
    [{"ready": False}, {"ready": None}, {"available": False}, {"available": None}, {"source": "X"}, {"source": None}],
)
def test_rows_that_are_not_ready_do_not_count(make, state):
    assert find(make, [("a", "s", "x", NEW)], [ready("a", **state)]) == []


def test_unchanged_entities_are_left_out(make):
    assert find(make, [("a", "s", "x", OLD)], [ready("a")]) == []


def test_null_ids_match_nothing(make):
    assert find(make, [(None, "s", "x", NEW)], [ready(None)]) == []


def test_unknown_grain(make):
    with pytest.raises(ValueError):
        find(make, [], [], grain="other")
