from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from highwater.operators.decision import DECISIONS, decide, new_entities, stale_entities
from highwater.operators.history import last_refresh, registry_refresh, registry_status, run_history
from highwater.operators.manifest import manifest
from highwater.settings import ManifestSettings
from tests.conftest import rows, ts

AS_OF = ts("2001-06-01")
T = ts("2001-01-01")


def run(make, found, registry, runs):
    return decide(
        make("candidates", found),
        registry_status(make("run_registry", registry), ["B1"]),
        run_history(make("run_log", runs), "MAIN", AS_OF),
    )


def candidate(entity, updated=T):
    return (entity, "s", ["x"], "false", updated)


def refreshed(entity, when):
    return (entity, "COMPLETED", "COMPLETED", "MAIN", T, when)


def leased(entity):
    return (entity, "STARTED", "RUNNING", "MAIN", AS_OF, None)


def test_first_reason_that_applies_wins(make):
    later, same, earlier = T + timedelta(seconds=1), T, T - timedelta(microseconds=1)
    names = ["new", "leased_new", "off", "leased_off", "leased", "unknown", "failed", "floor", "stale", "same", "done"]
    registry = [(n.upper(), "B1", "N" if n in ("off", "leased_off") else "Y") for n in names if "new" not in n]
    registry.append(("new", "B2", "Y"))
    runs = [leased("LEASED"), leased("LEASED_OFF"), leased("leased_new"), refreshed("leased", earlier)]
    runs += [("FAILED", "FAILED", "COMPLETED", "MAIN", T, earlier), refreshed("FLOOR", None)]
    runs += [refreshed("Stale", earlier), refreshed("SAME", same), refreshed("DONE", later), refreshed("OFF", earlier)]
    got = {r.entity_id: r.decision for r in run(make, [candidate(n) for n in names], registry, runs).collect()}
    assert got == {
        "new": "NEW",
        "leased_new": "NEW",
        "off": "INACTIVE",
        "leased_off": "INACTIVE",
        "leased": "IN_FLIGHT",
        "unknown": "NO_HISTORY",
        "failed": "NO_HISTORY",
        "floor": "REFRESH",
        "stale": "REFRESH",
        "same": "UP_TO_DATE",
        "done": "UP_TO_DATE",
    }


ENTITIES = ["a", "b", "c", "d"]
case = st.sampled_from(ENTITIES).flatmap(lambda e: st.sampled_from([e, e.upper()]))
when = st.one_of(st.none(), st.integers(0, 5).map(lambda d: T + timedelta(days=d)))
found_rows = st.dictionaries(
    st.tuples(st.sampled_from(ENTITIES), st.sampled_from(["s", "t"])),
    st.integers(0, 5).map(lambda d: T + timedelta(days=d)),
    min_size=1,
)
registry_rows = st.lists(st.tuples(case, st.sampled_from(["B1", "B2"]), st.sampled_from(["Y", "N", None])), max_size=6)
run_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), case),
        st.sampled_from(["STARTED", "COMPLETED", "FAILED"]),
        st.sampled_from(["RUNNING", "COMPLETED"]),
        st.sampled_from(["MAIN", "OTHER"]),
        st.sampled_from([AS_OF, AS_OF - timedelta(hours=1), AS_OF - timedelta(hours=2)]),
        when,
    ),
    max_size=10,
)


def expected(entity, updated, registry, runs):
    """The definition, one entity at a time."""
    flags = [f for e, b, f in registry if e.lower() == entity and b == "B1"]
    mine = [r for r in runs if r[0] and r[0].lower() == entity and r[3] == "MAIN"]
    if not flags:
        return "NEW"
    if "Y" not in flags:
        return "INACTIVE"
    if any(s == "STARTED" and j != "COMPLETED" and t + timedelta(hours=1) >= AS_OF for _, s, j, _, t, _ in mine):
        return "IN_FLIGHT"
    usable = [r[5] for r in mine if r[1] != "FAILED"]
    if not usable:
        return "NO_HISTORY"
    newest = max([t for t in usable if t], default=datetime(1985, 1, 1))
    return "REFRESH" if updated > newest else "UP_TO_DATE"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(found=found_rows, registry=registry_rows, runs=run_rows)
def test_decisions_follow_the_definition(make, found, registry, runs):
    candidates = [(e, s, ["x"], "false", u) for (e, s), u in found.items()]
    decided = run(make, candidates, registry, runs)
    got = {(r.entity_id, r.schema_name): r.decision for r in decided.collect()}
    assert got == {(e, s): expected(e, u, registry, runs) for (e, s), u in found.items()}
    assert set(got.values()) <= set(DECISIONS)

    frame = make("candidates", candidates)
    known = make("run_registry", registry)
    history = run_history(make("run_log", runs), "MAIN", AS_OF)
    new = new_entities(frame, known, ["B1"])
    stale = stale_entities(frame, registry_refresh(known, last_refresh(history, frame), ["B1"]))
    key = ["entity_id", "schema_name"]
    to_run = manifest(decided, ManifestSettings(job_id=1)).select(*key)
    assert rows(new.select(*key).unionByName(stale.select(*key))) == rows(to_run)
