import ast
import json

import pytest
from pyspark.sql import functions as F

from highwater.functions.text import list_text
from highwater.functions.timestamps import iso_text, ntz
from highwater.operators.manifest import manifest, summary
from highwater.settings import ManifestSettings
from tests.conftest import rows, ts

SCHEMA = (
    "entity_id string, schema_name string, object_list array<string>, migrated string, "
    "updated timestamp_ntz, last_refreshed_ts timestamp_ntz, decision string"
)


def decided(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def record(entity, decision, migrated="true", updated="2001-01-01T00:00:00"):
    return (entity, "s", ["", "x"], migrated, ts(updated), None, decision)


def test_only_entities_to_run_with_new_ones_first(spark):
    labels = ["UP_TO_DATE", "REFRESH", "INACTIVE", "NEW", "IN_FLIGHT", "NO_HISTORY"]
    made = manifest(decided(spark, *[record(d.lower(), d) for d in labels]), ManifestSettings(job_id=7))
    assert [(r.entity_id, r.new_entity_flag) for r in made.orderBy("run_order").collect()] == [
        ("new", "True"),
        ("refresh", "False"),
    ]


def test_payload(spark):
    settings = ManifestSettings(
        job_id=7, constants={"environment": "stg", "workers": None}, names={"entity_id": "account"}
    )
    got = manifest(decided(spark, record("a", "NEW", "false", "2001-01-01T01:02:03.004500")), settings).first()
    assert json.loads(got.payload) == {
        "job_id": 7,
        "notebook_params": {
            "account": "a",
            "schema_name": "s",
            "new_entity_flag": "True",
            "migrated": "False",
            "object_list": '["","x"]',
            "updated": "2001-01-01T01:02:03.004500",
            "environment": "stg",
            "workers": None,
        },
    }
    assert list(json.loads(got.payload)["notebook_params"])[:2] == ["account", "schema_name"]
    assert (got.entity_id, got.environment, got.workers) == ("a", "stg", None)


@pytest.mark.parametrize(
    "settings",
    [
        {"constants": {"updated": "x"}},
        {"constants": {"Updated": "x"}},
        {"constants": {"payload": "x"}},
        {"constants": {"run_order": "x"}},
        {"constants": {"run_id": "x"}},
        {"constants": {"environment": "x"}, "names": {"entity_id": "environment"}},
        {"names": {"entity_id": "schema_name"}},
    ],
)
def test_no_name_is_used_twice(spark, settings):
    with pytest.raises(ValueError):
        manifest(decided(spark, record("a", "NEW")), ManifestSettings(job_id=7, **settings))


def test_two_parameters_may_swap_their_names(spark):
    names = {"entity_id": "schema_name", "schema_name": "entity_id"}
    got = manifest(decided(spark, record("a", "NEW")), ManifestSettings(job_id=7, names=names), "run-7").first()
    sent = json.loads(got.payload)["notebook_params"]
    assert (sent["schema_name"], sent["entity_id"], got.run_id) == ("a", "s", "run-7")


@pytest.mark.parametrize(
    "text", ["2001-01-01T00:00:00", "2001-01-01T00:00:00.100000", "2001-12-31T23:59:59.000001", "0999-01-01T10:00:00"]
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_text_is_what_isoformat_gives(spark, text, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.range(1).select(iso_text(ntz(ts(text)))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ts(text).isoformat() == text


def test_iso_text_does_not_move_a_time_that_the_session_zone_skips(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark.range(1).select(iso_text(ntz("2021-03-14 02:30:00"))).first()[0] == "2021-03-14T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_list_text_reads_back_in_both_styles(spark):
    items = ["", "t_A1", "it's", 'say "x"', "'\"", "back\\slash", "tab\tline\n"]
    items += ["\x00\x1b\x7f", "a\xa0b", "\u200b'", "\u2028\\", "\U000e0001", "é ü 漢 😀"]
    df = spark.createDataFrame([(items,)], "items array<string>")
    as_json, as_python = df.select(list_text(F.col("items")), list_text(F.col("items"), "python")).first()
    assert json.loads(as_json) == items
    assert ast.literal_eval(as_python) == items
    assert as_python == str(items)
    with pytest.raises(ValueError):
        list_text(F.col("items"), "other")


def test_summary_counts_rows_and_lists_each_entity_once(spark):
    records = [record("b", "NEW"), record("a", "NEW"), record("a", "NEW"), record("c", "REFRESH")]
    assert rows(summary(decided(spark, *records))) == [("NEW", 0, 3, "a,b"), ("REFRESH", 0, 1, "c")]


def test_summary_spreads_a_long_list_and_loses_nothing(spark):
    ids = [f"e{i}" for i in range(500)]
    lines = summary(decided(spark, *[record(i, "NEW") for i in ids]), ids_per_line=50).collect()
    assert len(lines) == 10
    assert {r.n for r in lines} == {500}
    assert sorted(i for r in lines for i in r.entities.split(",")) == sorted(ids)
    assert max(len(r.entities.split(",")) for r in lines) < 100
