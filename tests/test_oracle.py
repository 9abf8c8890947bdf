"""Every registered query against SQL over the same tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from highwater.fixtures import views
from highwater.sources.control_table import CONTROL_SCHEMA
from tests.compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(entry.own_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.own_queries()))
def test_matches_sql(spark, con, name):
    got = spark_rows(entry.own_queries()[name](spark, SF_DIR))
    want = duck_rows(con, entry.oracle_sql()[name])
    assert got == want
    assert sum(got[1].values()) > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 146


def test_decision_labels_have_the_known_sizes(spark):
    counts = entry.own_queries()["refresh_decision"](spark, SF_DIR).groupBy("decision").count().collect()
    assert {r.decision: r["count"] for r in counts} == {
        "NEW": 261,
        "INACTIVE": 124,
        "IN_FLIGHT": 152,
        "NO_HISTORY": 5,
        "REFRESH": 316,
        "UP_TO_DATE": 812,
    }


def test_fixtures_reach_the_branches(spark):
    """Each named case has a row in the registered inputs."""
    control = views.control(spark, SF_DIR)
    assert control.select("last_modified_datetime").distinct().count() > 5
    assert control.where("entity_id IS NOT NULL").count() > 0
    registry = views.run_registry(spark, SF_DIR)
    assert registry.where("entity_id IS NULL").count() > 0
    twice = registry.where(F.col("batch_id").isin(*views.SETTINGS.batch_ids)).groupBy("entity_id")
    assert twice.agg(F.count_distinct("active_flag").alias("n")).where("n > 1").count() > 0
    assert registry.where(~F.col("batch_id").isin(*views.SETTINGS.batch_ids)).count() > 0
    for view in (views.run_log, views.change_feed):
        assert view(spark, SF_DIR).where("entity_id IS NULL").count() > 0
    manifest = entry.own_queries()["run_manifest"](spark, SF_DIR)
    assert 0 < manifest.where(F.col("updated").contains(".789")).count() < manifest.count()


def test_a_run_replaces_one_key_and_keeps_the_others(spark):
    before = {tuple(r)[:2]: tuple(r) for r in views.control(spark, SF_DIR).collect()}
    after = entry.own_queries()["refresh_run_control"](spark, SF_DIR)
    after = {(r.schema_name, r.table_name): tuple(r[c] for c in CONTROL_SCHEMA.names) for r in after.collect()}
    assert after.keys() == before.keys()
    assert [k for k in after if after[k] != before[k]] == [views.SETTINGS.change_source]
