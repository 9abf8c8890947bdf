"""The plans that Spark makes of the operators, with broadcast off as for large sides."""

import re
from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from highwater.fixtures import views
from highwater.functions.lineage import materialise
from highwater.operators.candidates import candidates, changed_objects
from highwater.operators.decision import decide, new_entities, stale_entities
from highwater.operators.history import (
    in_flight,
    last_refresh,
    registry_refresh,
    registry_status,
    run_history,
)
from highwater.operators.outcomes import outcomes
from highwater.operators.watermark import changed_since, read_watermarks, stored_watermark
from highwater.plans import refresh
from highwater.plans.refresh import RefreshInputs, decisions, find, judge
from highwater.operators.control import next_control
from highwater.sources.control_table import CONTROL_SCHEMA, ensure_control, read_control, upsert_control
from tests.conftest import ts

SF_DIR = "/root/testdata/sf0.01"
WRITES = {"control_upsert"}


@contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def depth_first(plan: str, *words: str) -> bool:
    """Do the words occur in this order, from the result down to the scans?"""
    at = 0
    for word in words:
        at = plan.find(word, at) + 1
        if at == 0:
            return False
    return True


@pytest.mark.parametrize("name", sorted(set(entry.own_queries()) - WRITES))
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "GlobalLimit", "CollectLimit"):
        assert word not in plan
    # Only the totals of the six decisions may be broadcast by hint.
    assert plan.count("BroadcastHashJoin") == (1 if name == "manifest_summary" else 0)
    # A single partition takes the per-task results of an aggregate without keys, never rows.
    for line_no, line in enumerate(lines := plan.splitlines()):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[]" in lines[line_no + 1]


@pytest.fixture
def feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    views.change_feed(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def pushed(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
    return "\n".join(line for line in text.splitlines() if line.startswith(("PushedFilters", "ReadSchema")))


def test_watermark_reaches_the_scan(spark, feed, tmp_path):
    assert "GreaterThan(updated,1999-01-01T00:00)" in pushed(changed_since(feed, ts("1999-01-01")))
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    upsert_control(views.control(spark, SF_DIR), path)
    control = read_control(spark, path)
    changed = changed_since(feed, stored_watermark(control, "raw_o", "t_N2"))
    assert "GreaterThan(updated,ScalarSubquery" in pushed(changed)
    assert changed.count() == feed.where(F.col("updated") > F.lit(views.EARLIER)).count()


def test_zoned_watermark_reaches_the_scan_too(spark, feed, tmp_path):
    path = str(tmp_path / "zoned")
    feed.withColumn("updated", F.col("updated").cast("timestamp")).write.parquet(path)
    assert "GreaterThan(updated," in pushed(changed_since(spark.read.parquet(path), ts("1999-01-01")))


def test_lease_and_readiness_reach_the_scan(spark, feed, tmp_path):
    log, ready = str(tmp_path / "log"), str(tmp_path / "ready")
    views.run_log(spark, SF_DIR).write.parquet(log)
    views.readiness(spark, SF_DIR).write.parquet(ready)
    filters = pushed(in_flight(spark.read.parquet(log), "MAIN", ts("2001-06-01"), 2160))
    assert "GreaterThanOrEqual(batch_start_ts,2001-03-03T00:00)" in filters
    assert "EqualTo(batch_status,STARTED)" in filters
    assert "src_refresh_ts" not in filters
    filters = pushed(candidates(feed, spark.read.parquet(ready), ts("1999-01-01"), "MAIN"))
    assert "EqualTo(source,MAIN)" in filters
    assert "EqualTo(ready_for_processing,true)" in filters


def test_rows_are_folded_on_each_task_before_a_shuffle(spark, feed):
    assert depth_first(plan_of(changed_objects(feed)), "collect_set", "Exchange", "partial_collect_set", "Scan")
    log = views.run_log(spark, SF_DIR)
    history = plan_of(run_history(log, "MAIN", ts("2001-06-01"), 2160))
    assert depth_first(history, "HashAggregate", "Exchange", "partial_", "Scan")
    assert history.count("Exchange") == 1 and history.count("Scan") == 1


def test_few_candidates_cut_the_log_before_it_is_shuffled(spark, tmp_path):
    written = {}
    for name in ("readiness", "run_registry", "run_log", "change_feed", "control"):
        written[name] = str(tmp_path / name)
        getattr(views, name)(spark, SF_DIR).write.parquet(written[name])
    inputs = RefreshInputs(**{name: spark.read.parquet(path) for name, path in written.items()})
    found = materialise(find(inputs, views.SETTINGS, views.WATERMARK), "candidates")
    judged = judge(found, inputs, views.SETTINGS)
    plan = plan_of(judged)
    for column in ("batch_id", "batch_status"):
        branch = plan[: re.search(rf"FileScan parquet \[entity_id#\d+,{column}#", plan).start()]
        assert depth_first(branch[branch.rindex("partial_") :], "BroadcastHashJoin", "LeftSemi")
    whole = decisions(inputs, views.SETTINGS, views.WATERMARK)
    assert judged.exceptAll(whole).isEmpty() and whole.exceptAll(judged).isEmpty()


def test_only_the_first_attempts_are_shuffled(spark):
    plan = plan_of(outcomes(views.dispatch_attempts(spark, SF_DIR)))
    assert depth_first(plan, "Window ", "WindowGroupLimit", "Final", "Exchange", "WindowGroupLimit", "Partial", "Scan")
    assert plan.count("Exchange") == 1


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
)
DAY = ts("2001-01-01")


def hot_third():
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id").cast("string")))


def hot_schemas(spark, n=20000):
    """Candidates of which one entity owns a third."""
    return spark.range(n, numPartitions=8).select(
        hot_third().alias("entity_id"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("schema_name"),
        F.array(F.lit("x")).alias("object_list"),
        F.lit("false").alias("migrated"),
        F.lit(DAY).cast("timestamp_ntz").alias("updated"),
    )


def split(df) -> tuple[bool, int]:
    """Was a partition split, and how many rows came out?"""
    n = len(df.collect())
    return "skew=true" in plan_of(df), n


def test_hot_source_is_split_when_watermarks_are_not_broadcast(spark, feed, tmp_path):
    path = str(tmp_path / "hot")
    hot = F.when(F.xxhash64("entity_id") % 3 == 0, "t_A1").otherwise(F.col("object_name"))
    feed.withColumn("object_name", hot).repartition(8).write.parquet(path)
    skewed = spark.read.parquet(path)
    stored = (
        skewed.select("schema_name", F.col("object_name").alias("table_name"))
        .where("table_name is not null")
        .distinct()
        .withColumn("last_modified_datetime", F.lit("1999-01-01").cast("timestamp_ntz"))
    )
    expected = skewed.where(
        "updated > if(object_name is null, timestamp_ntz'1990-01-01', timestamp_ntz'1999-01-01')"
    ).count()
    with conf(spark, **SKEW):
        marks = read_watermarks(stored.withColumnRenamed("table_name", "object_name"), stored)
        assert split(changed_since(skewed, marks)) == (True, expected)


def test_hot_entity_is_split_in_the_decision(spark, make):
    found = hot_schemas(spark)
    registry = found.select("entity_id", F.lit("B1").alias("batch_id"), F.lit("Y").alias("active_flag"))
    log = found.select(
        "entity_id",
        F.lit("COMPLETED").alias("batch_status"),
        F.lit("COMPLETED").alias("job_status"),
        F.lit("MAIN").alias("subject_area"),
        F.lit(DAY).cast("timestamp_ntz").alias("batch_start_ts"),
        F.lit(ts("2000-01-01")).cast("timestamp_ntz").alias("src_refresh_ts"),
    )
    history = run_history(log, "MAIN", ts("2001-06-01"))
    other = make("run_registry", [("e1", "B1", "Y")])
    with conf(spark, **SKEW):
        assert split(decide(found, registry_status(registry, ["B1"]), history)) == (True, 20000)
        assert split(new_entities(found, other, ["B1"])) == (True, 19999)
        known = last_refresh(history, found)
        assert split(stale_entities(found, registry_refresh(registry, known, ["B1"]))) == (True, 20000)
        # Sizes are counted after compression, so the rows of the hot entity must not be all alike.
        noted = registry.withColumn("active_flag", F.md5(F.monotonically_increasing_id().cast("string")))
        assert split(registry_refresh(noted, known, ["B1"])) == (True, 20000)


def test_hot_readiness_is_split_in_the_raw_grain(spark, make):
    ids = spark.range(20000, numPartitions=8)
    ready = ids.select(
        hot_third().alias("entity_id"),
        F.lit("s").alias("schema_name"),
        F.lit(True).alias("ready_for_processing"),
        F.lit(True).alias("data_available"),
        F.lit("MAIN").alias("source"),
        F.lit(False).alias("migrated"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit(DAY).cast("timestamp_ntz")).alias("updated"),
    )
    feed = ready.select("entity_id", "schema_name", F.lit("x").alias("object_name"), "updated").distinct()
    with conf(spark, **SKEW):
        assert split(candidates(feed, ready, ts("1999-01-01"), "MAIN", grain="raw")) == (True, 20000)


def test_jobs_do_not_grow_with_the_entities(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(sf):
        spark.sparkContext.setJobGroup(f"manifest-{sf}", "")
        entry.queries()["run_manifest"](spark, f"/root/testdata/sf{sf}").write.format("noop").mode("overwrite").save()
        return len(tracker.getJobIdsForGroup(f"manifest-{sf}"))

    assert jobs("0.1") == jobs("0.001") < 15


def test_a_closed_gate_reads_no_feed(spark):
    assert "lineitem" in plan_of(entry.queries()["next_watermark"](spark, SF_DIR))
    held = next_control(
        spark.createDataFrame([], CONTROL_SCHEMA), views.change_feed(spark, SF_DIR), False, ts("2001-06-01")
    )
    assert "lineitem" not in plan_of(held)


def test_a_stored_mark_reaches_the_scan_of_a_commit(spark, feed, tmp_path):
    stamp = ts("1999-01-01")
    control = spark.createDataFrame([("meta", "feed", None, stamp, stamp, stamp)], CONTROL_SCHEMA)
    moved = next_control(control, feed, True, ts("2001-06-01"), source=("meta", "feed"))
    assert "GreaterThan(updated,1999-01-01T00:00)" in pushed(moved)


@pytest.fixture
def written(spark, tmp_path):
    """The inputs of a run as files, so that scans can be told apart by their columns."""
    paths = {}
    for name in ("readiness", "run_registry", "run_log", "change_feed", "control"):
        paths[name] = str(tmp_path / name)
        getattr(views, name)(spark, SF_DIR).write.parquet(paths[name])
    return RefreshInputs(**{name: spark.read.parquet(path) for name, path in paths.items()})


@pytest.mark.parametrize("whole", [True, False], ids=["whole_feed", "by_source"])
def test_a_run_reads_the_feed_once(spark, written, monkeypatch, whole):
    settings = replace(views.SETTINGS, change_source=views.SETTINGS.change_source if whole else None)
    plans = {}

    def noted(df, label):
        plans[label] = plan_of(df)
        return materialise(df, label)

    monkeypatch.setattr(refresh, "materialise", noted)
    monkeypatch.setattr(refresh, "newest_change", lambda *_: pytest.fail("the feed was read again"))
    plan = refresh.plan_refresh(written, settings)
    assert {label: len(re.findall(r"FileScan parquet \[[^\]]*object_name#", text)) for label, text in plans.items()} == {
        "candidates": 1,
        "decisions": 0,
    }
    assert plan.read_to == written.change_feed.agg(F.max("updated")).first()[0]
    settled = refresh.settle(plan, views.record_attempts(plan.manifest), written, settings, cutoff=plan.read_to)
    scans = re.findall(r"FileScan parquet \[[^\]]*updated#", plan_of(settled))
    assert len(scans) == (0 if whole else 1)
    want = next_control(
        written.control, written.change_feed, True, settings.as_of, source=settings.change_source, cutoff=plan.read_to
    )
    assert sorted(map(tuple, settled.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_observing_leaves_the_filter_in_the_scan(written):
    since = refresh.watermark(written, views.SETTINGS)
    found = find(written, views.SETTINGS, since, Observation("seen"))
    assert "GreaterThan(updated,ScalarSubquery" in pushed(found)


@pytest.fixture
def partitioned(spark, tmp_path):
    path = str(tmp_path / "by_source")
    views.change_feed(spark, SF_DIR).write.partitionBy("schema_name", "object_name").parquet(path)
    return spark.read.parquet(path)


def files_read(df) -> int:
    """Files that the scans of a plan that ran have opened."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan().finalPhysicalPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getName() and node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_listed_sources_prune_partitions_and_push_the_least_mark(spark, partitioned, tmp_path):
    control = str(tmp_path / "control")
    views.control(spark, SF_DIR).write.parquet(control)
    control = spark.read.parquet(control)
    few = control.where("table_name IN ('t_N2', 't_A3') AND schema_name = 'raw_o'")
    marks = read_watermarks(few.withColumnRenamed("table_name", "object_name"), control)
    changed = changed_since(partitioned, marks, listed=True)
    text = spark._jvm.PythonSQLUtils.explainString(changed._jdf.queryExecution(), "formatted")
    assert "dynamicpruning" in text
    assert "GreaterThan(updated,ScalarSubquery" in pushed(changed)
    want = partitioned.where(
        "schema_name = 'raw_o' AND (object_name = 't_N2' AND updated > timestamp_ntz'1997-03-04 05:06:07.25' "
        "OR object_name = 't_A3' AND updated > timestamp_ntz'1998-12-30')"
    )
    assert changed.exceptAll(want).isEmpty() and want.exceptAll(changed).isEmpty() and not want.isEmpty()
    assert files_read(changed.select("updated")) < len(partitioned.inputFiles()) / 4


def test_an_empty_list_reads_nothing(spark, partitioned):
    none = spark.createDataFrame([], "schema_name string, object_name string, watermark timestamp_ntz")
    assert changed_since(partitioned, none, listed=True).count() == 0
    assert changed_since(partitioned, none).count() == partitioned.where("updated > timestamp_ntz'1990-01-01'").count()
