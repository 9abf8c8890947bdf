import pytest
from pyspark.sql import functions as F

from highwater.operators.control import next_control
from highwater.sources.control_table import (
    compact_control,
    ensure_control,
    read_control,
    upsert_control,
)
from tests.conftest import rows, ts

OLD, NEW, AS_OF = ts("2000-01-01"), ts("2001-01-01T00:00:00.000001"), ts("2001-06-01")


def gate(spark, open_):
    return spark.createDataFrame([(1, open_)], "n bigint, may_commit boolean")


def move(spark, make, stored, feed, open_=True, **kw):
    return rows(next_control(make("control", stored), make("change_feed", feed), gate(spark, open_), AS_OF, **kw))


STORED = [("s", "x", None, OLD, OLD, OLD), ("s", "quiet", "e", OLD, OLD, None)]
FEED = [
    ("a", "s", "x", NEW),
    ("a", "s", "x", OLD),
    ("a", "s", "fresh", OLD),
    ("a", "s", "undated", None),
    ("a", "s", None, NEW),
    ("a", None, "x", NEW),
]


def test_known_keys_move_unknown_ones_are_added(spark, make):
    assert move(spark, make, STORED, FEED) == [
        ("s", "", None, AS_OF, AS_OF, NEW),  # a change that names no object
        ("s", "fresh", None, AS_OF, AS_OF, OLD),
        ("s", "quiet", "e", OLD, OLD, None),
        ("s", "x", None, OLD, AS_OF, NEW),
    ]


@pytest.mark.parametrize("open_", [False, None])
def test_closed_gate_leaves_everything(spark, make, open_):
    assert move(spark, make, STORED, FEED, open_) == sorted(STORED, key=repr)


def test_empty_or_undated_feed_leaves_everything(spark, make):
    assert move(spark, make, STORED, []) == sorted(STORED, key=repr)
    assert move(spark, make, STORED, [("a", "s", "x", None)]) == sorted(STORED, key=repr)


def test_cutoff_leaves_out_what_the_run_has_not_read(spark, make):
    got = move(spark, make, STORED, FEED, cutoff=ts("2000-06-01"))
    assert ("s", "x", None, OLD, AS_OF, OLD) in got


def test_cutoff_is_compared_with_zoned_times_too(spark, make):
    zoned = make("change_feed", FEED).withColumn("updated", F.col("updated").cast("timestamp"))
    control, cutoff = make("control", STORED), ts("2000-06-01")
    moved = next_control(control, zoned, gate(spark, True), AS_OF, cutoff=cutoff)
    assert rows(moved) == move(spark, make, STORED, FEED, cutoff=cutoff)


def test_upsert_replaces_only_the_given_keys(spark, make, tmp_path):
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    assert rows(read_control(spark, path)) == []
    first = [("s", "x", None, OLD, OLD, OLD), ("s", "y", "e", OLD, OLD, None), ("007", "1e3", None, OLD, OLD, OLD)]
    upsert_control(make("control", first), path)
    ensure_control(spark, path)
    upsert_control(make("control", [("s", "x", None, OLD, AS_OF, NEW), ("t", "a/b =%", None, OLD, OLD, OLD)]), path)
    assert rows(read_control(spark, path)) == sorted(
        [("s", "x", None, OLD, AS_OF, NEW), ("t", "a/b =%", None, OLD, OLD, OLD), *first[1:]], key=repr
    )


def test_no_file_is_ever_replaced(spark, make, tmp_path):
    path = tmp_path / "control"
    files = lambda: {f: f.stat().st_mtime_ns for f in path.glob("*/*.parquet")}
    ensure_control(spark, str(path))
    upsert_control(make("control", [("s", f"t{i}", None, OLD, OLD, OLD) for i in range(500)]), str(path))
    before = files()
    upsert_control(make("control", [("s", "t7", None, OLD, AS_OF, NEW)]), str(path))
    after = files()
    assert before.items() < after.items()
    upsert_control(make("control", []), str(path))
    assert files() == after
    stored = {r[1]: r[5] for r in rows(read_control(spark, str(path)))}
    assert len(stored) == 500 and stored["t7"] == NEW and stored["t8"] == OLD


def test_rows_without_a_marker_are_not_seen(spark, make, tmp_path):
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    upsert_control(make("control", STORED), path)
    lost = make("control", [("s", "x", None, OLD, AS_OF, NEW), ("s", "lost", None, OLD, AS_OF, NEW)])
    lost.withColumn("commit_id", F.lit("lost")).write.mode("append").parquet(f"{path}/rows")
    assert rows(read_control(spark, path)) == sorted(STORED, key=repr)


def test_a_key_counts_once_also_when_null_or_repeated(spark, make, tmp_path):
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    for _ in range(2):
        twice = [("s", None, None, OLD, OLD, OLD), ("s", "x", None, OLD, OLD, OLD), ("s", "x", None, OLD, AS_OF, NEW)]
        upsert_control(make("control", twice), path)
    assert rows(read_control(spark, path)) == sorted([twice[0], twice[2]], key=repr)


def test_compaction_keeps_the_current_rows(spark, make, tmp_path):
    path, to = str(tmp_path / "control"), str(tmp_path / "compact")
    ensure_control(spark, path)
    upsert_control(make("control", STORED), path)
    upsert_control(make("control", [("s", "x", None, OLD, AS_OF, NEW)]), path)
    compact_control(spark, path, to)
    assert rows(read_control(spark, to)) == rows(read_control(spark, path))


def test_whole_feed_reads_beyond_its_mark_and_never_goes_back(spark, make):
    key = {"source": ("meta", "feed")}
    stored = [("meta", "feed", None, OLD, OLD, NEW)]
    assert move(spark, make, stored, [("a", "s", "x", OLD)], **key) == [("meta", "feed", None, OLD, AS_OF, NEW)]
    later = move(spark, make, [("meta", "feed", None, OLD, OLD, OLD)], FEED, **key)
    assert later == [("meta", "feed", None, OLD, AS_OF, NEW)]


def test_cutoff_never_moves_a_mark_back(spark, make):
    stored = [("s", "x", None, OLD, OLD, NEW)]
    got = move(spark, make, stored, FEED, cutoff=ts("2000-06-01"))
    assert ("s", "x", None, OLD, AS_OF, NEW) in got


def test_upsert_may_read_the_table_it_writes(spark, make, tmp_path):
    path = str(tmp_path / "control")
    ensure_control(spark, path)
    upsert_control(make("control", STORED), path)
    moved = next_control(read_control(spark, path), make("change_feed", FEED), gate(spark, True), AS_OF)
    upsert_control(moved, path)
    assert rows(read_control(spark, path)) == move(spark, make, STORED, FEED)


def test_catalog_table_follows_the_files(spark, make, tmp_path):
    path = str(tmp_path / "it's control")
    listed = lambda: rows(spark.table("ops.control").select(*read_control(spark, path).columns))
    for _ in range(2):
        ensure_control(spark, path, "ops.control")
    upsert_control(make("control", STORED), path)
    assert listed() == sorted(STORED, key=repr)
    spark.sql("DROP VIEW ops.control")
    ensure_control(spark, path, "ops.control")
    assert listed() == sorted(STORED, key=repr)
    spark.sql("DROP VIEW ops.control")
    spark.sql("DROP SCHEMA ops")
