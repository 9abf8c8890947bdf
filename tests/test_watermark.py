from pyspark.sql import functions as F

from highwater.operators.watermark import changed_since, read_watermarks, stored_watermark
from tests.conftest import rows, ts

FLOOR = ts("1990-01-01")


def control(make):
    day = ts("2000-01-01")
    return make(
        "control",
        [
            ("s", "known", None, day, day, ts("2000-05-05T01:02:03.000004")),
            ("s", "empty", None, day, day, None),
        ],
    )


def test_absent_and_null_watermarks_start_at_the_floor(make):
    sources = make("sources", [("s", "known"), ("s", "empty"), ("s", "absent"), ("s", "known")])
    assert rows(read_watermarks(sources, control(make))) == [
        ("s", "absent", FLOOR),
        ("s", "empty", FLOOR),
        ("s", "known", ts("2000-05-05T01:02:03.000004")),
    ]


def test_comparison_is_strict_and_null_is_not_newer(make):
    feed = make(
        "change_feed",
        [
            ("a", "s", "x", ts("2000-01-01")),
            ("b", "s", "x", ts("2000-01-01T00:00:00.000001")),
            ("c", "s", "x", None),
        ],
    )
    assert [r[0] for r in rows(changed_since(feed, ts("2000-01-01")))] == ["b"]


def test_each_row_meets_its_own_source(make):
    feed = make(
        "change_feed",
        [
            ("a", "s", "known", ts("2000-05-05")),
            ("b", "s", "known", ts("2000-05-06")),
            ("c", "s", "empty", ts("1995-01-01")),
            ("d", "s", None, ts("1995-01-01")),
            ("e", "s", "unlisted", ts("1995-01-01")),
            ("f", None, "known", ts("1989-12-31")),
            ("g", "s", "known", None),
        ],
    )
    marks = read_watermarks(make("sources", [("s", "known"), ("s", "empty")]), control(make))
    changed = changed_since(feed, marks)
    assert [r[0] for r in rows(changed)] == ["b", "c", "d", "e"]
    assert changed.columns == feed.columns


def test_stored_value_is_used_inside_the_plan(make):
    feed = make("change_feed", [("a", "s", "x", ts("2000-05-05")), ("b", "s", "x", ts("2000-05-06"))])
    by = lambda name: [r[0] for r in rows(changed_since(feed, stored_watermark(control(make), "s", name)))]
    assert by("known") == ["b"]
    assert by("empty") == ["a", "b"]
    assert by("absent") == ["a", "b"]


def test_zoned_times_are_compared_in_the_session_zone(spark, make):
    feed = make("change_feed", [("a", "s", "x", ts("2000-01-01")), ("b", "s", "x", ts("2000-01-02"))])
    zoned = feed.withColumn("updated", F.col("updated").cast("timestamp"))
    changed = changed_since(zoned, ts("2000-01-01"))
    assert changed.schema["updated"].dataType.simpleString() == "timestamp_ntz"
    assert rows(changed) == [("b", "s", "x", ts("2000-01-02"))]
