import pytest

from highwater.sources.jdbc import read_jdbc
from highwater.sources.tables import MissingTables, load_table, require_tables


def test_missing_tables_are_all_named(spark):
    spark.range(1).createOrReplaceTempView("there")
    require_tables(spark, "there")
    with pytest.raises(MissingTables) as error:
        require_tables(spark, "there", "gone_a", "gone_b")
    assert error.value.names == ["gone_a", "gone_b"]


def test_load_table_picks_and_renames(spark):
    spark.sql("SELECT 'a' AS account, 1 AS other").createOrReplaceTempView("accounts")
    assert load_table(spark, "accounts", {"account": "entity_id"}).columns == ["entity_id"]
    assert load_table(spark, "accounts").columns == ["account", "other"]


class Reader:
    """Records how the reader is set up; a database is not needed for that."""

    def __init__(self):
        self.calls = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def load(self):
        return self.calls

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "properties": properties}


URL = "jdbc:mysql://db/audit"
NTZ = {"preferTimestampNTZ": "true"}


def test_plain_table():
    got = read_jdbc(Reader(), URL, table="run_log", properties={"user": "u"})
    assert got == {"format": "jdbc", "options": {"url": URL, "dbtable": "run_log", **NTZ, "user": "u"}}


def test_query_becomes_a_subquery():
    assert read_jdbc(Reader(), URL, query=" SELECT 1 ; ")["options"]["dbtable"] == "(SELECT 1) q"


def test_partitioned_read():
    got = read_jdbc(
        Reader(), URL, table="run_log", partition_column="id", lower_bound=0, upper_bound=10, num_partitions=4
    )
    assert got["options"] == {
        "url": URL,
        "dbtable": "run_log",
        **NTZ,
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "10",
        "numPartitions": "4",
    }


def test_predicates():
    got = read_jdbc(Reader(), URL, table="run_log", predicates=["a = 1", "a <> 1 or a is null"])
    assert got["predicates"] == ["a = 1", "a <> 1 or a is null"]
    assert got["properties"] == NTZ


def test_properties_win_over_defaults():
    got = read_jdbc(Reader(), URL, table="run_log", properties={"preferTimestampNTZ": "false"})
    assert got["options"]["preferTimestampNTZ"] == "false"


def test_incomplete_or_double_split_is_refused():
    with pytest.raises(ValueError, match="lowerBound, upperBound"):
        read_jdbc(Reader(), URL, table="run_log", partition_column="id", num_partitions=4)
    with pytest.raises(ValueError):
        read_jdbc(Reader(), URL, table="run_log", partition_column="id", predicates=["a = 1"])
