"""Catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class MissingTables(LookupError):
    """Some of the tables that a run needs do not exist."""

    def __init__(self, names: list[str]):
        super().__init__(f"tables not found: {', '.join(names)}")
        self.names = names


def require_tables(spark: SparkSession, *names: str) -> None:
    """Raise ``MissingTables`` with every name that the catalog does not know."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise MissingTables(missing)


def load_table(
    spark: SparkSession, name: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """A catalog table, with ``columns`` only those, renamed from its names to ours."""
    require_tables(spark, name)
    table = spark.table(name)
    if columns is None:
        return table
    return table.select(*[table[theirs].alias(ours) for theirs, ours in columns.items()])
