"""Registry and run log from a database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A ``table`` or a ``query`` of a database, read by many tasks if a way to split it is given.

    ``partition_column`` splits the range between the bounds into even strides; the bounds only
    place the strides, rows beyond them are read too. ``predicates`` gives one task per
    condition and suits text keys or a column with a hot range; together they have to cover
    every row once. Filters and column choice made on the result run in the database. Times
    without zone stay so, unless ``properties`` say otherwise.
    """
    properties = {"preferTimestampNTZ": "true", **(properties or {})}
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    source = table if query is None else f"({query.strip().rstrip(';').rstrip()}) q"
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give either partition_column or predicates")
        return spark.read.jdbc(url, source, predicates=list(predicates), properties=properties)
    options = {"url": url, "dbtable": source, **properties}
    if partition_column is not None:
        split = {"lowerBound": lower_bound, "upperBound": upper_bound, "numPartitions": num_partitions}
        missing = [name for name, value in split.items() if value is None]
        if missing:
            raise ValueError(f"partition_column needs {', '.join(missing)}")
        options.update({"partitionColumn": partition_column, **{k: str(v) for k, v in split.items()}})
    return spark.read.format("jdbc").options(**options).load()
