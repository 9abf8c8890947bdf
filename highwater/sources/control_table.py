"""The stored control table: rows are only ever added, and count once their commit is marked.

A commit writes its rows under a new id and then one marker. Readers take, for every key, the row of
the latest marked commit. A driver lost in between leaves rows that no marker names and nobody sees; no key
ever disappears, and no file is replaced. ``compact_control`` writes the current rows to a new folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from highwater.functions.lineage import materialise
from highwater.operators.control import CONTROL_KEY, STAMPS

CONTROL_SCHEMA = StructType(
    [
        StructField("schema_name", StringType()),
        StructField("table_name", StringType()),
        StructField("entity_id", StringType()),
        StructField("created_timestamp", TimestampNTZType()),
        StructField("updated_timestamp", TimestampNTZType()),
        StructField("last_modified_datetime", TimestampNTZType()),
    ]
)
STORED_SCHEMA = StructType([*CONTROL_SCHEMA, StructField("commit_id", StringType())])
COMMIT_SCHEMA = StructType(
    [
        StructField("commit_id", StringType()),
        StructField("run_id", StringType()),
        StructField("seq", LongType()),
        StructField("committed_at", TimestampNTZType()),
    ]
)
_PARTS = {"rows": STORED_SCHEMA, "commits": COMMIT_SCHEMA}
# The order among rows that one commit holds for a key: the newest mark wins.
_VALUES = ["last_modified_datetime", "updated_timestamp", "created_timestamp", "entity_id"]


def _part(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(_PARTS[name]).parquet(f"{path}/{name}")


def ensure_control(spark: SparkSession, path: str, table: str | None = None) -> None:
    """Make the control table if it is not there yet, with ``table`` as a view on its current rows."""
    for name, schema in _PARTS.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{name}")
    if table is None:
        return
    schema = table.rpartition(".")[0]
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    rows, commits = (f"parquet.`{path.replace('`', '``')}/{name}`" for name in _PARTS)
    values = ", ".join(f"latest.{c}" for c in ("entity_id", *STAMPS))
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {', '.join(CONTROL_KEY)}, {values} FROM ("
        f"SELECT {', '.join(CONTROL_KEY)}, max_by(struct({', '.join(('entity_id', *STAMPS))}), seq) AS latest "
        f"FROM {rows} JOIN {commits} USING (commit_id) GROUP BY {', '.join(CONTROL_KEY)})"
    )


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The current rows: of every key, the one of the latest marked commit."""
    marked = _part(spark, path, "commits").select("commit_id", "seq")
    latest = F.max_by(F.struct("entity_id", *STAMPS), "seq").alias("latest")
    return (
        _part(spark, path, "rows")
        .join(marked, "commit_id")
        .groupBy(*CONTROL_KEY)
        .agg(latest)
        .select(*CONTROL_KEY, "latest.*")
    )


def upsert_control(rows: DataFrame, path: str, run_id: str | None = None) -> None:
    """Replace exactly the keys that ``rows`` holds, once each; all other keys stay as they are.

    Of several rows with a key the one with the newest mark counts; null parts of a key are a key like
    others. ``rows`` may be derived from the same path: they are worked out and written aside first.
    Without rows nothing is written. One writer at a time: of two at once, both commits are kept and for
    a key that both hold either may count.
    """
    spark = rows.sparkSession
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA])
    folded = typed.groupBy(*CONTROL_KEY).agg(F.max(F.struct(*_VALUES)).alias("v")).select(*CONTROL_KEY, "v.*")
    new = materialise(folded.select(*CONTROL_SCHEMA.names), "control-rows")
    if new.isEmpty():
        return
    commit_id = uuid.uuid4().hex
    new.withColumn("commit_id", F.lit(commit_id)).write.mode("append").parquet(f"{path}/rows")
    mark_commit(spark, path, commit_id, run_id)


def mark_commit(spark: SparkSession, path: str, commit_id: str, run_id: str | None = None) -> None:
    """From here on readers see the rows of the commit."""
    last = _part(spark, path, "commits").agg(F.max("seq")).first()[0] or 0
    marker = [(commit_id, run_id, last + 1, datetime.now())]
    spark.createDataFrame(marker, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def compact_control(spark: SparkSession, path: str, to: str, run_id: str | None = None) -> None:
    """Write the current rows as one commit to a new folder; the old one stays as it is."""
    ensure_control(spark, to)
    upsert_control(read_control(spark, path), to, run_id)
