"""The inputs of a refresh run, derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from highwater.functions.timestamps import NTZ, ntz
from highwater.operators.control import CONTROL_KEY
from highwater.operators.watermark import SOURCE_KEY
from highwater.plans.refresh import RefreshInputs
from highwater.settings import ManifestSettings, RefreshSettings

WATERMARK = datetime(1999, 1, 1)
EARLIER = datetime(1997, 3, 4, 5, 6, 7, 250000)
FEED_MARK = datetime(1998, 1, 1)  # the stored mark of the feed as a whole
LISTED_SCHEMA = "raw_o"
RUN_ID = "run-1"
SETTINGS = RefreshSettings(
    source="MAIN",
    subject_area="MAIN",
    batch_ids=("B1", "B2"),
    run_id=RUN_ID,
    as_of=datetime(2001, 6, 1),
    max_hours=2160,
    manifest=ManifestSettings(
        job_id=42,
        constants={"environment": "stg", "batch_id": "B1", "source_snapshot": "Current", "debug_mode": "False"},
    ),
)


# The columns in use, so that Spark need not open a file to learn them before a query is planned.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entity, schema and changed object."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    prefix = F.when(F.col("o_orderkey") % 2 == 0, "Cust").otherwise("cust")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(F.col("o_orderkey") % 89 != 0, F.concat(prefix, F.col("o_custkey").cast("string"))).alias("entity_id"),
        F.concat(F.lit("raw_"), F.lower("l_linestatus")).alias("schema_name"),
        F.nullif(
            F.concat(F.lit("t_"), "l_returnflag", F.col("l_linenumber").cast("string")), F.lit("t_N1")
        ).alias("object_name"),
        F.col("l_shipdate").cast(NTZ).alias("updated"),
    )


def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schemas and two or three rows in different case forms per entity."""
    variants = [("Cust", 0), ("cust", 30), ("cust", 60)]
    step = F.col("c_custkey") + (F.col("v.shift") / 30).cast("bigint")
    day = F.date_add(
        F.lit("1995-01-01").cast("date"), ((F.col("c_custkey") * 37 + F.col("v.shift")) % 2500).cast("int")
    ).cast(NTZ)
    time = F.make_dt_interval(hours=F.lit(12), mins=F.lit(34), secs=F.lit("56.789").cast("decimal(18,6)"))
    return (
        table(spark, sf_dir, "customer")
        .withColumn("schema_name", F.explode(F.array(F.lit("raw_f"), F.lit("raw_o"))))
        .withColumn(
            "v",
            F.explode(
                F.array(
                    *[F.struct(F.lit(p).alias("prefix"), F.lit(s).alias("shift")) for p, s in variants]
                )
            ),
        )
        .where((F.col("v.shift") != 60) | (F.col("c_custkey") % 5 == 0))
        .select(
            F.concat("v.prefix", F.col("c_custkey").cast("string")).alias("entity_id"),
            "schema_name",
            F.when(F.col("c_acctbal").between(0, 500), None)
            .otherwise(F.col("c_acctbal") > 0)
            .alias("ready_for_processing"),
            (F.col("c_mktsegment") != "FURNITURE").alias("data_available"),
            F.when(F.col("c_nationkey") % 5 == 0, "OTHER").otherwise("MAIN").alias("source"),
            F.when(step % 3 == 0, None).otherwise(step % 3 == 1).alias("migrated"),
            F.when(F.col("c_custkey") % 4 == 0, day + time).otherwise(day).alias("updated"),
        )
    )


def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch B1 holds most entities, B2 some of them again with other flags, B3 belongs to another run."""
    key = F.col("c_custkey")
    batch = F.explode(F.array(F.lit("B1"), F.lit("B2"), F.lit("B3")))
    first, again = F.col("batch_id") == "B1", F.col("batch_id") == "B2"
    held = F.when(first, key % 7 != 0).when(again, (key % 7 != 0) & (key % 5 == 0)).otherwise(key % 3 == 0)
    off = F.when(first, key % 11 == 0).otherwise(key % 2 == 0)
    return (
        table(spark, sf_dir, "customer")
        .withColumn("batch_id", batch)
        .where(held)
        .select(
            F.when(key % 97 != 0, F.concat(F.lit("CUST"), key.cast("string"))).alias("entity_id"),
            "batch_id",
            F.when(off, "N").otherwise("Y").alias("active_flag"),
        )
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    ordered = F.col("o_orderdate").cast(NTZ)
    return table(spark, sf_dir, "orders").select(
        F.when(
            F.col("o_orderkey") % 97 != 0, F.concat(F.lit("CUST"), F.col("o_custkey").cast("string"))
        ).alias("entity_id"),
        F.when(status == "F", "FAILED").when(status == "O", "COMPLETED").otherwise("STARTED").alias("batch_status"),
        F.when(priority == "1-URGENT", "COMPLETED").otherwise("RUNNING").alias("job_status"),
        F.when(priority == "5-LOW", "OTHER").otherwise("MAIN").alias("subject_area"),
        ordered.alias("batch_start_ts"),
        F.when(F.col("o_orderkey") % 13 == 0, None).otherwise(ordered).alias("src_refresh_ts"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (schema, object) that the change feed names; read without the join behind the feed."""
    flagged = F.concat(F.lit("t_"), "l_returnflag", F.col("l_linenumber").cast("string"))
    named_object = F.coalesce(F.nullif(flagged, F.lit("t_N1")), F.lit(""))
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.concat(F.lit("raw_"), F.lower("l_linestatus")).alias("schema_name"),
            named_object.alias("object_name"),
        )
        .distinct()
    )


def listed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of one schema."""
    return sources(spark, sf_dir).where(F.col("schema_name") == LISTED_SCHEMA)


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a stored watermark (of several dates), with a null one, and without a row.

    One stored key has no change in the feed, and one is that of the feed as a whole.
    """
    stamp, name = ntz(WATERMARK), F.col("object_name")
    days = (F.ascii(F.right(name, F.lit(1))) % 7).cast("int")
    quiet = spark.createDataFrame(
        [("raw_o", "t_quiet"), SETTINGS.change_source], "schema_name string, object_name string"
    )
    return (
        sources(spark, sf_dir)
        .where(~F.col("object_name").startswith("t_R"))
        .unionByName(quiet)
        .select(
            *[F.col(s).alias(c) for s, c in zip(SOURCE_KEY, CONTROL_KEY)],
            F.when(name == "t_N3", "cust1").alias("entity_id"),
            stamp.alias("created_timestamp"),
            stamp.alias("updated_timestamp"),
            F.when(name == "t_N2", ntz(EARLIER))
            .when(name == SETTINGS.change_source[1], ntz(FEED_MARK))
            .when(name != "t_A1", stamp - F.make_dt_interval(days=days))
            .alias("last_modified_datetime"),
        )
    )


def dispatch_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("CUST"), F.col("user_id").cast("string")).alias("entity_id"),
        F.col("ts").cast(NTZ).alias("attempted_at"),
        F.col("event_id").alias("attempt_id"),
        F.when(kind.isin("click", "purchase"), 200)
        .when(kind == "view", 503)
        .when(kind == "signup", 429)
        .when(F.col("event_id") % 4 != 0, 400)
        .alias("status_code"),
    )


def record_attempts(manifest: DataFrame) -> DataFrame:
    """Answers to every record of a manifest: some are told to wait first, then all are accepted."""
    answers = F.when(F.length("entity_id") % 2 == 0, F.array(F.lit(503), F.lit(200))).otherwise(F.array(F.lit(200)))
    return manifest.select(
        "entity_id", "schema_name", F.posexplode(answers).alias("attempt_id", "status_code")
    ).withColumn("attempted_at", ntz(SETTINGS.as_of))


def inputs(spark: SparkSession, sf_dir: str) -> RefreshInputs:
    return RefreshInputs(
        change_feed(spark, sf_dir),
        readiness(spark, sf_dir),
        run_registry(spark, sf_dir),
        run_log(spark, sf_dir),
        control(spark, sf_dir),
    )
