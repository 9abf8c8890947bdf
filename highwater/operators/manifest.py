"""The parameter records of the entities to run, and a report of all decisions."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.functions.text import line_of, list_text
from highwater.functions.timestamps import iso_text
from highwater.operators.decision import NEW, REFRESH
from highwater.settings import ManifestSettings

IDS_PER_LINE = 1000


def _no_clash(what: str, names: list[str]) -> None:
    """Spark does not tell upper from lower case in a name."""
    seen = Counter(name.lower() for name in names)
    twice = sorted(name for name, n in seen.items() if n > 1)
    if twice:
        raise ValueError(f"{what} named twice: {twice}")


def manifest(
    decisions: DataFrame, settings: ManifestSettings, run_id: str | None = None
) -> DataFrame:
    """One record per entity and schema to run, with the JSON payload to send.

    ``run_order`` is 0 for new entities and 1 for refreshed ones, which come after them. ``run_id``
    stands beside the payload and says which run made the record.
    """
    is_new = F.col("decision") == NEW
    computed = {
        "entity_id": F.col("entity_id"),
        "schema_name": F.col("schema_name"),
        "new_entity_flag": F.initcap(is_new.cast("string")),
        "migrated": F.initcap("migrated"),
        "object_list": list_text(F.col("object_list"), settings.list_style),
        "updated": iso_text(F.col("updated")),
    }
    constants = {name: F.lit(value).cast("string") for name, value in settings.constants.items()}
    sent = [settings.names.get(name, name) for name in computed]
    _no_clash("columns", ["run_order", "run_id", "payload", *computed, *constants])
    _no_clash("parameters", [*sent, *constants])
    records = decisions.where(F.col("decision").isin(NEW, REFRESH)).select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.when(is_new, 0).otherwise(1).alias("run_order"),
        *[c.alias(name) for name, c in computed.items()],
        *[c.alias(name) for name, c in constants.items()],
    )
    params = F.struct(
        *[F.col(f"`{name}`").alias(as_name) for name, as_name in zip(computed, sent)],
        *[F.col(f"`{name}`").alias(name) for name in constants],
    )
    payload = F.struct(F.lit(settings.job_id).alias("job_id"), params.alias("notebook_params"))
    return records.withColumn("payload", F.to_json(payload, {"ignoreNullFields": "false"}))


def summary(decisions: DataFrame, ids_per_line: int = IDS_PER_LINE) -> DataFrame:
    """Per decision the number of rows and all entity ids, sorted and comma-joined.

    A decision with more than about ``ids_per_line`` ids is spread over as many lines as it
    needs, so that no task gathers the whole list. ``n`` counts the whole decision.
    """
    entities = decisions.groupBy("decision", "entity_id").agg(F.count("*").alias("n_rows"))
    # At most one row per decision label, of which there are six: safe to broadcast at any scale.
    totals = entities.groupBy("decision").agg(
        F.sum("n_rows").alias("n"),
        F.ceil(F.count("*") / F.lit(ids_per_line)).cast("bigint").alias("lines"),
    )
    return (
        entities.join(F.broadcast(totals), "decision")
        .groupBy("decision", line_of(F.col("entity_id"), F.col("lines")).alias("line_no"), "n")
        .agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("entities"))
        .select("decision", "line_no", "n", "entities")
    )
