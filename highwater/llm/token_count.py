"""Operator 5: token counts. Only lengths leave the tasks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.llm.bpe import Encoder
from highwater.llm.common import ship
from highwater.llm.words import chunks

LIMIT = 1024


def _counts(path):
    def run(batches):
        encoder = Encoder(len, path)
        for batch in batches:
            for part, texts in chunks(batch):
                found = encoder.encode(t or "" for t in texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([sum(x) for x in found], pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``.

    ``path`` names the tokenizer file, on every host. Texts are handled in chunks of about equal bytes and cut
    at safe boundaries; a null or empty text has no tokens. Rows stay rows, whatever their ids; other
    columns are not read.
    """
    ship(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    slim = docs.select("doc_id", size.alias("n_bytes"), "text")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes bigint, n_tokens bigint"
    return slim.mapInArrow(_counts(path), schema).withColumn("over_limit", F.col("n_tokens") > limit)
