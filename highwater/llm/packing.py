"""Operator 6: best-fit packing of documents into token sequences under several capacities.

A piece is a vector: its tokens, one document, and the cost of attention over it (the square of its tokens).
A sequence has what is left of each capacity. Pieces are placed by falling size into the open sequence
that fits under every capacity and scores best: the largest weighted dot product of piece and what is
left ("dot"), or the smallest norm of what would be left ("norm"). Pieces are dealt by a hash to groups
of about GROUP pieces, each packed in one task, so a group leaves one or two unfilled sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.llm.bpe import Ids
from highwater.llm.common import ship
from highwater.llm.words import chunks

TOKENS = 2048
MAX_DOCUMENTS = TOKENS  # no limit beyond that of the tokens, since a document has one at least
ATTENTION = TOKENS * TOKENS
WEIGHTS = (1.0, 0.05, 0.05)
GROUP = 8192
END = 0


def _pieces(limit: int, path):
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        encoder = Ids(path)
        for batch in batches:
            for part, texts in chunks(batch):
                rows = ([], [], [], [], [])
                for id_, text in zip(part.column(0).to_pylist(), texts.to_pylist(), strict=True):
                    data = encoder.encode(text or "") + end
                    n = len(data) // 4
                    start, piece = 0, 0
                    while start < n:
                        length = (n - start) % limit or limit  # only the first may be shorter
                        crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                        for column, value in zip(rows, (id_, piece, start, length, crc), strict=True):
                            column.append(value)
                        start += length
                        piece += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[0], part.column(0).type),
                        pa.array(rows[1], pa.int32()),
                        *[pa.array(x, pa.int64()) for x in rows[2:]],
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def best_fit(lengths: np.ndarray, capacity, weights, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there. ``capacity``: tokens, documents, attention."""
    whole = np.array(capacity, float)
    weight = np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left = np.empty((len(lengths), 3))  # of the open sequences, as shares of the capacity
    name, used = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = open_ = 0
    smallest = np.array([lengths.min(initial=1), 1, int(lengths.min(initial=1)) ** 2]) / whole
    eps = 1e-12
    for i in order:
        n = int(lengths[i])
        need = np.array([n, 1, n * n]) / whole
        room = left[:open_]
        fits = np.flatnonzero((room >= need - eps).all(axis=1))
        if len(fits):
            room = room[fits]
            if rule == "dot":
                best = fits[np.argmax((room * need) @ weight)]
            else:
                best = fits[np.argmin(((room - need) ** 2) @ weight)]
        else:
            best, left[open_], name[open_] = open_, 1.0, opened
            used[open_] = 0
            open_, opened = open_ + 1, opened + 1
        sequence[i], offset[i] = name[best], used[best]
        used[best] += n
        left[best] -= need
        if (left[best] < smallest - eps).any():  # closed: nothing fits any more
            open_ -= 1
            left[best], name[best], used[best] = left[open_], name[open_], used[open_]
    return sequence, offset


def _pack(capacity, weights, rule):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit(t["length"].to_numpy(), capacity, weights, rule)
        ids = (t["bucket"].to_numpy().astype(np.int64) << 32) + sequence
        return t.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    return run


def cut_documents(docs: DataFrame, limit: int = TOKENS, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and an end, cut where too long."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(_pieces(limit, path), schema)


def pack(
    docs: DataFrame,
    limit: int = TOKENS,
    max_documents: int = MAX_DOCUMENTS,
    attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    path: str | None = None,
) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset.

    A null or empty text is one piece that holds only the end. Only documents of more than ``limit`` tokens
    are cut; full pieces have a sequence of their own. Repeated rows are packed each; a null id stays
    null. An empty table gives no rows; extra columns are not read.
    """
    pieces = materialise(cut_documents(docs, limit, path), "pieces")
    groups = max(1, -(-pieces.where(F.col("length") < limit).count() // GROUP))
    # The number of one piece among equal rows does not matter: any order packs the same lengths.
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int")
    full = F.col("length") == limit
    schema = f"{pieces.schema.simpleString()[7:-1]}, bucket: int, sequence_id: bigint, offset: bigint"
    capacity = (limit, max_documents, attention or limit * limit)
    packed = (
        pieces.where(~full)
        .withColumn("bucket", bucket)
        .groupBy("bucket")
        .applyInArrow(_pack(capacity, weights, rule), schema)
    )
    alone = (
        pieces.where(full)
        .withColumn("bucket", F.lit(-1))
        .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )
    return packed.unionByName(alone).drop("bucket")
