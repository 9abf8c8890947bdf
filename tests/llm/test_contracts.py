"""Contracts on inputs that the given tables do not hold: repeated rows, ragged vectors, many tiny texts."""

import numpy as np
import pytest

from highwater.llm import packing, sharding
from highwater.llm.sharding import shard_documents

SCHEMA = "doc_id bigint, text string"


def test_shards_cut_through_repeated_rows(spark):
    rows = [(1, "the same text, twenty-seven")] * 1600 + [(i, f"text {i}") for i in range(2, 402)]
    rows += [(None, None)] * 50 + [(None, "x")] * 3
    frame = spark.createDataFrame(rows, SCHEMA)
    got = shard_documents(frame.repartition(7)).collect()
    assert len(got) == len(rows)
    sizes, slots = np.zeros(16, int), [[] for _ in range(16)]
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sizes.max() - sizes.min() <= 2 * max(r["size"] for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    again = shard_documents(frame.repartition(3)).collect()
    counts = lambda found: sorted((str(r.doc_id), r["shard"]) for r in found)
    assert counts(again) == counts(got)


def test_repeats_are_numbered_without_gaps(spark):
    rows = [(h, 0, part, 5) for h in (1, 2, 3) for part in range(4) for _ in range(h * part)] + [(9, 9, 0, 5)]
    found = sharding.number_repeats(spark.createDataFrame(rows, "h bigint, id bigint, part int, size bigint")).collect()
    for h in (1, 2, 3, 9):
        numbers = sorted(r.k for r in found if r.h == h)
        assert numbers == list(range(sum(row[0] == h for row in rows)))


def test_a_sequence_holds_as_many_documents_as_tokens(spark):
    empty = spark.range(4096).selectExpr("id doc_id", "'' text")
    packed = packing.pack(empty)
    assert packed.select("sequence_id").distinct().count() == 2
    assert sorted(r.offset for r in packed.collect()) == sorted([*range(2048)] * 2)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_capacities_bind_in_several_groups(spark, monkeypatch, rule):
    """More than one group, and callers' limits on documents and attention hold."""
    monkeypatch.setattr(packing, "GROUP", 100)
    docs = spark.range(700).selectExpr("id doc_id", "repeat('word ', cast(id % 37 as int)) text")
    packed = packing.pack(docs, limit=64, max_documents=5, attention=1500, rule=rule).toPandas()
    assert len(packed) == 700
    for _, part in packed.sort_values("offset").groupby("sequence_id"):
        assert part.length.sum() <= 64 and len(part) <= 5 and (part.length**2).sum() <= 1500
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]]
