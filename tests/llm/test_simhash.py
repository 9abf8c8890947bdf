"""SimHash fingerprints and components against brute force."""

import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from highwater.llm import queries as llm
from highwater.llm import simhash

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string"


def fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0d]+", low)
    shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    """The smallest id reachable over pairs at four bits or fewer."""
    fps = np.array(prints, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    root, seen = {}, set()
    for k in range(len(ids)):
        if k in seen:
            continue
        group, open_ = {k}, [k]
        while open_:
            for j in np.flatnonzero(near[open_.pop()]):
                if j not in group:
                    group.add(int(j))
                    open_.append(int(j))
        seen |= group
        least = min((ids[j] for j in group if ids[j] is not None), default=None)
        root.update(dict.fromkeys(group, least))
    return [root[k] for k in range(len(ids))]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = [fingerprint(r.text) for r in rows]
    want = plain_components([r.doc_id for r in rows], prints)
    got = llm.queries()["op11_simhash"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True))
    assert len(set(want)) < len(rows)


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (4, " \t\n"), (7, "One two"), (8, "one\ttwo"), (9, "a b c d"), (9, "a b c d"), (None, "x y")]
    rows += [(None, "x y"), (11, "ein zwei drei vier fünf " * 40_000), (12, "\x01 é")]
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    want = plain_components([r[0] for r in rows], [fingerprint(r[1]) for r in rows])
    expect = [(r[0], f"{fingerprint(r[1]):016x}", c) for r, c in zip(rows, want, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}


def test_empty_table_and_clashing_names(spark):
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0
    names = "doc_id bigint, text string, fp string, key string, node string, root string, part string"
    got = simhash.simhash_components(spark.createDataFrame([(1, "a b c d e", *"uvwxy"), (2, "A b c  d e", *"uvwxy")], names))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {r.component_id for r in got.collect()} == {1}


@pytest.mark.parametrize("block", [4, 64])
@pytest.mark.parametrize("spread", [2, 5, 9])
def test_families_under_hot_keys(spark, monkeypatch, block, spread):
    """Members of a ball share most keys; whatever the hub misses is still compared."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(spread)
    centre = rng.integers(0, 2**63)
    fps = {int(centre) ^ sum(1 << int(k) for k in rng.choice(64, spread, replace=False)) for _ in range(200)}
    # Two chains under one key: steps of four bits, all in the upper half.
    fps |= {int(x) << 40 for x in np.bitwise_xor.accumulate(rng.choice(2**24, 60))}
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    linked = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()
    got = {r.node: r.root for r in linked}
    want = plain_components(signed, fps)
    assert [got.get(f, f) for f in signed] == want


@pytest.mark.parametrize("blocks", range(6, 11))
def test_any_four_bits_leave_a_key(blocks):
    kept = simhash.masks(blocks)
    rng = np.random.default_rng(blocks)
    for _ in range(2000):
        flipped = sum(1 << int(k) for k in rng.choice(64, 4, replace=False))
        assert any(mask & flipped == 0 for mask in kept)


def test_more_fingerprints_get_more_blocks():
    assert [simhash.blocks_for(n) for n in (0, 10**6, 10**8, 10**9, 10**10)] == [6, 6, 7, 8, 9]
