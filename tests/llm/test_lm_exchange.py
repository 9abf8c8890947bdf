"""The packed exchange of counts against plain counters, and the model behind the score."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from highwater.llm import lm_score as op

SCHEMA = "doc_id bigint, text string"


def texts(n=60, seed=4):
    rng = np.random.default_rng(seed)
    out = [" ".join(f"w{k}" for k in rng.zipf(1.5, rng.integers(0, 40)).clip(1, 50)) for _ in range(n)]
    return [*out, "", "one two three", "one two three", "hot hot " * 200]


def chunk_rows(numbered, group):
    columns = {
        "doc_id": pa.array([i for i, _ in numbered], pa.int64()),
        "grp": pa.array([group] * len(numbered), pa.int32()),
        "n_bytes": pa.array([len(t) for _, t in numbered], pa.int64()),
        "th": pa.array([hash(t) % 2**40 for _, t in numbered], pa.int64()),
        "text": pa.array([t for _, t in numbered]),
    }
    return pa.table(columns)


@pytest.fixture
def code():
    nodes, bits, lengths = op._huffman(np.ones(op.SINGLES + op.SHAPES, int))
    none = np.full(1, -1)
    return op.Code(op.Index(np.empty(0, np.uint64)), none, nodes, bits, lengths, np.zeros(len(lengths)), 0, 0)


@pytest.fixture
def table(code):
    return op.Table(np.zeros((len(code.lengths), op.CONTEXTS), np.float32), np.zeros((op.CONTEXTS, 4, 2), np.float32))


@pytest.mark.parametrize(("lead", "bits", "width"), [(1, 42, 3), (3, 50, 4), (6, 58, 1)])
def test_counts_of_many_chunks(code, table, lead, bits, width):
    names = op.Names(lead, bits, width)
    numbered = list(enumerate(texts()))
    folds = {i: min(i % 5, 1) for i, _ in numbered}  # every fifth is held out
    parts = [chunk_rows(numbered[k::5], op.HELD_OUT if k == 0 else op.OTHERS) for k in range(5)]
    asked = [(b, k, *rest) for k, t in enumerate(parts) for b, *rest in op.Chunk(t, names).questions()]
    assert {b for b, *_ in asked} == set(range(1 << lead))
    replies, vocabulary = [[] for _ in parts], {}
    for bucket in range(1 << lead):
        rows = [a for a in asked if a[0] == bucket]
        columns = ("words", "shapes", "word_c", "grams", "gram_c")
        t = pa.table(
            {
                "bucket": pa.array([bucket] * len(rows), pa.int32()),
                "grp": pa.array([op.OTHERS] * len(rows), pa.int32()),
                "chunk": pa.array([r[1] for r in rows], pa.int32()),
                **{c: pa.array([r[2 + i] for r in rows], pa.binary()) for i, c in enumerate(columns)},
            }
        )
        for r in op._reply(names)(t).to_pylist():
            if r["grp"] == op.VOCABULARY:
                batch = pa.RecordBatch.from_pylist([{c: r[c] for c in ("words", "shapes", "word_c")}])
                for word in next(op._vocabulary([batch])).to_pylist():
                    vocabulary[word["h"]] = word["c"]
            else:
                replies[r["chunk"]].append({c: r[c] for c in ("bucket", "words", "grams")})

    # Plainly: what follows what, in training texts.
    lists = {i: [*t.split(), None] for i, t in numbered}
    one, two, three = Counter(), Counter(), Counter()

    def grams(ws):
        padded = ["^", "^", *ws]
        return list(zip(padded[1:], ws, strict=False)), list(zip(padded, padded[1:], ws, strict=False))

    for i, ws in lists.items():
        if folds[i]:
            pairs, triples = grams(ws)
            one.update(ws)
            two.update(pairs)
            three.update(triples)
    assert sorted(vocabulary.values()) == sorted(one.values())
    for t, answers in zip(parts, replies, strict=True):
        chunk = op.Chunk(t, names, code, table)
        schema = pa.schema([("bucket", pa.int32()), ("words", pa.binary()), ("grams", pa.binary())])
        chunk.answer(pa.Table.from_pylist(answers[::-1], schema))
        at = 0
        for i in chunk.rows["doc_id"].to_pylist():
            ws = lists[i]
            pairs, triples = grams(ws)
            mine = [Counter(x) if folds[i] else Counter() for x in (ws, pairs, triples)]
            seen = one[None] - mine[0][None]
            for k, w in enumerate(ws):
                assert chunk.count[at] == one[w] and chunk.others[at] == one[w] - mine[0][w]
                assert chunk.pair[at] == two[pairs[k]] - mine[1][pairs[k]]
                assert chunk.triple[at] == three[triples[k]] - mine[2][triples[k]]
                if k == 0:
                    assert chunk.one[at] == chunk.two[at] == seen
                else:
                    assert chunk.one[at] == one[ws[k - 1]] - mine[0][ws[k - 1]]
                    assert chunk.two[at] == two[pairs[k - 1]] - mine[1][pairs[k - 1]]
                at += 1
        assert at == len(chunk.owner)


def test_small_counts_take_a_byte():
    counts = np.array([0, 1, 254, 255, 256, 10**12, 3])
    data = op._coded(counts)
    assert len(data) == 7 + 3 * 8 and (op._decoded(data, 7) == counts).all()


@pytest.mark.parametrize("width", [1, 3, 5])
def test_sorted_names_are_sent_by_their_gaps(width):
    names = op.Names(4, 50, width)
    rng = np.random.default_rng(width)
    for n in (0, 1, 500):
        ids = np.unique(rng.integers(3 << 46, 4 << 46, n, dtype=np.uint64))
        assert (names.unpacked(names.packed(ids, 3), 3) == ids).all()
    ids = np.arange(3 << 46, (3 << 46) + 1000, dtype=np.uint64)
    assert len(names.packed(ids, 3)) == 8 + 1000 * width


def test_names_grow_with_the_corpus():
    for tokens in (0, 10**6, 10**9, 10**12):
        names = op.Names.of(tokens)
        assert 2 * tokens * op.COLLISION <= 2**names.bits and names.lead < names.bits <= 64
    assert op.Names.of(10**8).width == 3


def test_shares_make_the_tokens_likeliest():
    """Of a level's tokens 30 of 40 are foretold four times as well as before: the best share by search."""
    held = np.zeros((op.LEVELS * op.LEVELS, op.BINS))
    held[5, op.BINS // 2 + 4], held[5, 0] = 30, 10
    share = op.likeliest_shares(held.ravel())[5]
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax(30 * np.log(grid * 4 + 1 - grid) + 10 * np.log(1 - grid))]
    assert share == pytest.approx(best, abs=2e-3)


def test_chunks_and_buckets_do_not_change_the_score(spark, monkeypatch):
    frame = spark.createDataFrame(list(enumerate(texts(120))), SCHEMA).repartition(4)
    whole = {r.doc_id: r for r in op.score_documents(frame).collect()}
    monkeypatch.setattr(op, "CHUNK", 900)
    monkeypatch.setattr(op, "BUCKET", 500)
    for r in op.score_documents(frame).collect():
        assert r.score == pytest.approx(whole[r.doc_id].score, rel=1e-6)
        assert (r.n_known, r.n_tokens, r.base_score) == (whole[r.doc_id].n_known, whole[r.doc_id].n_tokens, pytest.approx(whole[r.doc_id].base_score))


def test_sums_are_what_the_bits_of_all_observations_give(spark):
    """Sums by context on Spark against a walk over the code, observation by observation."""
    rng = np.random.default_rng(2)
    nodes, bits, lengths = op._huffman(rng.integers(1, 50, op.SINGLES + op.SHAPES))
    code = op.Code(None, None, nodes, bits, lengths, None, 0, 0)
    keys, plain = [], Counter()
    for _ in range(400):
        class_, guide, group, run = (int(rng.integers(0, n)) for n in (30, 3, 4, 4))
        repeats, fold, c = int(rng.integers(0, 2)), int(rng.integers(0, 2)), int(rng.integers(1, 9))
        key = (((((0 if repeats else class_) * (op.GUIDES + 1) + guide) * op.GROUPS + group) * 4 + run) * 2 + repeats) * 2 + fold
        keys.append((key, c))
        both = guide * op.GROUPS + group
        plain[fold, both, run, op.REPEAT_NODE, repeats] += c
        if not repeats:
            for d in range(lengths[class_]):
                plain[fold, both, 0, int(nodes[class_, d]), int(bits[class_, d])] += c

    class Held:
        value = code

    got = Counter()
    frame = pa.table({"key": [k for k, _ in keys], "c": [c for _, c in keys]})
    contexts = np.array([k for k, _ in keys]) // 16 % op.CONTEXTS
    for both in np.unique(contexts):
        part = frame.filter(pa.array(contexts == both))
        for r in op._expanded(Held)((), part).to_pylist():
            for bit, c in ((1, r["one"]), (0, r["zero"])):
                got[r["fold"], r["both"], r["run"], r["node"], bit] += c
    assert {k: v for k, v in got.items() if v} == {k: float(v) for k, v in plain.items()}
    assert math.isclose(sum(got.values()), sum(plain.values()))
