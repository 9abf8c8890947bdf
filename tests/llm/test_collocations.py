"""Collocations against a plain count, with low thresholds so that all branches are reached."""

import re
from collections import Counter

import numpy as np
import pytest

from highwater.llm import collocations as op

SCHEMA = "text string, lang string"


def plain(rows, least, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    covered = set()
    for (lang, w), c in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and c >= f[lang, w[i:j]]:
                    covered.add((lang, w[i:j]))
    out = []
    for lang in n:
        found = []
        for (of, w), a in candidates.items():
            if of == lang and (lang, w) not in covered:
                cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(seed, rows=150, vocabulary=40):
    rng = np.random.default_rng(seed)
    base = [*"abcdefgh", "A", "é", "ﬀ", "\x01x", "x\x1f", "😀", " ", *(f"w{k}" for k in range(vocabulary))]
    out = []
    for _ in range(rows):
        picked = rng.zipf(1.4, 60).clip(1, len(base)) - 1
        joins = rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n"], 60, p=[0.8, 0.04, 0.04, 0.03, 0.03, 0.03, 0.03])
        out.append(("".join(base[w] + j for w, j in zip(picked, joins, strict=True)), [None, "und", "en", "xx"][rng.integers(4)]))
    out += [("one two three four five six", "en")] * 30 + [("hot cold. " * 500, "en")] * 3 + [(None, "en"), ("", None), (" \t", "yy")]
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("least", "longest", "top"), [(3, 5, 50), (20, 5, 2000), (5, 2, 10)])
def test_matches_plain_counts(spark, seed, least, longest, top):
    rows = made(seed)
    got = op.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), least, longest, top).collect()
    want = plain(rows, least, longest, top)
    assert sorted(map(tuple, got)) == want and len(want) > 3


def test_small_buffers_and_many_ranges(spark, monkeypatch):
    """Tasks hand on partial sums, and one word's phrases lie in several ranges."""
    monkeypatch.setattr(op, "FLUSH", 50)
    monkeypatch.setattr(op, "partitions", lambda _: 40)
    rows = [(" ".join(f"the w{k % 7} w{k % 5} w{k % 3}" for k in range(j, j + 60)), "en") for j in range(30)]
    got = op.collocations(spark.createDataFrame(rows, SCHEMA), 3, 5, 2000).collect()
    assert sorted(map(tuple, got)) == plain(rows, 3, 5, 2000)


def test_a_full_field_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(op.Field, "has", lambda self, places: np.ones(len(places), bool))
    rows = made(3, 40)
    got = op.collocations(spark.createDataFrame(rows, SCHEMA), 4, 5, 100).collect()
    assert sorted(map(tuple, got)) == plain(rows, 4, 5, 100)


def test_field_has_all_frequent_phrases(spark):
    phrases = [("en", f"a{k} b{k % 7}") for k in range(70_000)]
    field = op.field_of(spark.createDataFrame(phrases, "lang string, phrase string"), 2)
    import pyarrow as pa

    place = op._mark(field.bits, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([p[0] for p in phrases]), pa.array([p[1] for p in phrases])], ["l", "p"])
    places = next(place([batch])).column(0).to_numpy()
    assert field.has(places).all()
    assert field.has(np.arange(field.bits)).sum() == len(set(places.tolist()))


def test_products_beyond_64_bits(spark):
    """Counts as of 10^14 words: 1000 * a * n has 31 digits."""
    n, a, left, right = 10**14 + 7, 10**13 + 3, 3 * 10**13 + 1, 2 * 10**13 + 9
    rows = spark.createDataFrame([("en", "x y", a, [left], [right], n)], "lang string, phrase string, a bigint, heads array<bigint>, tails array<bigint>, n bigint")
    from pyspark.sql import functions as F

    assert rows.select(F.expr(op._LOWEST).alias("c")).first().c.score == 1000 * a * n // (left * right)


def test_ties_go_to_the_first_cut(spark):
    rows = spark.createDataFrame([("en", 5, [10, 5], [5, 10], 100)], "lang string, a bigint, heads array<bigint>, tails array<bigint>, n bigint")
    from pyspark.sql import functions as F

    # Cuts: 10 * 10 and 5 * 5; the first has the lower score. With equal products the first cut wins.
    assert rows.select(F.expr(op._LOWEST).alias("c")).first().c.k == 1
    same = rows.selectExpr("a", "n", "array(10L, 5L) heads", "array(10L, 5L) tails")
    assert same.select(F.expr(op._LOWEST).alias("c")).first().c.k == 1


def test_empty_and_clashing_names(spark):
    assert op.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    names = f"{SCHEMA}, phrase string, words string, f string, n string"
    got = op.collocations(spark.createDataFrame([("a b", "en", *"wxyz")] * 4, names), 3)
    assert [tuple(r) for r in got.collect()] == [("en", 1, "a b", 4, 4, 4, 8, 2000)]
