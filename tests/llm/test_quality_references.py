"""References learnt from the corpus: distances by hand, and no verdict where there is no reference."""

import math
import random
from collections import Counter

import pytest

from highwater.llm import quality as op

SCHEMA = "doc_id bigint, text string, lang string"


def prose(draw, words, n):
    common, rare = words[:20], words[20:]
    return " ".join(draw.choice(common) if draw.random() < 0.5 else draw.choice(rare) + str(draw.randint(0, 99)) for _ in range(n))


def made():
    draw = random.Random(3)
    latin = [f"{a}{b}" for a in "bcdfghjk" for b in ("a", "en", "or", "ig", "ust")]
    cyrillic = [f"{a}{b}" for a in "бвгджзкл" for b in ("а", "ен", "ор", "иг", "уст")]
    rows = [(i, prose(draw, latin, 200), "nn") for i in range(30)]
    rows += [(100 + i, prose(draw, cyrillic, 300), lang) for i, lang in enumerate(["ru", None, "ru"])]
    rows += [(200, prose(draw, [w[::-1] + "q" for w in latin], 300), "nl")]
    rows += [(300, " ".join(f"{k}#$ {k * 7}&" for k in range(200)), "nn"), (301, prose(draw, cyrillic, 300), "nn")]
    rows += [(400, None, "nn"), (401, "", None), (402, "BEN ben", "nn")]
    return rows


def plain(rows):
    lists, refs = {}, {}
    split = {i: [w for w in (t or "").replace("\t", " ").split(" ") if w] for i, (_, t, _) in enumerate(rows)}
    for lang in {r[2] for r in rows}:
        mine = [i for i, r in enumerate(rows) if r[2] == lang]
        if lang is not None and len(mine) >= 20:
            count = Counter(w for i in mine for w in split[i])
            lists[lang] = sorted(count, key=lambda w: (-count[w], w.encode()))[:16]

    def histograms(i):
        text, top, n = rows[i][1] or "", lists[rows[i][2]], Counter(split[i])
        kinds = [sum("a" <= c <= "z" for c in text), sum("A" <= c <= "Z" for c in text), sum(c in "0123456789" for c in text)]
        kinds += [sum(c in "#*$%&|<>" for c in text), sum(ord(c) >= 128 for c in text)]
        kinds.append(sum(map(len, split[i])) - sum(kinds))
        listed = [n[w] for w in top]
        return kinds, [*listed, len(split[i]) - sum(listed)]

    def shares(x):
        return [y / sum(x) if sum(x) else 0.0 for y in x]

    def distance(p, q):
        half = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        parts = sum(x * math.log2(x / m) for own in (p, q) for x, m in zip(own, half, strict=True) if x)
        return math.sqrt(max(0.0, parts / 2))

    for lang in lists:
        every = [histograms(i) for i, r in enumerate(rows) if r[2] == lang]
        refs[lang] = [shares([sum(x) for x in zip(*(h[k] for h in every), strict=True)]) for k in (0, 1)]
    out = {}
    for i, (id_, _, lang) in enumerate(rows):
        if lang in refs:
            out[id_] = tuple(distance(shares(h), r) for h, r in zip(histograms(i), refs[lang], strict=True))
        else:
            out[id_] = (None, None)
    return out


def test_distances_and_verdicts(spark):
    rows = made()
    got = {r.doc_id: r for r in op.quality(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    for id_, want in plain(rows).items():
        for mine, other in zip((got[id_].char_distance, got[id_].word_distance), want, strict=True):
            assert (mine is None) == (other is None)
            if mine is not None:
                assert mine == pytest.approx(other, abs=1e-6)
    assert all(got[i].kept for i in range(30))  # ordinary for its language
    assert all(got[i].kept and got[i].char_distance is None for i in (100, 101, 102, 200))  # no reference
    assert not got[300].kept and not got[300].base_failed  # codes and symbols
    assert not got[301].kept and got[301].char_distance > 0.35  # another script under this language's name
    assert got[400].base_failed and not got[402].kept and got[401].word_distance is None


def test_short_lists_have_fewer_bins(spark):
    rows = [(i, "one two three " * 40, "xx") for i in range(25)] + [(99, "three " * 60 + "four " * 60, "xx")]
    got = {r.doc_id: r for r in op.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = plain(rows)
    assert all(got[i].word_distance == pytest.approx(want[i][1], abs=1e-6) for i, _, _ in rows)
