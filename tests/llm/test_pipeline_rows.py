"""The rows of every stage of the pipeline over its own input, worked out a second time."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from highwater.functions.lineage import materialise
from highwater.llm import mixing
from highwater.llm import queries as llm
from highwater.llm.toxicity import score_toxicity
from tests.llm.test_line_passages import deduped

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of every stage, as the pipeline writes them."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def folder(df):
    """A pattern for the Parquet files behind a frame."""
    return {f.rpartition("/")[0].removeprefix("file:") for f in df.inputFiles()}.pop() + "/*.parquet"


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    scored = score_toxicity(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")).select("row.*", "predicted").collect()
    want = Counter(tuple(r[c] for c in COLUMNS) for r in scored if r.predicted == 0 or not r.text)
    assert rows(after) == want
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    gone = set(rows(before) - rows(after))
    toxic = [r for r in rows(before) if labels.get(r[0]) == 1]
    clean = [r for r in rows(before) if labels.get(r[0]) == 0]
    assert sum(r in gone for r in toxic) > 0.5 * len(toxic) and sum(r in gone for r in clean) < 0.1 * len(clean)  # some 270 labels


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    want = deduped([(r[0], r[1]) for r in rows(before).elements()])
    assert {r[0]: r[1] for r in rows(after)} == want
    assert Counter((r[0], *r[2:]) for r in rows(after).elements()) == Counter((r[0], *r[2:]) for r in rows(before).elements())


def test_ngram_jaccard(stages):
    before, after = stages["ngram_jaccard"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM read_parquet('{folder(before)}')")
    found = con.execute(llm.oracle_sql()["op1_ngram_jaccard"]).fetchall()
    first = {i for i, _, c in found if i == c}
    assert rows(after) == Counter({r: n for r, n in rows(before).items() if r[0] in first})
    assert len(first) < len(found)


def test_mixing(stages):
    before, after = stages["mixing"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW docs AS SELECT * FROM read_parquet('{folder(before)}')")
    taken = con.execute(
        f"SELECT doc_id, whole + CASE WHEN more THEN 1 ELSE 0 END AS n FROM ({mixing.ORACLE_MIXED.format(docs='docs')})"
    ).fetchall()
    times = dict(taken)
    want = Counter()
    for r, n in rows(before).items():
        want[r] += n * times[r[0]]
    assert rows(after) == +want


def test_packing(stages):
    before, after = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for (id_, text, *_), n in rows(before).items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        starts = [0, *range(first, len(ids), 2048)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[id_, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += n
    got = after.toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(got[names].itertuples(index=False, name=None)) == want
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 2048


def test_a_mix_of_repeated_ids_is_the_same_on_every_run(spark):
    """Rows with one id and size but other texts: which of them is taken must not depend on the partitions."""
    frame = spark.createDataFrame([(k % 3, f"word{k} " * 5, "s") for k in range(300)], "doc_id bigint, text string, source string")
    first, second = (Counter(r.text for r in mixing.mixed_copies(frame.repartition(n)).collect()) for n in (2, 7))
    assert first == second and re.match("word", next(iter(first)))
