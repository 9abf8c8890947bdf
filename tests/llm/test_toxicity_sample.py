"""The bytes of the sample are shared out over classes and folds, so long texts of one do not crowd out the others."""

from highwater.llm import toxicity


def test_each_class_and_fold_has_its_part_of_the_bytes(spark, monkeypatch):
    assert (toxicity.SAMPLE, toxicity.SAMPLE_BYTES) == (2000, 16_000_000)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 12_000)
    rows = [(i, "x" * 1000 if i % 2 else "y" * 100, i % 2, 3 if i % 4 < 2 else 0) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    sample = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id bigint, toxic int, fold int")
    size = {}
    for r in toxicity._texts(docs, sample).collect():
        size[r.toxic, r.fold] = size.get((r.toxic, r.fold), 0) + len(r.text)
    assert 10_500 <= sum(size.values()) <= 12_000
    for toxic in (0, 1):
        assert 3000 <= size[toxic, 0] <= 4500 and 1000 <= size[toxic, 3] <= 2500
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 60_000)  # more than the short texts have: the rest goes to the long ones
    short = [r for r in toxicity._texts(docs, sample).collect() if r.toxic == 0]
    assert len(short) == 100
