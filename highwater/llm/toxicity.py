"""Operator 8: toxicity by class-conditional Kneser-Ney models.

An expression is a word, spelled in characters; a very long one (a text without spaces) is taken in
pieces. For each class, toxic and ordinary, a Kneser-Ney model
gives the probability of the next character after up to ORDER - 1 others; the longest context uses the
counts of the class, and all shorter ones the continuation counts of both classes together, so that a
rare or unseen expression is judged by what both share. Both log-likelihoods of every expression are
normalised by its length and compared. Two neighbouring words are an expression as well, of the second word after the
first, by the same rule: the counts of the class for the pair, for all that is rare the continuation counts of both
classes together. So words that are harmless one by one can be toxic in this order. A document's features are its
strongest expressions of either kind, the mean over its words and how many are strong; a logistic curve fitted on
other labelled documents makes them a score.

The models are learnt from a bounded sample of labelled documents (SAMPLE per class, in the order of a
hash, none of more than LARGEST bytes and at most SAMPLE_BYTES together, shared out evenly over the classes);
scoring covers every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.llm.common import release, ship
from highwater.llm.words import Index, Words, chunks, mix, words

FOLDS = 4
HELD_OUT = 2
FIT = 3  # the fold whose labels fit the curve; the models count the others
SAMPLE = 2000
SAMPLE_BYTES = 16_000_000
LARGEST = 750_000  # so that no single document takes up the sample
ORDER = 6
DISCOUNT = 0.75
THRESHOLD = 0.3
PART = 20_000  # expressions that are taken apart at once
LONGEST = 48  # bytes of an expression; a longer word is several
PAIR_DOCUMENTS = 5  # of the sample that have a pair, before it counts
STRONG, STRONG_PAIR = 0.3, 1.0
FEATURES = 6


@dataclass
class Model:
    """Log-likelihood ratio of expressions. Per order: hashes of n-grams and contexts, and counts; for pairs of words
    that speak for toxicity, their hashes and ratios, with 0 last for all others."""

    grams: list[tuple]
    pairs: Index
    gains: np.ndarray
    weights: np.ndarray | None = None
    scale: np.ndarray | None = None


def _spell(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Expressions as rows of bytes: 1 before, 2 after, 0 beyond."""
    wide = int(lengths.max(initial=0)) + 2
    out = np.zeros((len(starts), wide), np.uint8)
    out[:, 0] = 1
    at = np.arange(wide - 2)
    inside = at < lengths[:, None]
    rows, columns = np.nonzero(inside)
    out[rows, columns + 1] = data[starts[rows] + columns]
    out[np.arange(len(starts)), lengths + 1] = 2
    return out


def _hashes(spelled: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, context hash and n-gram hash of every n-gram of ``order`` that ends at a character.

    Near the start of an expression the context is all that stands before.
    """
    n, wide = spelled.shape
    rows, ends = np.nonzero(spelled[:, 1:])
    ends = ends + 1
    context = np.full(len(rows), order, np.uint64)
    for back in range(order - 1, 0, -1):
        at = ends - back
        value = np.where(at >= 0, spelled[rows, np.maximum(at, 0)], 0).astype(np.uint64)
        context = mix(context * np.uint64(0x9E3779B97F4A7C15) + value)
    gram = mix(context * np.uint64(0xC2B2AE3D27D4EB4F) + spelled[rows, ends])
    return rows, context, gram


def _distinct(key: np.ndarray, context: np.ndarray, gram: np.ndarray, weight: np.ndarray) -> tuple:
    """One row per key, its weights summed."""
    key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    sums = [np.bincount(inverse, weight[:, k], len(key)) for k in range(weight.shape[1])]
    return key, context[first], gram[first], np.stack(sums, axis=1)


def _ngrams(spelled: np.ndarray, counts: np.ndarray, order: int) -> tuple:
    """Context, n-gram and counts of ``order``, worked out for PART expressions after the other.

    Below the longest order these are continuation counts: one for every distinct longer n-gram.
    """
    found = []
    for k in range(0, max(len(spelled), 1), PART):
        part = spelled[k : k + PART]
        rows, context, gram = _hashes(part, order)
        if order == ORDER:
            found.append(_distinct(gram, context, gram, counts[k : k + PART][rows].astype(float)))
        else:
            longer = _hashes(part, order + 1)[2]
            found.append(_distinct(longer, context, gram, np.ones((len(gram), 1))))
    _, context, gram, weight = _distinct(*[np.concatenate(x) for x in zip(*found)])
    return context, gram, weight if order == ORDER else np.ones_like(weight)


def learn(spelled: np.ndarray, counts: np.ndarray) -> Model:
    """From distinct expressions and their counts in ordinary and toxic documents (n, 2)."""
    grams = []
    for order in range(ORDER, 0, -1):
        context, gram, weight = _ngrams(spelled, counts, order)
        names, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
        of = context[first]
        contexts, back = np.unique(of, return_inverse=True)
        columns = [Index(names), Index(contexts)]
        for k in range(weight.shape[1]):
            count = np.bincount(inverse, weight[:, k])
            total = np.bincount(back, count)
            kinds = np.bincount(back, (count > 0).astype(float))
            columns += [np.append(x, 0.0) for x in (count, total, kinds)]  # the last: not found
        grams.append(tuple(columns))
    return Model(grams, Index(np.empty(0, np.uint64)), np.zeros(1))


def ratios(model: Model, spelled: np.ndarray) -> np.ndarray:
    """Toxic minus ordinary log-likelihood of each expression, over its number of characters."""
    below = None
    for order in range(1, ORDER + 1):
        names, contexts, *columns = model.grams[ORDER - order]
        rows, context, gram = _hashes(spelled, order)
        parts, gram, context = [], names.find(gram), contexts.find(context)
        for k in range(len(columns) // 3):
            count, total, kinds = columns[3 * k : 3 * k + 3]
            c, t, kind = count[gram], total[context], kinds[context]
            lower = np.full(len(rows), 1 / 256) if below is None else below
            seen = np.maximum(t, 1)
            p = (np.maximum(c - DISCOUNT, 0) + DISCOUNT * kind * lower) / seen
            parts.append(np.where(t > 0, p, lower))
        if order < ORDER:
            below = np.maximum(parts[0], 1e-12)
    gain = np.log(np.maximum(parts[1], 1e-12)) - np.log(np.maximum(parts[0], 1e-12))
    sums = np.bincount(rows, gain, minlength=len(spelled))
    return sums / np.maximum((spelled[:, 1:] > 0).sum(axis=1), 1)


class Memo:
    """Ratios of expressions by their hash, for as long as a task runs; starts anew when full."""

    FULL = 500_000

    def __init__(self):
        self.index, self.values = Index(np.empty(0, np.uint64)), np.empty(0)

    def ratios(self, model: Model, found: Words, names: np.ndarray, first: np.ndarray) -> np.ndarray:
        at = self.index.find(names)
        known = at < self.index.n
        value = np.empty(len(names))
        value[known] = self.values[at[known]]
        fresh = np.flatnonzero(~known)
        starts, lengths = found.starts[first[fresh]], (found.ends - found.starts)[first[fresh]]
        for k in range(0, len(fresh), 20_000):
            part = slice(k, k + 20_000)
            value[fresh[part]] = ratios(model, _spell(found.data, starts[part], lengths[part]))
        if self.index.n > self.FULL:
            self.__init__()
        old = self.index.keys[: self.index.n]
        at = np.searchsorted(old, names[fresh])  # both are sorted
        self.index = Index(np.insert(old, at, names[fresh]))
        self.values = np.insert(self.values, at, value[fresh])
        return value


def pairs_of(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words that have one after them in their text, and the hashes of both together."""
    first = np.flatnonzero(np.diff(found.owner) == 0)
    h = found.hashes
    return first, mix(h[first] * np.uint64(0x9E3779B97F4A7C15) + h[first + 1])


def features(model: Model, found: Words, memo: Memo) -> np.ndarray:
    """Per document: the strongest and second word, the mean, and how many are strong; the strongest pair, and how
    many of these are strong."""
    out = np.zeros((found.rows, FEATURES))
    if not len(found.hashes):
        return out
    names, first, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
    value = memo.ratios(model, found, names, first)
    value = value[inverse]
    owner, counts = found.owner, found.counts
    filled = counts > 0
    out[filled, 0] = np.maximum.reduceat(value, found.first[:-1][filled])
    # The second: the strongest expression that is not the first place of the strongest.
    top = np.flatnonzero(value == out[owner, 0])
    _, once = np.unique(owner[top], return_index=True)
    rest = value.copy()
    rest[top[once]] = -np.inf
    second = np.maximum.reduceat(rest, found.first[:-1][filled])
    out[filled, 1] = np.where(np.isfinite(second), second, out[filled, 0])
    out[:, 2] = np.bincount(owner, value, minlength=found.rows) / np.maximum(counts, 1)
    strong = np.bincount(owner, value > STRONG, minlength=found.rows)
    out[:, 3] = np.log1p(strong)
    places, names = pairs_of(found)
    at = model.pairs.find(names)
    known = np.flatnonzero(at < model.pairs.n)
    gain, of = model.gains[at[known]], owner[places[known]]
    np.maximum.at(out[:, 4], of, gain)
    out[:, 5] = np.log1p(np.bincount(of, gain > STRONG_PAIR, minlength=found.rows))
    return out


def fit(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    """A logistic curve over the features, by Newton's method with a small ridge."""
    model.scale = np.stack([x.mean(axis=0), x.std(axis=0) + 1e-9]) if len(x) else np.array([[0.0] * FEATURES, [1.0] * FEATURES])
    z = np.column_stack([np.ones(len(x)), (x - model.scale[0]) / model.scale[1]])
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-6] + [0.5] * FEATURES)
    if 0 < y.sum() < len(y):
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
            w += np.clip(np.linalg.solve(hessian, z.T @ (y - p) - ridge @ w), -2, 2)
    else:
        w[0] = -5.0  # nothing to tell the classes apart: nothing is toxic
    model.weights = w


def score(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.column_stack([np.ones(len(x)), (x - model.scale[0]) / model.scale[1]])
    return 1 / (1 + np.exp(-np.clip(z @ model.weights, -30, 30)))


def _fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _sample(labelled: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labels of each class: those with the smallest hash."""
    order = F.xxhash64("doc_id", F.lit(8))
    ranked = [
        labelled.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(limit) for c in (0, 1)
    ]
    return ranked[0].unionByName(ranked[1])


def _texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Texts of the sample's documents up to SAMPLE_BYTES, in the order of their hash.

    The bytes are dealt out to both classes alike, a third of them to the documents that fit the curve; what one
    does not need goes to the others. A document whose rows together have more than LARGEST bytes is passed over.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    picked = docs.select("doc_id", "text").where(size <= LARGEST)
    picked = materialise(picked.join(F.broadcast(sample), "doc_id"), "sample")  # bounded by the sample
    fits = (F.col("fold") == FIT).alias("fits")
    sizes = picked.groupBy("doc_id", "toxic", fits).agg(F.sum(size).alias("size")).where(F.col("size") <= LARGEST)
    order = [F.xxhash64("doc_id"), "doc_id"]
    own = F.sum("size").over(Window.partitionBy("toxic", "fits").orderBy(*order))
    sizes = sizes.withColumn("own", own * F.when(F.col("fits"), 2).otherwise(1))
    held = F.sum("size").over(Window.orderBy("own", *order))  # a row per sampled label
    within = sizes.withColumn("held", held).where(F.col("held") <= SAMPLE_BYTES).select("doc_id")
    return picked.join(F.broadcast(within), "doc_id")


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """Models and curve from ``labels`` (doc_id, toxic) of documents that are not held out."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").dropDuplicates(["doc_id"])
    labels = labels.withColumn("fold", _fold(F.col("doc_id"))).where(F.col("fold") != HELD_OUT)
    sample = _sample(labels.where(F.col("fold") != FIT), limit).unionByName(
        _sample(labels.where(F.col("fold") == FIT), limit // 2)
    )
    texts = _texts(docs, sample).select("doc_id", "fold", "toxic", "text")
    found = texts.toArrow()
    rows = found.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks().to_batches()
    del found
    model = learn(*_expressions(rows))
    release()
    strong = pair_gains(texts.where(F.col("fold") != FIT)).orderBy("pair").toArrow()  # bounded by the sample
    names, gains = strong["pair"].to_numpy().view(np.uint64), strong["gain"].to_numpy()
    order = np.argsort(names)
    model.pairs, model.gains = Index(names[order]), np.append(gains[order], 0.0)
    memo, x, y = Memo(), [np.empty((0, FEATURES))], [np.empty(0)]
    for batch in rows:
        batch = batch.filter(pc.equal(batch["fold"], FIT))
        for part, texts in chunks(batch):
            x.append(features(model, words(texts, LONGEST), memo))
            y.append(part["toxic"].to_numpy(zero_copy_only=False).astype(float))
    fit(model, np.concatenate(x), np.concatenate(y))
    return model


def _count_pairs(batches):
    """(pair, before, after, ordinary, toxic, documents) of a batch of (toxic, text)."""
    for batch in batches:
        for part, texts in chunks(batch):
            found = words(texts, LONGEST)
            toxic = part.column(0).to_numpy(zero_copy_only=False).astype(float)
            places, names = pairs_of(found)
            pair, first, inverse = np.unique(names, return_index=True, return_inverse=True)
            owner = found.owner[places]
            of_class = toxic[owner]
            held = np.unique(inverse * np.int64(found.rows) + owner) // max(found.rows, 1)
            counts = [np.bincount(inverse, c, len(pair)) for c in (1 - of_class, of_class)]
            counts.append(np.bincount(held, minlength=len(pair)))
            hashes = (pair, found.hashes[places[first]], found.hashes[places[first] + 1])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(h.view(np.int64)) for h in hashes), *(pa.array(c.astype(np.int64)) for c in counts)],
                ["pair", "before", "after", "ordinary", "toxic", "documents"],
            )


def pair_gains(texts: DataFrame) -> DataFrame:
    """(pair, gain): toxic minus ordinary log-likelihood of the second word after the first, where it is above zero
    and PAIR_DOCUMENTS of ``texts`` (toxic, text) have the pair."""
    counted = texts.select("toxic", "text").mapInArrow(
        _count_pairs, "pair bigint, before bigint, after bigint, ordinary bigint, toxic bigint, documents bigint"
    )
    sums = [F.sum(c).alias(c) for c in ("ordinary", "toxic", "documents")]
    pairs = counted.groupBy("pair", "before", "after").agg(*sums)
    contexts = pairs.groupBy("before").agg(
        *[F.sum(c).alias(f"{c}_total") for c in ("ordinary", "toxic")],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in ("ordinary", "toxic")],
    )
    kinds = pairs.groupBy("after").agg(F.count(F.lit(1)).alias("kinds"))
    every = pairs.agg(F.count(F.lit(1)).alias("every"))
    found = pairs.where(F.col("documents") >= PAIR_DOCUMENTS).join(contexts, "before").join(kinds, "after")
    lower = F.col("kinds") / every.scalar()

    def likelihood(c):
        count, total = F.col(c), F.col(f"{c}_total")
        p = (F.greatest(count - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"{c}_kinds") * lower) / total
        return F.log(F.when(total > 0, p).otherwise(lower))

    gain = likelihood("toxic") - likelihood("ordinary")
    return found.select("pair", gain.alias("gain")).where("gain > 0")


def _expressions(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct expressions of the counted documents, spelled, and their counts per class."""
    names, spelled, counts = [], [], []
    for batch in rows:
        batch = batch.filter(pc.not_equal(batch["fold"], FIT))
        for part, texts in chunks(batch):
            found = words(texts, LONGEST)
            toxic = part["toxic"].to_numpy(zero_copy_only=False).astype(float)[found.owner]
            h, first, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
            wide = np.zeros((len(h), LONGEST + 2), np.uint8)
            own = _spell(found.data, found.starts[first], (found.ends - found.starts)[first])
            wide[:, : own.shape[1]] = own
            names.append(h)
            spelled.append(wide)
            counts.append(np.stack([np.bincount(inverse, x, len(h)) for x in (1 - toxic, toxic)], axis=1))
    if not names:
        return np.zeros((0, 2), np.uint8), np.zeros((0, 2))
    h, first, inverse = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    counts = np.concatenate(counts)
    return np.concatenate(spelled)[first], np.stack(
        [np.bincount(inverse, counts[:, k], len(h)) for k in (0, 1)], axis=1
    )


def _scores(model):
    def run(batches):
        learnt, memo = model.value, Memo()
        for batch in batches:
            for part, texts in chunks(batch):
                found = score(learnt, features(learnt, words(texts, LONGEST), memo))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], [*part.schema.names[:-1], "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, with held_out, score and predicted.

    A null or empty text has no expression and gets the score of all-zero features. Labels other than 0
    and 1 are not used; a repeated label counts once. Without labels of both classes every score
    is the same. Repeated rows and null ids are scored like others; extra columns are passed on.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(train(docs, labels))  # bounded by the sample
    release()
    slim = docs.select(F.struct("*").alias("row"), "text")
    fields = docs.schema.simpleString()
    scored = slim.mapInArrow(_scores(model), f"row {fields}, score double")
    held_out = F.coalesce(_fold(F.col("row.doc_id")) == HELD_OUT, F.lit(False))
    return scored.select(
        "row",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
