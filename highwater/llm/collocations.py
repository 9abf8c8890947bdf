"""Operator 13: phrase collocations from count streams in prefix and suffix order.

Counting comes first, in three readings of the texts: words, pairs of frequent words, and phrases of three to five
words all of whose pairs are frequent. Whatever else is left out cannot be frequent, since no phrase occurs more
often than a part of it. Which words or pairs are frequent a task learns from a bit field of bounded size, in which
a stranger may pass (it is counted and dropped then) but nothing frequent fails. Within a task phrases are counted
by the exact numbers of their words, not by hashes, and tasks are added up by the phrase itself.

The counts of all frequent phrases then form two streams: in prefix order (by first word, second word, ...) and in
suffix order (by last word, last but one, ...). A phrase follows its beginnings directly in the first and its
endings in the second, so one walk along a stream, with the parts of the present phrase on a stack, merges the counts
of all lengths in lockstep: it gives each phrase the counts of its beginnings (or endings) and the largest count of
a phrase one word longer on that side. Streams are dealt to tasks in ranges between sampled splitters, and sorted
there. A phrase whose continuations lie in several ranges stands in all of them, so no word's phrases have to
be in one task.

If a phrase that is several words longer has the same count, so has one that is a word longer: the walk need not look
further than one word.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join
from highwater.llm.common import partitions, ship, shuffles_removed
from highwater.llm.words import Words, chunks, mix, text_bytes, words

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"
FLUSH = 1_000_000
#: Bits of the field that tells which phrases are frequent: about 16 for each, within these limits (32 MB at most).
FIELD_BITS = (1 << 20, 1 << 28)
#: Phrases drawn per range to find the splitters.
DRAWN = 64
SALTS = 64

_BREAKS = np.arange(256, dtype=np.uint8)
_BREAKS[list(b".,;:!?")] = 0x0A


def _pieces(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words, and for each whether it goes on in the piece of the one before it."""
    data, bounds = text_bytes(texts)
    offsets = pa.py_buffer(bounds.astype(np.int64))
    found = words(pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(_BREAKS[data])))
    ended = np.concatenate([[0], np.cumsum((found.data >= 0x0A) & (found.data <= 0x0D), dtype=np.int32)])
    goes_on = np.zeros(len(found.starts), bool)
    if len(goes_on):
        goes_on[1:] = ended[found.starts[1:]] == ended[found.ends[:-1]]
        goes_on[found.first[:-1][found.counts > 0]] = False
    return found, goes_on


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ranges one after the other, and the bounds between them."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    return data[at], bounds


class Numbered:
    """A chunk's words by number: equal words of a chunk have one number, and different ones never."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.found, self.goes_on = _pieces(texts)
        found = self.found
        data, bounds = _gather(found.data, found.starts, found.ends - found.starts)
        whole = pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(bounds), pa.py_buffer(data))
        coded = whole.dictionary_encode()
        self.number = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy().astype(np.int64)[found.owner]
        self.lang_hash = mix(text_hashes(self.langs))[self.lang]

    def counts(self, starts: np.ndarray, size: int) -> pa.Table:
        """(lang, phrase, c) of the phrases of ``size`` words that begin at ``starts``."""
        if not len(starts):
            return _NOTHING
        ids = self.lang[starts]
        for k in range(size):
            _, ids = np.unique(ids * len(self.words) + self.number[starts + k], return_inverse=True)
        _, first, c = np.unique(ids, return_index=True, return_counts=True)
        one = starts[first]
        parts = [self.words.take(pa.array(self.number[one + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
        return pa.table(
            {"lang": self.langs.take(pa.array(self.lang[one])), "phrase": phrase, "c": pa.array(c.astype(np.int64))}
        ).cast(_COUNTS)


_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("c", pa.int64())])
_NOTHING = _COUNTS.empty_table()


def text_hashes(texts: pa.Array) -> np.ndarray:
    """64-bit hashes of whole strings."""
    return np.array([hash_bytes(t.encode()) for t in texts.to_pylist()], np.uint64)


def hash_bytes(data: bytes) -> int:
    h = 0xCBF29CE484222325
    for byte in data:
        h = (h ^ byte) * 0x100000001B3 & (1 << 64) - 1
    return h


def _places(lang: np.ndarray, hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """A place in the bit field for phrases given by the hashes of their words."""
    h = reduce(lambda a, b: mix(a * np.uint64(0x9E3779B97F4A7C15) + b), hashes, lang)
    return (h & np.uint64(bits - 1)).astype(np.int64)


class Field:
    """Bits at the places of frequent phrases."""

    def __init__(self, bits: int, rows):
        self.bits, self.data = bits, np.zeros(bits // 8, np.uint8)
        for bucket, field in rows:
            self.data[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(field, np.uint8)

    def has(self, places: np.ndarray) -> np.ndarray:
        return self.data[places >> 3] >> (places & 7).astype(np.uint8) & 1 == 1


def _mark(bits: int, size: int):
    """The place of each phrase of ``size`` words. Columns: lang, phrase."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = words(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            lang = mix(text_hashes(langs.dictionary))[langs.indices.to_numpy()]
            places = _places(lang, [found.hashes[k::size] for k in range(size)], bits)
            yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])

    return run


def field_of(frequent: DataFrame, size: int) -> Field:
    """The bit field of the phrases (lang, phrase) of ``size`` words; not larger than FIELD_BITS allows."""
    low, high = FIELD_BITS
    bits = min(high, max(low, 1 << (16 * frequent.count()).bit_length()))
    places = frequent.select("lang", "phrase").mapInArrow(_mark(bits, size), "place bigint")
    place = F.col("place") + 1  # buckets count from 1
    rows = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("field")
    )
    return Field(bits, [(r.bucket, r.field) for r in rows.collect()])  # bits / 8 bytes


def _starts(chunk: Numbered, size: int, parts: int, field) -> np.ndarray:
    """Where phrases of ``size`` words begin that stay within a piece and all of whose ``parts`` are in the field."""
    n = len(chunk.number)
    open_ = np.ones(max(0, n - size + 1), bool)
    for k in range(1, size):
        open_ &= chunk.goes_on[k : k + len(open_)]
    if field is not None and len(open_):
        known = field.value
        h = chunk.found.hashes
        places = _places(chunk.lang_hash[: n - parts + 1], [h[k : n - parts + 1 + k] for k in range(parts)], known.bits)
        has = known.has(places)
        for k in range(size - parts + 1):
            open_ &= has[k : k + len(open_)]
    return np.flatnonzero(open_)


def _count(sizes, parts: int, field):
    """(lang, phrase, c) of (lang, text), summed as far as a task holds them."""

    def run(batches):
        held, rows = [], 0

        def summed() -> pa.Table:
            every = pa.concat_tables(held)
            return every.group_by(["lang", "phrase"]).aggregate([("c", "sum")]).rename_columns(["lang", "phrase", "c"])

        for batch in batches:
            langs = batch.column(0)
            at = 0
            for part, texts in chunks(batch):
                chunk = Numbered(texts, langs.slice(at, part.num_rows))
                at += part.num_rows
                for size in sizes:
                    held.append(chunk.counts(_starts(chunk, size, parts, field), size))
                    rows += held[-1].num_rows
                if rows > FLUSH:
                    held = [summed()]
                    rows = held[0].num_rows
                    if rows > FLUSH // 2:
                        yield from held[0].cast(_COUNTS).to_batches()
                        held, rows = [], 0
        if held:
            yield from summed().cast(_COUNTS).to_batches()

    return run


def counted(docs: DataFrame, sizes, parts: int = 0, field=None) -> DataFrame:
    """(lang, phrase, f): how often every phrase of these sizes occurs whose parts are all in the field."""
    found = docs.mapInArrow(_count(tuple(sizes), parts, field), "lang string, phrase string, c bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("c").alias("f"))


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of up to ``longest`` words that occurs ``least`` times, and (lang, n)."""
    context = docs.sparkSession.sparkContext
    often = F.col("f") >= least
    every = materialise(counted(docs, [1]), "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [every.where(often)]
    if longest > 1:
        # Both fields have a proven size: FIELD_BITS.
        field = context.broadcast(field_of(levels[0], 1))
        levels.append(materialise(counted(docs, [2], 1, field).where(often), "pairs"))
    if longest > 2:
        field = context.broadcast(field_of(levels[1], 2))
        levels.append(materialise(counted(docs, range(3, longest + 1), 2, field).where(often), "phrases"))
    return reduce(DataFrame.unionByName, levels), totals


def splitters(stream: DataFrame, ranges: int) -> list[tuple[str, ...]]:
    """Keys that cut the stream (lang, words) into about even ranges, from DRAWN * ranges of its rows."""
    n = max(1, stream.count())
    share = int(min(1.0, DRAWN * ranges / n) * (1 << 20))
    drawn = stream.where(F.pmod(F.xxhash64("lang", "words"), F.lit(1 << 20)) < share)
    keys = sorted((r.lang, *r.words) for r in drawn.collect())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def _deal(cuts):
    """(range, own, lang, words, f): each phrase in its range, and in all others that hold words after it."""

    def run(batches):
        bounds = cuts.value
        for batch in batches:
            picked, ranges, own = [], [], []
            for i, (lang, found) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                key = (lang, *found)
                first = last = bisect_right(bounds, key)
                while last < len(bounds) and bounds[last][: len(key)] == key:
                    last += 1
                picked += [i] * (last - first + 1)
                ranges += range(first, last + 1)
                own += [True] + [False] * (last - first)
            rows = batch.take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), pa.array(own, pa.bool_()), *rows.columns],
                ["range", "own", "lang", "words", "f"],
            )

    return run


def _walk(batches):
    """(lang, words, counts, longer) along a sorted stream: the counts of the phrase's parts of 1, 2, ... words,
    null where the phrase only stands in for another range, and the largest count of a phrase a word longer."""
    stack: list[list] = []  # of [words, f, own, longer]
    out: list[tuple] = []
    here = (None, None)  # range and language

    def leave(depth: int):
        while len(stack) > depth:
            found, _, own, longer = stack.pop()
            out.append((here[1], found, [x[1] for x in stack] if own else None, longer))

    for batch in batches:
        for number, own, lang, found, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if here != (number, lang):
                leave(0)
                here = (number, lang)
            while stack and found[: len(stack[-1][0])] != stack[-1][0]:
                leave(len(stack) - 1)
            if stack and len(found) == len(stack[-1][0]) + 1:
                stack[-1][3] = max(stack[-1][3], f)
            stack.append([found, f, own, 0])
        yield _walked(out)
        out.clear()
    leave(0)
    yield _walked(out)


def _walked(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "words", "counts", "longer"])


def parts_in_order(frequent: DataFrame, backwards: bool) -> DataFrame:
    """(lang, phrase, counts, longer) from the stream in prefix order, or ``backwards`` in suffix order."""
    spark = frequent.sparkSession
    ordered = F.reverse if backwards else lambda x: x
    stream = frequent.select("lang", ordered(F.split("phrase", " ")).alias("words"), "f")
    ranges = partitions(spark)
    cuts = spark.sparkContext.broadcast(splitters(stream, ranges))  # a key per range
    dealt = stream.mapInArrow(_deal(cuts), "range int, own boolean, lang string, words array<string>, f bigint")
    streams = dealt.repartition(ranges, "range").sortWithinPartitions("range", "lang", "words")
    walked = streams.mapInArrow(_walk, "lang string, words array<string>, counts array<bigint>, longer bigint")
    return walked.select("lang", F.array_join(ordered(F.col("words")), " ").alias("phrase"), "counts", "longer")


#: The lowest-scoring cut. Products of three counts are exact as decimals of 38 digits.
_LOWEST = """
array_min(transform(sequence(1, size(heads)), k -> struct(
  (cast(1000 as decimal(4,0)) * (cast(a as decimal(17,0)) * cast(n as decimal(17,0))))
    div (cast(element_at(heads, k) as decimal(19,0)) * cast(element_at(tails, size(heads) + 1 - k) as decimal(19,0))) as score,
  k as k, element_at(heads, k) as l, element_at(tails, size(heads) + 1 - k) as r)))
"""


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words and more that no longer one of the same count holds, with their lowest-scoring cut."""
    known = frequent.select("lang", "phrase", F.col("f").alias("a"))
    nothing = F.lit(None).cast("array<bigint>")
    head, tail = parts_in_order(frequent, False), parts_in_order(frequent, True)
    sides = head.select("lang", "phrase", F.col("counts").alias("heads"), nothing.alias("tails"), "longer").unionByName(
        tail.select("lang", "phrase", nothing.alias("heads"), F.col("counts").alias("tails"), "longer")
    )
    empty = F.lit(None)
    sides = sides.withColumn("a", empty.cast("long")).unionByName(
        known.select("lang", "phrase", nothing.alias("heads"), nothing.alias("tails"), empty.cast("long").alias("longer"), "a")
    )
    each = sides.groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("a", "heads", "tails", "longer")])
    each = each.where((F.size("heads") > 0) & (F.col("longer") < F.col("a")))
    each = split_join(each, totals, ["lang"], "inner").withColumn("cut", F.expr(_LOWEST))
    return each.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the first ``top`` phrases of each language of ``docs`` (text, lang).

    A phrase is 2 to ``longest`` neighbouring words of a piece, found ``least`` times or more. A null language is
    ``und``, as is the language of that name; a null or empty text has no words. Repeated rows count each time.
    Ties go by a, then by the phrase's bytes. A table without phrases that frequent gives no rows. Extra columns are
    not read and may have any name.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    with shuffles_removed(docs.sparkSession):
        frequent, totals = frequent_phrases(docs, least, longest)
        found = scored(frequent, totals)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First within parts of a language, so that the last window sorts SALTS * top rows of it at most.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    few = found.withColumn("salt", salt).withColumn("place", F.row_number().over(part)).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM w, (SELECT unnest(range(1, 6)) AS k)
), f AS MATERIALIZED (
  SELECT lang, array_to_string(g, ' ') AS p, any_value(g) AS g, count(*) AS f FROM g GROUP BY lang, p
), t AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang
), often AS MATERIALIZED (
  SELECT lang, p, g, f FROM f WHERE f >= 100
), c AS MATERIALIZED (
  SELECT lang, p, g, f AS a FROM often WHERE len(g) > 1
), inside AS (
  SELECT lang, array_to_string(g[i:j], ' ') AS p, max(a) AS longer
  FROM c, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 6)) AS j)
  WHERE j > i AND j <= len(g) AND j - i + 1 < len(g) GROUP BY ALL
), halves AS MATERIALIZED (
  SELECT lang, p, a, k, array_to_string(g[1:k], ' ') AS head, array_to_string(g[k + 1:], ' ') AS tail
  FROM c, (SELECT unnest(range(1, 5)) AS k) WHERE k < len(g)
), cuts AS (
  SELECT h.lang, h.p, h.a, h.k, l.f AS l, r.f AS r, t.n, (1000 :: HUGEINT * h.a * t.n) // (l.f :: HUGEINT * r.f) AS score
  FROM halves h JOIN t ON t.lang = h.lang
  JOIN often l ON l.lang = h.lang AND l.p = h.head JOIN often r ON r.lang = h.lang AND r.p = h.tail
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT x.lang, CAST(row_number() OVER (PARTITION BY x.lang
    ORDER BY score DESC, a DESC, x.p) AS BIGINT) AS rank,
  x.p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest x LEFT JOIN inside i ON i.lang = x.lang AND i.p = x.p
WHERE i.longer IS NULL OR 100 * i.longer < 100 * a
QUALIFY rank <= 2000
"""
