"""Operator 7: quality by the divergence of a document's distributions from language references.

Two histograms describe a document: the classes of its characters, and its words among the TOP commonest words of
its language, a bin each and one for all others. Both the list of these words and the reference, the same pair of
histograms over all documents of the language, are learnt from the corpus. The Jensen-Shannon distance to the reference
tells prose from lists, codes and shouting. Short documents have noisy histograms, so a verdict needs a minimum of
characters and words, and a language with few documents has no reference: its documents, and those without a
language, get no such verdict.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join
from highwater.llm.common import SPACES, let, words_of

# The limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Words of a language's list, and documents that it takes to make a reference.
TOP = 16
MIN_DOCUMENTS = 20
#: Distances above these reject; guards are the least number of characters and words for a verdict.
MAX_CHAR_DISTANCE = 0.35
MAX_WORD_DISTANCE = 0.27
MIN_CHARS = 400
MIN_WORDS_VERDICT = 100
DIGITS = 6  # of the distances

_WINDOW = 3
CLASSES = ("lower", "upper", "digit", "symbol", "accent", "other")


def _count(text, kept: str) -> F.Column:
    """Characters of ``text`` in a class: what is left without all others."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def _repeat_words(words) -> F.Column:
    """Words that stand in a 3-word window found twice or more, each counted once.

    Windows are hashed, and (hash, place) is sorted, so equal windows are neighbours; the places of the
    repeated ones are sorted again and each adds the words that the one before does not cover.
    """
    last = F.size(words) - _WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(_WINDOW)])
    )

    def repeated(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def places(s):
            twice = F.filter(
                s,
                lambda x, i: F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)),
            )
            at = F.sort_array(F.transform(twice, lambda x: x["at"]))
            return let(at, covered)

        def covered(at):
            steps = F.transform(
                at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(_WINDOW)), F.lit(_WINDOW))
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))

        return let(ordered, places)

    distinct = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(repeated(h)),
    )
    return F.when(last < 0, F.lit(0).cast("long")).otherwise(distinct)


def _shares(counts) -> F.Column:
    """An array of counts as shares of their sum; all 0 without any."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def js_distance(p, q) -> F.Column:
    """The square root of the Jensen-Shannon divergence in bits: 0 (equal) to 1 (nothing shared)."""

    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def common_words(docs: DataFrame) -> DataFrame:
    """(lang, top, longest): the TOP commonest words of every language with MIN_DOCUMENTS documents, the commonest
    first, as they are written, and the bytes of the longest of them."""
    known = docs.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    known = known.where(F.col("n") >= MIN_DOCUMENTS).select("lang")
    found = docs.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    counted = found.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("c"))
    # Spark keeps each task's first TOP rows of a language before it brings them together.
    order = Window.partitionBy("lang").orderBy(F.desc("c"), "word")
    first = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP)
    lists = first.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("top"))
    top = F.col("top.word")
    longest = F.array_max(F.transform(top, lambda x: F.octet_length(x)))
    return materialise(known.join(lists, "lang").select("lang", top.alias("top"), longest.alias("longest")), "languages")


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every row of ``docs`` (doc_id, text, lang), written once; ``common`` has those of the language's
    words and of all others, or is null."""
    text = F.coalesce("text", F.lit(""))
    listed = split_join(docs, common_words(docs), ["lang"], "left")
    # Hidden behind a generator, so that the words of a text are computed once.
    slim = listed.select("doc_id", "lang", "top", "longest", text.alias("t"), F.explode(F.array(words_of(text))).alias("w"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{SPACES}]"))
    counts = {
        "lower": _count(F.col("t"), "a-z"),
        "upper": _count(F.col("t"), "A-Z"),
        "digit": _count(F.col("t"), "0-9"),
        "symbol": _count(F.col("t"), "#*$%&|<>"),
        "accent": _count(F.col("t"), "\\x{80}-\\x{10FFFF}"),
    }
    # Most words are on no list and are left out before the others are told apart.
    own = F.filter("w", lambda x: (F.octet_length(x) <= F.col("longest")) & F.array_contains("top", x))

    def histogram(found):
        each = F.transform("top", lambda y: F.size(F.filter(found, lambda x: x == y)).cast("long"))
        return F.concat(each, F.array((F.size("w") - F.size(found)).cast("long")))

    measured = slim.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", f"[{SPACES}]+", "")).cast("long").alias("word_chars"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).alias("n_repeat_words"),
        *[c.alias(n) for n, c in counts.items()],
        F.when(F.col("top").isNotNull(), let(own, histogram)).alias("common"),
    )
    return materialise(measured, "quality")


def references(full: DataFrame) -> DataFrame:
    """(lang, char_ref, word_ref): for every language with a list the shares of both histograms over its documents."""
    sums = [F.sum(c).cast("double") for c in CLASSES]
    bins = F.array(*[F.coalesce(F.sum(F.get("common", F.lit(i))), F.lit(0)).cast("double") for i in range(TOP + 1)])
    summed = full.where("common is not null").groupBy("lang").agg(
        F.array(*sums).alias("chars"), bins.alias("bins"), F.max(F.size("common")).alias("n")
    )
    # A short list has fewer bins.
    return summed.select("lang", _shares(F.col("chars")).alias("char_ref"), _shares(F.slice("bins", 1, F.col("n"))).alias("word_ref"))


def judge(measured: DataFrame) -> DataFrame:
    """Adds base_failed, char_distance, word_distance and kept; distances are null without a reference."""
    known = reduce(lambda a, b: a + b, [F.col(c) for c in CLASSES[:-1]])
    full = measured.withColumn("other", F.greatest(F.col("word_chars") - known, F.lit(0)))
    judged = split_join(full, references(full), ["lang"], "left")

    def distance(own, reference):
        shares = _shares(F.transform(own, lambda x: x.cast("double")))
        return F.when(F.col(reference).isNotNull(), F.round(js_distance(shares, F.col(reference)), DIGITS))

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    odd = (F.col("word_chars") >= MIN_CHARS) & (F.col("char_distance") > MAX_CHAR_DISTANCE)
    odd = odd | ((F.col("n_words") >= MIN_WORDS_VERDICT) & (F.col("word_distance") > MAX_WORD_DISTANCE))
    return (
        judged.withColumn("char_distance", distance(F.array(*CLASSES), "char_ref"))
        .withColumn("word_distance", distance(F.col("common"), "word_ref"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~F.coalesce(odd, F.lit(False)))
        .withColumn("n_symbols", F.col("symbol"))
    )


def quality(docs: DataFrame) -> DataFrame:
    """Counts, distances and the verdict for every row of ``docs`` (doc_id, text, lang, ...).

    A null or empty text has no words and fails the base rules. A document without a language, or of one with fewer
    than MIN_DOCUMENTS documents, has no distances (null) and is judged by the base rules alone. Equally common words
    are listed by their bytes. Rows stay rows, whatever their ids. Extra columns are not read; an empty table gives
    no rows.
    """
    return judge(measure(docs.select("doc_id", "text", "lang")))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), c AS (
  SELECT lang, x, count(*) AS c FROM (SELECT lang, unnest(w) AS x FROM d)
  WHERE lang IN (SELECT lang FROM d GROUP BY lang HAVING count(*) >= 20) GROUP BY ALL
), tops AS (
  SELECT lang, list(x ORDER BY c DESC, x) AS top FROM c
  WHERE (lang, x) IN (SELECT (lang, x) FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY c DESC, x) <= 16)
  GROUP BY lang
), own AS (
  SELECT rid, top, list_filter(w, lambda x: list_contains(top, x)) AS own, len(w) AS n
  FROM d JOIN tops ON tops.lang = d.lang
), hist AS (
  SELECT rid, list_transform(top, lambda y: len(list_filter(own, lambda x: x = y))) || [n - len(own)] AS bins FROM own
), grams AS (
  SELECT rid, i, list_aggregate(w[i:i + 2], 'string_agg', ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1) GROUP BY rid
), lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), m AS (
  SELECT d.rid, d.doc_id, d.lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, bins,
    [length(regexp_replace(t, '[^a-z]+', '', 'g')), length(regexp_replace(t, '[^A-Z]+', '', 'g')),
     length(regexp_replace(t, '[^0-9]+', '', 'g')), length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')),
     length(regexp_replace(t, '[^\x{80}-\x{10FFFF}]+', '', 'g'))] AS five
  FROM d JOIN lines USING (rid) LEFT JOIN again USING (rid) LEFT JOIN hist USING (rid)
), k AS (
  SELECT *, five || [greatest(word_chars - list_sum(five), 0)] AS classes FROM m
), sums AS (
  SELECT lang, 'c' AS kind, i, sum(classes[i]) AS s FROM k, (SELECT unnest(range(1, 7)) AS i) WHERE bins IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 'w', i, sum(bins[i]) FROM k, (SELECT unnest(range(1, 18)) AS i) WHERE bins IS NOT NULL GROUP BY ALL
), refs AS (
  SELECT lang, list(s ORDER BY i) FILTER (kind = 'c') AS rc, list(s ORDER BY i) FILTER (kind = 'w' AND s IS NOT NULL) AS rw
  FROM sums GROUP BY lang
), pairs AS (
  SELECT k.*, list_transform(classes, lambda x: CASE WHEN list_sum(classes) > 0 THEN x / list_sum(classes) ELSE 0 END) AS pc,
    list_transform(rc, lambda x: CASE WHEN list_sum(rc) > 0 THEN x / list_sum(rc) ELSE 0 END) AS qc,
    list_transform(bins, lambda x: CASE WHEN list_sum(bins) > 0 THEN x / list_sum(bins) ELSE 0 END) AS pw,
    list_transform(rw, lambda x: CASE WHEN list_sum(rw) > 0 THEN x / list_sum(rw) ELSE 0 END) AS qw
  FROM k LEFT JOIN refs r ON r.lang = k.lang
), dist AS (
  SELECT *, round(sqrt(greatest(list_sum(list_transform(list_zip(pc, qc), lambda z:
      CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END
      + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)) / 2, 0)), 6) AS cd,
    round(sqrt(greatest(list_sum(list_transform(list_zip(pw, qw), lambda z:
      CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END
      + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)) / 2, 0)), 6) AS wd
  FROM pairs
), verdict AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN qc IS NOT NULL THEN cd END AS char_distance, CASE WHEN qw IS NOT NULL THEN wd END AS word_distance
  FROM dist
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(word_chars >= 400 AND char_distance > 0.35, FALSE)
    AND NOT coalesce(n_words >= 100 AND word_distance > 0.27, FALSE) AS kept, char_distance, word_distance
FROM verdict
"""
