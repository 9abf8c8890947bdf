"""Operator 2: removal of repeated passages by windows of three lines.

Every three consecutive lines that hold a word make a window. Windows found more than once in the corpus
stay where they occur first (by doc_id, then by place) and go everywhere else: the positions that
later occurrences cover are merged, and these lines are left out of the text.

That is the rule of the registered query, whose SQL is fixed. A passage of one or two long lines is no window of
it; with ``short``, one or two neighbouring lines of more than LONG words together are windows as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.functions.skew import split_join
from highwater.llm.common import SPACES, let

WINDOW = 3
LONG = 50  # words; with ``short``, fewer than WINDOW lines are a window when they hold more
_FILLED = f"[^{SPACES}]"


def _lines(text) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _filled(lines) -> F.Column:
    """(at, line) of the lines that hold a word."""
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(_FILLED))


def _hashes(lines) -> F.Column:
    return F.struct(F.xxhash64(*lines).alias("h"), F.xxhash64(F.lit(1), *lines).alias("g"))


def _windows(docs: DataFrame) -> DataFrame:
    """One row per window: two 64-bit hashes of its lines, its document, and its place there."""

    def windows(filled):
        def window(k):
            return _hashes([F.get(filled, k + j)["line"] for j in range(WINDOW)])

        return F.when(
            F.size(filled) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(filled) - WINDOW), window)
        )

    hashed = let(_filled(_lines(F.col("text"))), windows)
    return (
        docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(hashed).alias("k", "w"))
        .select("w.h", "w.g", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "k").alias("place"))
    )


def _all_windows(docs: DataFrame) -> DataFrame:
    """The windows of three lines, and those of one or two with more than LONG words together.

    Where every line of a window is long by itself, the windows of its lines say the same, so it is left out.
    ``k`` is the number of the first line times WINDOW + 1, plus the number of lines.
    """

    def counted(filled):
        return F.transform(
            filled, lambda x: F.struct(x["line"].alias("line"), F.regexp_count(x["line"], F.lit(f"{_FILLED}+")).alias("n"))
        )

    def windows(filled):
        def at(k):
            def window(size):
                own = [F.get(filled, k + j) for j in range(size)]
                long = [x["n"] > LONG for x in own]
                wanted = F.lit(True) if size == WINDOW else sum((x["n"] for x in own[1:]), own[0]["n"]) > LONG
                if size > 1:
                    wanted = wanted & ~reduce(lambda a, b: a & b, long)
                place = (k * (WINDOW + 1) + size).alias("k")
                inside = k + size <= F.size(filled)
                return F.when(inside & wanted, F.struct(_hashes([x["line"] for x in own]).alias("w"), place))

            return F.array_compact(F.array(*[window(size + 1) for size in range(WINDOW)]))

        return F.when(
            F.size(filled) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(filled) - 1), at))
        )

    hashed = let(_filled(_lines(F.col("text"))), lambda x: let(counted(x), windows))
    return (
        docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(hashed).alias("x"))
        .select("x.w.h", "x.w.g", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "x.k").alias("place"))
    )


def covered_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, th, ks): the later windows of each document, by the numbers of their first lines.

    With ``short`` the numbers are those of ``_all_windows``.
    """
    found = _all_windows(docs) if short else _windows(docs)
    repeated = (
        found.groupBy("h", "g")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
        .where("n > 1")
        .drop("n")
    )
    later = split_join(found, repeated, ["h", "g"], "inner").where("place != first")
    return later.groupBy("place.doc_id", "place.th").agg(F.collect_set("place.k").alias("ks"))


def dedup_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """``docs`` with later repeats taken out of ``text``, all other columns as they are.

    Rows stay, also those whose text becomes empty. Lines without a word take no part and stay. A text
    with fewer than three lines that hold a word stays as it is, unless ``short`` is set and one or two lines of it
    hold more than LONG words; an empty or a null text always does. Rows equal
    in doc_id and text are one document: its first occurrences stay in each of them. Null ids come last.
    """
    taken = [c.lower() for c in docs.columns]
    names = {x: next(n for i in range(99) if (n := f"{x}_{i}") not in taken) for x in ("th", "ks", "id")}
    covered = covered_lines(docs.select("doc_id", "text"), short).select(
        F.col("doc_id").alias(names["id"]), F.col("th").alias(names["th"]), F.col("ks").alias(names["ks"])
    )
    same = F.col("doc_id").eqNullSafe(F.col(names["id"])) & (F.xxhash64("text") == F.col(names["th"]))
    ks = F.col(names["ks"])

    def without(lines):
        def kept(at):
            def lines_of(k):
                if not short:
                    return F.slice(at, k + 1, WINDOW)
                return F.slice(at, F.floor(k / (WINDOW + 1)).cast("int") + 1, k % (WINDOW + 1))

            gone = F.flatten(F.transform(ks, lines_of))
            return F.array_except(F.transform(lines, lambda _, i: i), gone)

        left = let(F.transform(_filled(lines), lambda x: x["at"]), kept)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    text = let(_lines(F.col("text")), without)
    joined = docs.join(covered, same, "left")
    return joined.withColumn("text", F.when(ks.isNull(), F.col("text")).otherwise(text)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def line_counts(before: F.Column) -> F.Column:
    return F.size(_lines(before)).cast("long")


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT a.doc_id, a.k, a.line AS l1, b.line AS l2, c.line AS l3
  FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.k = a.k + 1
  JOIN filled c ON c.doc_id = a.doc_id AND c.k = a.k + 2
), later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, k) AS n FROM windows)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT f.doc_id, f.i FROM filled f JOIN later w ON w.doc_id = f.doc_id AND f.k BETWEEN w.k AND w.k + 2
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS n
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE g.i IS NULL GROUP BY l.doc_id
)
"""
