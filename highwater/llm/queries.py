"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from highwater.llm import collocations, hard_negatives, line_dedup, mixing
from highwater.llm import quality as quality_rules
from highwater.llm.ann import nearest_neighbours
from highwater.llm.common import table
from highwater.llm.lm_score import score_documents
from highwater.llm.ngram_join import jaccard_components
from highwater.llm.packing import pack
from highwater.llm.sharding import shard_documents
from highwater.llm.simhash import simhash_components
from highwater.llm.token_count import count_tokens
from highwater.llm.toxicity import score_toxicity


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    lines = line_dedup.line_counts
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        "text",
        lines(F.col("before")).alias("n_lines"),
        F.when(F.col("text") == F.col("before"), F.lit(0)).otherwise(
            lines(F.col("before")) - F.when(F.col("text") == "", _empties("before")).otherwise(lines(F.col("text")))
        ).cast("long").alias("n_removed"),
    )


def _empties(column: str) -> F.Column:
    """Lines left in a text that became empty: one if it had a line without characters, else none."""
    has = F.exists(F.split(column, "\n", -1), lambda x: x == "")
    return F.when(has, F.lit(1)).otherwise(F.lit(0)).cast("long")


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "char_distance",
        "word_distance",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op9_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "row.doc_id", "mixed.size", "mixed.source_size", "mixed.target", "mixed.taken"
    )


def op10_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_ngram_jaccard,
        op2_line_dedup,
        op3_sampled_splitters,
        op4_context_mixing,
        op5_token_counts,
        op6_best_fit_packing,
        op7_distribution_divergence,
        op8_toxicity,
        op9_water_filling,
        op10_projected_neighbours,
        op11_simhash,
        op12_hard_negatives,
        op13_collocations,
        pipeline,
    )
    return {f.__name__: f for f in own}


_OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT i.a, i.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id
    GROUP BY ALL) i
  JOIN n p ON p.doc_id = i.a JOIN n q ON q.doc_id = i.b WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON m.a = d.doc_id
"""

_OP2 = (
    line_dedup.ORACLE
    + r"""
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
  CAST(len(string_split(coalesce(d.text, ''), chr(10))) - CASE WHEN d.text IS NULL THEN 1 ELSE coalesce(k.n, 0) END AS BIGINT)
    AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
)

_OP9 = f"""
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST((whole + CASE WHEN more THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM ({mixing.ORACLE_MIXED.format(docs="documents")})
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": _OP1,
        "op2_line_dedup": _OP2,
        "op7_distribution_divergence": quality_rules.ORACLE,
        "op9_water_filling": _OP9,
        "op12_hard_negatives": hard_negatives.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
