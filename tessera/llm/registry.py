"""Queries ``opN_<name>``: each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (byte_bpe, chat_format, decontaminate, embedding_dup, fingerprints, language_id, near_dup, quality,
                         source_audit, token_counts, toxicity, url_filter, whitening)
from tessera.llm.blocks import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file (not part of this repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: near duplicates and the classes they form (cases: see ``near_dup``)."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_hash")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: token ids and what they decode to, as digests (cases: see ``byte_bpe``)."""
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations`` and conversation -7, formatted and read back (cases: see ``chat_format``)."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", fixed), (-7, 1, "assistant", fixed)], turns.schema)
    return chat_format.digests(chat_format.output(chat_format.segments(turns.unionByName(extra))))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: scored by a model of the labelled rows of folds 1 to 4 (cases: see ``toxicity``)."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), learn=fold("doc_id", 5) != 0)
    return toxicity.score(docs, model)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages``: judged by the rules and by the template tree (cases: see ``url_filter``)."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: words and word pieces counted (cases: see ``token_counts``)."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"),
                                     token_counts.load_pieces(tokenizer_file("piece_bpe_32k.model")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: words inside phrases of ``benchmark`` (cases: see ``decontaminate``)."""
    blocks = decontaminate.phrase_blocks(_table(spark, sf_dir, "benchmark"))
    return decontaminate.report(decontaminate.find(_table(spark, sf_dir, "documents"), blocks))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: scored by a model of the labelled rows of folds 0, 1 and 3 (cases: see ``quality``)."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), learn=fold("doc_id", 4) != 2)
    return quality.score(docs, model)


def op9_embedding_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``: links within a label and the classes they form (cases: see ``embedding_dup``)."""
    return embedding_dup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: language of each text by a model of folds 0, 1 and 3 (cases: see ``language_id``)."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs, learn=fold("doc_id", 4) != 2)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: sources compared within each language (cases: see ``source_audit``)."""
    return source_audit.audit(_table(spark, sf_dir, "documents"))


_SQL_OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
said AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM said GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT s.lang, s.source, k.term, k.lang_n, coalesce(c.n, 0)::HUGEINT AS n
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM grid GROUP BY ALL),
level AS (
  SELECT g.lang, g.source, g.term, g.n, 1 + 1000000000 * (g.n + 2) // (t.total + 2 * z.v) AS p,
    1 + 1000000000 * (g.lang_n + 2) // (z.lang_total + 2 * z.v) AS q
  FROM grid g JOIN totals t USING (lang, source) JOIN sizes z USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM level a JOIN level b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM level WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 10
"""


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` with fingerprints and near copies (cases: see ``fingerprints``)."""
    return fingerprints.report(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``, whitened to 32 components (cases: see ``whitening``)."""
    vectors = _table(spark, sf_dir, "embeddings")
    return whitening.components_of(vectors, whitening.fit(vectors, components=32))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dup": op1_near_dup,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_chat_format": op3_chat_format,
        "op4_toxicity": op4_toxicity,
        "op5_url_filter": op5_url_filter,
        "op6_token_counts": op6_token_counts,
        "op7_decontaminate": op7_decontaminate,
        "op8_quality": op8_quality,
        "op9_embedding_dup": op9_embedding_dup,
        "op10_language_id": op10_language_id,
        "op11_source_audit": op11_source_audit,
        "op12_fingerprints": op12_fingerprints,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_source_audit": _SQL_OP11}
