"""The operators of this package over the whole tables they are meant for."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turntable.llm import language, recursive_bpe, toxicity
from turntable.llm.bpe_stream import digests, encode_documents
from turntable.llm.decontaminate import find_passages
from turntable.llm.divergence import divergence
from turntable.llm.hilbert import hilbert_shards
from turntable.llm.html_text import extract_text
from turntable.llm.near_duplicates import near_duplicates
from turntable.llm.quality import quality_rules
from turntable.llm.records import read_records, write_records
from turntable.llm.token_counts import count_tokens
from turntable.llm.whitening import whiten
from turntable.sources.tables import scratch_path

TOKEN_LIMIT = 1024
END_ID = 1
SHARDS = 24


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the labels call good."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, score and verdict of every document."""
    judged = quality_rules(_documents(spark, sf_dir), trusted_ids(spark, sf_dir))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return judged.select("doc_id", *[f"quality.{name}" for name in first])


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a network trained on labelled rows that are not held out."""
    texts = _documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score(texts, toxicity_model(spark, sf_dir))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level tokens of every document."""
    counted = count_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the group of near copies it belongs to."""
    return near_duplicates(_documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items."""
    return find_passages(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every document, learnt from documents that are not held out."""
    documents = _documents(spark, sf_dir)
    found = language.identify(documents.select("doc_id", "text"), language.fit(documents))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "lang_pred", "score")


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as a record of token ids and read back."""
    path = scratch_path(spark)
    write_records(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_records(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("tokens") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )


def op9_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the word transducer and back."""
    return digests(encode_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of equally many rows along language, source and length."""
    assigned = hilbert_shards(_documents(spark, sf_dir), ["lang", "source", "n_chars"], SHARDS)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return assigned.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "curve")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms it uses more than the language does."""
    return divergence(_documents(spark, sf_dir))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding along the principal components of all, each with variance one."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the byte-level merges of recursive queries and back."""
    texts = _documents(spark, sf_dir).select("doc_id", "text")
    file = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return recursive_bpe.digests(recursive_bpe.encode_documents(texts, file, public_tokenizers.PATTERN, decoded=True))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_token_counts": op4_token_counts,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontamination": op6_decontamination,
    "op7_language": op7_language,
    "op8_binary_records": op8_binary_records,
    "op9_bpe_stream": op9_bpe_stream,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_recursive_bpe": op13_recursive_bpe,
    "pipeline": corpus_pipeline.run,
}

_DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT id, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d
),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS kept, sum(total) AS whole FROM k GROUP BY lang),
s AS (
    SELECT g.lang, g.source, any_value(coalesce(v.kept, 0)) AS kept, any_value(coalesce(v.whole, 0)) AS whole, coalesce(sum(c.n), 0) AS size
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source
    GROUP BY g.lang, g.source
),
p AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (s.size + 2 * s.kept) AS p,
        1 + 1000000000::HUGEINT * (k.total + 2) // (s.whole + 2 * s.kept) AS q
    FROM s JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce(sum((pa.p - pb.p) * (pa.p - pb.p) // (pa.p + pb.p)), 0)::BIGINT AS value
    FROM s a JOIN s b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN p pa ON pa.lang = a.lang AND pa.source = a.source
    LEFT JOIN p pb ON pb.lang = b.lang AND pb.source = b.source AND pb.term = pa.term
    GROUP BY a.lang, a.source, b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES: dict[str, str] = {"op11_source_divergence": _DIVERGENCE_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
