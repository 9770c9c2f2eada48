"""A training corpus from raw documents: five stages, each written and read again before the next.

Every stage takes rows as they come: a null text counts as empty, other columns pass through untouched, and an empty table
stays empty. What a stage does with null and repeated ids stands with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turntable.llm import toxicity
from turntable.llm.bpe_stream import digests, encode_documents
from turntable.llm.decontaminate import without_passages
from turntable.llm.near_duplicates import drop_near_duplicates
from turntable.llm.quality import quality_rules
from turntable.sources.tables import materialise

# Benchmark items of fewer words are not looked for: one of a common word alone would empty the corpus.
LEAST_ITEM_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the network scores as toxic; it learns from the labels of those at hand.

    Each row is judged by its own text, whatever its id; empty texts stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), output="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the quality rules. Each row is judged by its own text; empty texts go."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    judged = quality_rules(docs, trusted, output="_quality")
    return judged.where("_quality.kept").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id. Rows of one id are one document; null ids stay."""
    return drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark; rows with a null id go by their own text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_passages(docs, benchmark, keep_nameless=False, least_words=LEAST_ITEM_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with their number and digests; one row for each row."""
    encoded = encode_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return digests(encoded, keep=["ids"])


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
