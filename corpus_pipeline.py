"""Training-corpus pipeline over ``documents``: quality rules, exact dedup,
near-duplicate removal, substring dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; ``run`` writes it as Parquet and rereads it as the next
stage's documents.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import documents, store
from tessera.llm.host_quality import keep_quality
from tessera.llm.ngram_join import keep_unlinked
from tessera.llm.packing import pack_documents
from tessera.llm.radix_dedup import keep_distinct
from tessera.llm.substring_dedup import remove_substrings


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hosts judged against the fitted prior."""
    return keep_quality(docs, host_limit=None)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_distinct(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8."""
    return keep_unlinked(docs, size=5, limit_pct=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_substrings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# Tokenization is not expressible in SQL; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
