"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality_rules drops documents that fail the rules; minmax_dedup leaves one
document of each near-duplicate group (five words, similarity 0.8);
substring_dedup cuts byte passages that occur twice; secret_scan replaces
secrets by their kind; packing gives the pieces of the token sequences.

In every stage a null text counts as empty, an empty table gives an empty one,
and extra columns go along unchanged (packing has its own columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltwatch.llm.common import documents, written
from voltwatch.llm.host_rules import keep_good
from voltwatch.llm.minmax_dedup import keep_one
from voltwatch.llm.packing import pack
from voltwatch.llm.secret_scan import redact
from voltwatch.llm.substring_index import remove_repeats


#: Bytes of a repeated passage; 50 words of `documents` have about 250 to 330.
PASSAGE = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a base rule (null and empty texts among them) or a soft rule on a bad host; copies share a verdict."""
    return keep_good(docs)


def minmax_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays, one row of it; texts without words stay."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte of a PASSAGE-byte string that starts anywhere else; all rows stay, wholly cut texts as empty ones."""
    return remove_repeats(docs, PASSAGE)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets for every secret; all rows stay."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens; an empty text is its end token."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minmax_dedup", minmax_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Shingle similarity, substring marks and byte BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
