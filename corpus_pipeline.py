"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, pseudonyms, packing.

Every stage works on all that its predecessor kept. All but the last return the columns of
``documents``; the last returns the packed pieces.

Defined results: a document whose text is null, empty or blank, or has under twenty words,
is rejected by the quality rules. Of repeated rows only the first keeps its lines, so the
others go as empty. Rows that share an id, or have none, but not the text are judged each by
its own text; near-dedup keeps those with the least id of their group. Further columns, with
any names, are passed on up to packing. An empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendmart.llm import line_dedup, packing, pseudonyms, quality_rules, registry, simhash_near
from lendmart.llm.common import quoted, stored


def _counted(docs: DataFrame, before: DataFrame) -> DataFrame:
    """The columns of ``documents`` in their order, n_chars as the text now has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*quoted(before.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes failing lines out and rejects documents that lose too much."""
    return _counted(quality_rules.clean_documents(docs), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out; a document that has none left goes."""
    return _counted(line_dedup.without_repeats(docs, drop_empty=True), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group."""
    return simhash_near.unique_documents(docs).select(*quoted(docs.columns))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by linked pseudonyms."""
    return _counted(pseudonyms.pseudonymised(docs, registry.PSEUDONYM_KEY), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences: the pieces with their ids."""
    return packing.pack(docs, public_tokenizers.path(registry.TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("pii", private_data),
    ("packing", packed),
]

#: SQL has no tokenizer, Feistel permutation or XXH64; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
