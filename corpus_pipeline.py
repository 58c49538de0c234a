"""The corpus pipeline: five stages, each one operator on all that the one before kept.

``run`` writes every stage's result to the shared folder (``spark.checkpoint.dir``)
and reads it again as the next stage's documents. All stages but the last return the
columns of ``documents``.

Nulls, empty and repeated rows are handled as the stages' operators state; an empty
table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_prices.llm import bpe, chunks, mixing, quality, simhash
from transit_prices.llm.common import load, unpacked, written
from transit_prices.llm.queries import vocabulary_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or repeat themselves go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out of the text."""
    size = F.when(F.col("cut").isNull(), F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return unpacked(chunks.cut_rows(docs), docs.columns, text=F.col("text"), n_chars=size)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes: none, one or two rows."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every row of the mix."""
    path = vocabulary_file("word_bpe_49k.json")
    return bpe.encode_documents(docs, path, bpe.build_lexicon(docs, path))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: No SQL: XXH64 fingerprints, gear chunks and BPE are not expressible in it. The
#: tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
