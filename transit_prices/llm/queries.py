"""The operators' registered queries: thin calls with production parameters on
whole tables of the given folder, and the digest columns of their contracts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chunks, hmm, langid, licenses, mixing, negatives, pieces, quality, repair, simhash, tokencount, topk
from .common import load, remainder, shared_folder, written


def vocabulary_file(name: str) -> str:
    """A vocabulary file of the public tokenizers: the folder is a parameter of the
    environment, with the installed package as its default."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    dictionaries = langid.sample_texts(docs.where(~held_out))
    found = langid.identify(docs, dictionaries)
    return found.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("best").alias("lang_pred"), "score", "margin",
        F.col("lang").alias("lang_or_rejected"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    path = vocabulary_file("word_bpe_49k.json")
    return bpe.encode_documents(docs, path, bpe.build_lexicon(docs, path), ids=False)


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return hmm.score(docs, remainder(F.col("doc_id"), 10) == 0, part_each_round=False)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat token files (16-bit ids, end-of-document 50256), counted."""
    import public_tokenizers

    docs = load(spark, sf_dir, "documents")
    folder, separator = shared_folder(spark), 50256
    order = written(
        tokencount.write_flat(docs, folder, tokencount.read_ranks(vocabulary_file("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, separator)
    )
    if order.isEmpty():
        return order.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    files = tokencount.flat_files(spark, folder).join(order.select("file").distinct(), "file", "left_semi")
    counts = tokencount.count_tokens(files, folder, separator)
    # both sides have a row for each document: never a broadcast
    return order.join(counts.hint("merge"), ["file", "nth"]).select("doc_id", "n_tokens")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/thousand/doc_id.txt."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdict(quality.repetition(load(spark, sf_dir, "documents")))
    return judged.drop("spans")


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its text without repeated chunks, and what was cut."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    cut = F.col("cut")
    return chunks.cut_rows(docs).select(
        F.col("row.doc_id").alias("doc_id"), "text",
        F.coalesce(cut["removed_chunks"], F.lit(0)).alias("removed_chunks"),
        F.coalesce(F.aggregate(cut["spans"], F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"]), F.lit(0)).alias("removed_bytes"),
        cut["spans"].alias("removed_spans"), cut["first_doc_ids"].alias("first_doc_ids"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(load(spark, sf_dir, "conversations"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(load(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"), ids=False)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("id") % 100 == 0)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_bpe": op2_bpe,
    "op3_hmm": op3_hmm,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_mix": op9_mix,
    "op10_top_k": op10_top_k,
    "op11_repair": op11_repair,
    "op12_pieces": op12_pieces,
    "op13_negatives": op13_negatives,
}

#: DuckDB SQL where SQL can express the operator.
ORACLE_SQL = {
    "op9_mix": r"""
WITH rows AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents
), per AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), nth AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS n FROM per
), w AS (
  SELECT *, ([3.0, 1.0, 2.0])[(n % 3) + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM nth
), r AS (SELECT *, cap / weight AS ratio FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level, row_number() OVER (ORDER BY ratio, source IS NULL, encode(source)) AS place
  FROM r WINDOW b AS (ORDER BY ratio, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, coalesce(arg_min(level, place) FILTER (level <= ratio) OVER () * weight, cap)) AS target FROM l
), e AS (
  SELECT rows.doc_id, rows.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN least(target * 1.0::DOUBLE / source_size, 2.0) ELSE 0.0::DOUBLE END AS e,
    ((('0x' || substr(md5(coalesce(rows.doc_id::VARCHAR, '') || ':' || digest || ':' || (row_number() OVER (PARTITION BY rows.doc_id, rows.source, digest) - 1) || ':9'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM rows JOIN t ON rows.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, floor(e)::INT AS whole, e - floor(e) AS p, (u / (1 - u)) * ((1 - (e - floor(e))) / (e - floor(e))) AS odds FROM e
), d AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN odds / (1 + odds) END AS rank,
    max(target) OVER (PARTITION BY source) - sum(size * whole) OVER (PARTITION BY source) AS rest
  FROM q
), f AS (
  SELECT *, rank IS NOT NULL AND
    sum(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - sum(size) OVER (PARTITION BY source, rank) / 2.0 <= rest AS fits
  FROM d
), z AS (SELECT *, whole + coalesce((rank <= max(rank) FILTER (fits) OVER (PARTITION BY source))::INT, 0) AS copies FROM f)
SELECT doc_id, source, size, source_size, target, copies::INT AS copies, (size * copies)::BIGINT AS taken FROM z
""",
    "op10_top_k": r"""
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op13_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM s WHERE same) WHERE nth <= 5
), r AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
""",
}
