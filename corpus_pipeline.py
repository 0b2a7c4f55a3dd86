"""Corpus pipeline: quality, exact and near duplicates, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm import exact_dedup, near_copies, packing, pii, quality
from bindery.llm.common import cut, table


def _boxed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row in one column, so that no column of `docs` meets one that a stage derives."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the sample that importance resampling takes. Null and empty texts have an importance of zero; repeated
    rows stand for themselves; rows that tie with the last of the sample stay; without good labels all stay."""
    keyed, least = quality.resample(_boxed(docs), table(spark, sf_dir, "labels"))
    return keyed.where(F.col("key") >= least).select("_row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the smallest id, null ids last. Null and empty texts are equal.
    Rows are named by id and text digest, and repeated rows stay once."""
    name = lambda sha: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)
    kept = exact_dedup.exact_groups(docs).where("kept").select(name(F.col("text_sha256")).alias("_name"))
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return _boxed(docs).select(name(F.sha2(norm, 256)).alias("_name"), "_row").join(kept, "_name", "left_semi").dropDuplicates(["_name"]).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, Jaccard similarity of 0.8), that with the smallest id."""
    return near_copies.keep_one(docs)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by their kinds; lengths follow. Null texts stay null, and no row goes."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return pii.redact(_boxed(docs)).select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens. A null or empty text is the end token alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("pii", redact_personal), ("packing", pack)]

#: No stage but the second can be told in SQL; tests hold each stage's decisions against those of its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are cut from their lineage before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
