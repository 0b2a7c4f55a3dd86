"""Exact deduplication by skew-safe combining.

Copies meet in three steps, and each compares whole normalised texts, not only digests: inside an
Arrow batch, inside a salted digest group, and among the winners of the salts. Texts of copies leave
a batch once, so a group with a third of all rows shuffles one text per batch and, salted by the place of the batch,
spreads over SALTS tasks; only one row per salt of a group meets in the last step.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.llm.common import one_space, release, table

SALTS = 64
LOCAL = "sha binary, norm string, ids array<bigint>, salt int"


def _local(salts: int):
    """Groups of each batch, with a salt that follows from the place of the batch: its partition and its number there. Ids play no part
    in it, so that copies with null or equal ids spread as well."""
    schema = pa.schema([("sha", pa.binary()), ("norm", pa.string()), ("ids", pa.list_(pa.int64())), ("salt", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            yield _grouped(batch, zlib.crc32(b"%d:%d" % (part, number)) % salts, schema)

    return run


def _grouped(batch: pa.RecordBatch, salt: int, schema: pa.Schema) -> pa.RecordBatch:
    groups: dict[bytes, list[tuple[str, list]]] = {}
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        norm = one_space(text)
        variants = groups.setdefault(hashlib.sha256(norm.encode("utf-8", "surrogatepass")).digest(), [])
        for other, ids in variants:
            if other == norm:
                ids.append(doc_id)
                break
        else:
            variants.append((norm, [doc_id]))
    rows = [(sha, norm, sorted(ids, key=lambda i: (i is None, i)), salt) for sha, v in groups.items() for norm, ids in v]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`.

    Texts are equal when they are identical after each run of white space became one space; a null text
    counts as empty. The smallest id of a group stays; null ids come last; of repeated rows with the same
    id one is marked as kept. An empty table gives no rows; other columns are not read.
    """
    local = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_local(salts), LOCAL)
    # Both uses below read this one exchange: they need the same columns of it.
    dealt = local.repartition("sha", "salt")
    group = Window.partitionBy("sha", "salt", "norm")
    salted = (
        dealt.withColumn("first", F.element_at("ids", 1)).withColumn("n", F.size("ids").cast("long"))
        .withColumn("salt_keep", F.min("first").over(group)).withColumn("salt_n", F.sum("n").over(group))
        .withColumn("salt_rank", F.row_number().over(group.orderBy(F.col("first").asc_nulls_last())))
    )
    whole = Window.partitionBy("sha", "norm")
    winners = (
        salted.where("salt_rank = 1")
        .withColumn("keep_id", F.min("salt_keep").over(whole)).withColumn("group_size", F.sum("salt_n").over(whole))
        .withColumn("rank", F.row_number().over(whole.orderBy(F.col("salt_keep").asc_nulls_last(), "salt")))
        .select(F.col("sha").alias("w_sha"), F.col("salt").alias("w_salt"), F.col("salt_keep").alias("w_keep"), "keep_id", "group_size", "rank")
    )
    rows = salted.select("sha", "salt", "salt_keep", "salt_rank", "ids")
    # Null-safe on all keys, or the optimiser filters nulls out below one of the two exchanges and makes them differ.
    joined = rows.join(winners, rows.sha.eqNullSafe(winners.w_sha) & rows.salt.eqNullSafe(winners.w_salt) & rows.salt_keep.eqNullSafe(winners.w_keep))
    return joined.select("*", F.posexplode("ids").alias("place", "id")).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        ((F.col("place") == 0) & (F.col("salt_rank") == 1) & (F.col("rank") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
with n as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, text_sha256
from n window w as (partition by text_sha256)
"""
