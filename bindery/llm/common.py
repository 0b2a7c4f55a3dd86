"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts: [\x20\x09-\x0D].
TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_space(text: str | None) -> str:
    """Each run of white space as one space; None as the empty text."""
    b = (text or "").encode("utf-8", "surrogatepass").translate(TO_SPACE)
    while b"  " in b:
        b = b.replace(b"  ", b" ")
    return b.decode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Words between white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that the cluster shares, named in spark.checkpoint.dir.

    Only a local master, whose executors are this process, may do without it and gets a temporary folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="bindery-checkpoint-"))
    return df.checkpoint()


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


_held: list = []


def per_worker(make):
    """One object for each argument in a Python worker, which Spark uses again for later tasks; see `release`."""
    kept = cache(make)
    _held.append(kept)
    return kept


def release() -> None:
    """What earlier tasks of other operators have kept in this worker is let go."""
    for kept in _held:
        kept.cache_clear()


def pieces_for(total: int, each: int, least: int = 8) -> int:
    """How many pieces of about `each` make `total`; grows with the data."""
    return max(least, -(-total // each))
