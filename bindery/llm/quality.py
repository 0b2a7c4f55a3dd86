"""Quality classifier by importance resampling.

Two hashed n-gram models, of texts labelled good and of all raw texts, give each document its importance: the
log of how much likelier the target model makes the text. With standard Gumbel noise on it, drawn from the
id, the k largest sums are a sample of k documents without replacement, in which a document's chance follows
its importance. k is the share of good texts among labelled ones, times the documents. `temperature` divides
the importance: at 1 (the default) the sample is that of the two models, at larger values it is more even.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import cut, release, table
from bindery.llm.lm_scoring import mix, word_hashes

BUCKETS = 1 << 14
#: At most so many labelled rows fit the target model and the share; the rows with the smallest hashes.
LABELLED = 50_000


def features(texts: list[str | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and how many each text has."""
    h, n = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    pair = mix(h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:]) if len(h) > 1 else h[:0]
    doc = np.repeat(np.arange(len(n)), n)
    inner = doc[:-1] == doc[1:] if len(doc) > 1 else np.empty(0, bool)
    ids = np.r_[h, pair[inner]] % np.uint64(buckets)
    docs = np.r_[doc, doc[:-1][inner]] if len(doc) else doc
    by = np.argsort(docs, kind="stable")
    return ids[by].astype(np.int64), np.bincount(docs, minlength=len(n))


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                total += np.bincount(features(batch.column(0).slice(s, 512).to_pylist(), buckets)[0], minlength=buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["bucket", "n"])

    return run


def model(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Add-one log probabilities of the buckets over all rows of a one-column table; `buckets` rows reach the driver."""
    rows = texts.mapInArrow(_counts(buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.ones(buckets)
    for r in rows:
        counts[r["bucket"]] += r["n"]
    return np.log(counts / counts.sum())


def ratio(text: Column, weights: np.ndarray) -> Column:
    """Sum of the log ratios of the features of a text; zero without words."""

    @F.pandas_udf("double")
    def total(column: pd.Series) -> pd.Series:
        out = []
        for s in range(0, len(column), 512):
            ids, n = features(column.iloc[s : s + 512].tolist(), len(weights))
            out.append(np.bincount(np.repeat(np.arange(len(n)), n), weights=weights[ids], minlength=len(n)))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return total(text)


def gumbel(key: Column) -> Column:
    """Standard Gumbel noise that depends on the key alone."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit("gumbel")), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """A threshold that k rows of finite values reach, by histograms over ever smaller ranges; repeated values stay together."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return float("inf")
    for _ in range(6):
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        counts = {int(r["b"]): r["count"] for r in df.where(F.col(column).between(low, high)).groupBy(place.alias("b")).count().collect()}
        for b in sorted(counts, reverse=True):
            if counts[b] >= k:
                break
            k -= counts[b]
        else:
            break
        low, high = low + b * width, min(high, low + (b + 1) * width)
        if counts[b] == k:
            break
    return low


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """(bucket weights, share of good texts): see `resample`. Labelled rows are used up to `labelled`."""
    order = F.xxhash64(F.col("doc_id"), F.lit("label"))
    sample = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(order, "doc_id").limit(labelled)
    known = cut(docs.select(F.col("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("text", "quality"))  # `labelled` ids at most are broadcast
    good, n = known.agg(F.count_if(F.col("quality") == 1), F.count(F.lit(1))).first()
    if not good:
        return np.zeros(buckets), 1.0
    return model(known.where("quality = 1").select("text"), buckets) - model(docs.select("text"), buckets), good / n


def resample(docs: DataFrame, labels: DataFrame, temperature: float = 1.0, **options) -> tuple[DataFrame, float]:
    """(docs with ratio and key, the key from which on rows are kept).

    A null or empty text has ratio zero, whatever its length a text is read whole. Null ids share their noise;
    rows whose keys tie with the last of the sample stay with it. Repeated rows are rows like others. Rows
    without a label, labels without a row, and an empty table do no harm; without good labels everything is
    kept. Columns named `ratio` or `key` are replaced.
    """
    weights, share = fit(docs, labels, **options)
    keyed = docs.withColumn("ratio", ratio(F.col("text"), weights)).withColumn("key", F.col("ratio") / temperature + gumbel(F.col("doc_id")))
    keys = cut(keyed.select("key"))
    return keyed, kth_largest(keys, "key", round(share * keys.count()))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ratio, key, kept: all documents, and whether the sample holds them."""
    keyed, least = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return keyed.select("doc_id", F.round("ratio", 9).alias("ratio"), F.round("key", 9).alias("key"), (F.col("key") >= least).alias("kept"))
