"""Reads and pileups that keep arriving: the batch operators with a bound on how long state is kept.

Each takes a streaming table with an event time and gives one that a writer can start. `delay` says how late a row may
come; later ones are dropped, and state older than that is let go. On a table that is not streaming the same
functions work as batch operators, over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.operators import pileup as batch


def deduplicate(reads: DataFrame, delay: str, time: str = "arrived") -> DataFrame:
    """One read of each sequence that arrives within `delay` of the first; which of them is not determined, as they come in any
    order. A sequence that comes again later counts as new."""
    dated = reads.withWatermark(time, delay)
    return dated.dropDuplicatesWithinWatermark(["seq"]) if reads.isStreaming else dated.dropDuplicates(["seq"])


def conversions(pileups: DataFrame, window: str, delay: str, mutation: tuple[str, str] = ("T", "C"), time: str = "arrived") -> DataFrame:
    """begin, end, chrom, pos, strand, k, n: conversions and depth of each position, added up over the columns that arrive in a window of time.

    Columns of pileups are counted one by one, as in batch; their sums are what is kept as state, one row a position and window."""
    dated = pileups.withWatermark(time, delay)
    ref, alt = mutation
    counted = batch.counts(dated, (ref, alt), keep=(time,))
    sums = counted.groupBy(F.window(time, window).alias("w"), "chrom", "pos", "strand").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    return sums.select(F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "chrom", "pos", "strand", "k", "n")


def molecules(reads: DataFrame, delay: str, time: str = "arrived") -> DataFrame:
    """place, umi, n of reads (read_id, place, umi) with repeated deliveries of a read left out: exact counts for `umis.networks`, to be written in
    `update` or `complete` mode."""
    dated = reads.withWatermark(time, delay)
    once = dated.dropDuplicatesWithinWatermark(["read_id"]) if reads.isStreaming else dated.dropDuplicates(["read_id"])
    return once.groupBy("place", "umi").agg(F.count(F.lit(1)).alias("n"))
