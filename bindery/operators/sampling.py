"""Seeded random draws: annotations, by sequence or weight, and sequences around random places in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.operators.intervals import point_join
from bindery.operators.kmers import windows
from bindery.operators.sites import ordinal, running


def uniform(seed: int, *cols: Column | str) -> Column:
    """An even number in [0, 1) that depends on the columns and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 11).cast("double") / float(1 << 53)


def _numbered(annots: DataFrame) -> DataFrame:
    """annots with `ordinal`, consecutive within each sequence."""
    return ordinal(annots.withColumn("_h", F.xxhash64("seqid").bitwiseAND((1 << 52) - 1)), "_h", "annot_id").drop("_h")


def draw(annots: DataFrame, n: int, seed: int = 42, weights: DataFrame | None = None, begin: int = 0) -> DataFrame:
    """n annotations drawn with replacement, with `draw` from `begin` on. weights (seqid, weight): sequences are drawn by
    weight first, and then an annotation of theirs, each alike; sequences without annotations are never drawn."""
    spark = annots.sparkSession
    numbered = _numbered(annots)
    draws = spark.range(begin, begin + n).withColumnRenamed("id", "draw")
    spans = numbered.groupBy("seqid").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("size"))
    if weights is None:
        total = spans.agg(F.sum("size")).first()[0] or 0
        picked = draws.select("draw", F.floor(uniform(seed, "draw") * total).alias("ordinal"))
    else:
        weighed = running(spans.join(weights.where("weight > 0").groupBy("seqid").agg(F.sum("weight").alias("weight")), "seqid"), "first", "weight")
        total = weighed.agg(F.sum("weight")).first()[0] or 0
        shares = weighed.select("first", "size", (F.col("upto") - F.col("weight")).alias("start_pos"), (F.col("upto") - 1).alias("end_pos"))
        at = draws.withColumn("position", F.floor(uniform(seed, "draw") * total).cast("long"))
        hit = point_join(at, shares, (), width=max(1, int(total) // 1000))
        picked = hit.select("draw", (F.col("first") + F.floor(uniform(seed + 1, "draw") * F.col("size"))).alias("ordinal"))
    return picked.join(numbered, "ordinal").drop("ordinal")


def draw_from(annots: DataFrame, seqid: str, n: int, seed: int = 42) -> DataFrame:
    """n annotations of one sequence, drawn with replacement; none if it has none."""
    return draw(annots.where(F.col("seqid") == seqid), n, seed)


def random_sequences(annots: DataFrame, genome: DataFrame, n: int, width: int, seed: int = 42, weights: DataFrame | None = None, rounds: int = 20) -> DataFrame:
    """draw, seqid, position, strand, seq: n sequences of 2 width + 1 letters around random places in random annotations.

    Draws that reach out of their sequence or hold an N are made again: a round draws as many as are missing, by the
    share of good ones so far, and the first n good draws count. Fewer come back if `rounds` do not give n."""
    made, good, found = 0, 0, None
    for _ in range(rounds):
        share = max(good / made, 0.05) if made else 0.8
        more = draw(annots, max(16, int((n - good) / share * 1.2)), seed, weights, made)
        place = F.col("start_pos") + F.floor(uniform(seed + 2, "draw") * (F.col("end_pos") - F.col("start_pos") + 1))
        got = windows(more.select("draw", "seqid", place.cast("long").alias("position"), "strand"), genome, width).where(~F.col("seq").contains("N")).select("draw", "seqid", "position", "strand", "seq")
        made += max(16, int((n - good) / share * 1.2))
        found = got if found is None else found.unionByName(got)
        good = found.count()
        if good >= n:
            break
    return found.orderBy("draw").limit(n)


def negative_set(sites: DataFrame, annots: DataFrame, genome: DataFrame, n: int, width: int, seed: int = 42) -> DataFrame:
    """Random sequences whose chromosomes are drawn as often as sites lie on them."""
    return random_sequences(annots, genome, n, width, seed, sites.groupBy("seqid").agg(F.count(F.lit(1)).alias("weight")))


def negative_lines(sequences: DataFrame) -> DataFrame:
    """value: FASTA records of a negative set."""
    return sequences.select(F.concat(F.lit(">"), F.concat_ws(":", F.lit("random"), "draw", "seqid", "position", "strand"), F.lit("\n"), F.col("seq")).alias("value"))
