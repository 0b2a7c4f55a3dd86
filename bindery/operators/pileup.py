"""Pileup columns to counts, callers, substitution matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.functions.sequences import BASES, base_counts, count_char
from bindery.operators.intervals import point_join
from bindery.operators.kmers import cut
from bindery.operators.sites import SITE_KEYS, overlapping, renamed


def counts(pileup: DataFrame, mutation: tuple[str, str] = ("T", "C"), keep: tuple[str, ...] = ()) -> DataFrame:
    """chrom, pos, strand, k conversions and n = k + matches, and the columns to `keep`. Upper-case references of the pair only."""
    ref, alt = mutation
    pair = dict(zip("ACGT", "TGCA", strict=True))
    plus = F.col("ref") == ref
    k = F.when(plus, count_char(F.col("bases"), alt)).otherwise(count_char(F.col("bases"), pair[alt].lower()))
    n = k + F.when(plus, count_char(F.col("bases"), ".")).otherwise(count_char(F.col("bases"), ","))
    return pileup.where(F.col("ref").isin(ref, pair[ref])).select("chrom", "pos", F.when(plus, "+").otherwise("-").alias("strand"), k.alias("k"), n.alias("n"), *keep)


def naive_sites(pileup: DataFrame, min_transitions: int = 2, reference: str = "T", mutation: str = "C") -> DataFrame:
    """Every conversion site with enough transitions: score is their number, occupancy null, coverage the raw depth."""
    c = counts(pileup.withColumn("depth", F.coalesce(F.col("depth"), F.length("bases"))) if "depth" in pileup.columns else pileup.withColumn("depth", F.length("bases")), (reference, mutation))
    depth = pileup.select("chrom", "pos", F.length("bases").cast("long").alias("coverage")) if "depth" not in pileup.columns else pileup.select("chrom", "pos", F.col("depth").cast("long").alias("coverage"))
    return c.where(F.col("k") >= min_transitions).join(depth, ["chrom", "pos"]).select(
        F.col("chrom").alias("seqid"), F.col("pos").alias("position"), F.col("k").alias("transitions"), "coverage", F.col("k").cast("double").alias("score"), "strand", F.lit(None).cast("double").alias("occupancy")
    )


def site_universe(genome: DataFrame, base: str = "T") -> DataFrame:
    """Each position of a base on + and of its complement on -, 1-based, upper case only."""
    other = dict(zip("ACGT", "TGCA", strict=True))[base]
    at = cut(genome.select("seqid", "seq"), 1).select("seqid", "begin", F.posexplode(F.split("seq", "")).alias("p", "base"))
    return at.where(F.col("base").isin(base, other)).select("seqid", (F.col("begin") + F.col("p") + 1).alias("pos"), "base", F.when(F.col("base") == base, "+").otherwise("-").alias("strand"))


def site_universe_within(genome: DataFrame, annots: DataFrame, base: str = "T") -> DataFrame:
    """The same inside annotations, on the strand of each, lower case too; a position in several counts once."""
    upper = genome.select("seqid", F.upper("seq").alias("seq"))
    sites = site_universe(upper, base).withColumnRenamed("pos", "position")
    return overlapping(sites, annots).withColumnRenamed("position", "pos")


def strand_coverage(pileup: DataFrame, annots: DataFrame) -> DataFrame:
    """annot_id, offset (5' to 3'), coverage: depth of the annotation's strand at each covered position inside it."""
    depth = lambda fwd: base_counts(F.col("bases"), fwd)["coverage"]
    both = F.explode(F.array(F.struct(F.lit("+").alias("strand"), depth(True).alias("coverage")), F.struct(F.lit("-").alias("strand"), depth(False).alias("coverage")))).alias("d")
    points = pileup.select(F.col("chrom").alias("seqid"), F.col("pos").alias("position"), both).select("seqid", "position", "d.*").where("coverage > 0")
    hits = point_join(points, renamed(annots.select("annot_id", "seqid", "strand", "start_pos", "end_pos")), SITE_KEYS)
    offset = F.when(F.col("strand") == "+", F.col("position") - F.col("start_pos")).otherwise(F.col("end_pos") - F.col("position"))
    return hits.select("annot_id", offset.alias("offset"), "coverage")


def transition_matrix(pileup: DataFrame, min_coverage: int = 1) -> DataFrame:
    """ref, alt, n: mutations of the forward strand; the diagonal holds the matches."""
    c = base_counts(F.col("bases"), True)
    rows = pileup.where(F.col("ref").isin(*BASES)).select("ref", *[v.alias(k) for k, v in c.items()]).where(F.col("coverage") >= min_coverage)
    sums = rows.groupBy("ref").agg(*[F.sum(F.when(F.col("ref") == b, F.col("coverage") - F.col("mutations")).otherwise(F.col(b))).alias(b) for b in BASES])
    return sums.select("ref", F.expr("stack(4, 'A', A, 'C', C, 'G', G, 'T', T) as (alt, n)"))


def transition_probabilities(matrix: DataFrame) -> DataFrame:
    """ref, alt, joint, conditional: shares of all mutations, and of those of a base; the diagonal is zero."""
    off = matrix.withColumn("n", F.when(F.col("ref") == F.col("alt"), 0).otherwise(F.col("n")))
    rows = off.groupBy("ref").agg(F.sum("n").alias("row"))  # at most four rows
    total = off.agg(F.sum("n").alias("total"))
    return off.join(F.broadcast(rows), "ref").crossJoin(F.broadcast(total)).select("ref", "alt", F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(0.0).alias("joint"), F.when(F.col("row") > 0, F.col("n") / F.col("row")).otherwise(0.0).alias("conditional"))


def transition_margins(matrix: DataFrame) -> DataFrame:
    """ref, alt, level, n, joint, conditional: mutations of each pair (level 0), each reference (1), each read base (2) and all (3), with null
    for what is summed over; their share of all mutations, and of those of their reference. One aggregate over grouping sets."""
    off = matrix.where("ref <> alt")
    sums = off.cube("ref", "alt").agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n"))
    rows, total = sums.where("level = 1").select("ref", F.col("n").alias("row")), sums.where("level = 3").select(F.col("n").alias("total"))
    full = sums.join(F.broadcast(rows), "ref", "left").crossJoin(F.broadcast(total))  # at most four rows, and one
    return full.select("ref", "alt", "level", "n", F.try_divide(F.col("n"), F.col("total")).alias("joint"), F.try_divide(F.col("n"), F.coalesce("row", "total")).alias("conditional"))


def histogram(counts_: DataFrame, k: str = "k", n: str = "n", below: int = 1000, pseudo: int = 0) -> DataFrame:
    """Rows of each (k, n) with n under `below`."""
    return counts_.where(F.col(n) < below).groupBy(k, n).agg((F.count(F.lit(1)) + pseudo).alias("count"))
