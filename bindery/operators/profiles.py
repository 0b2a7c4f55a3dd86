"""Profiles of site occupancy around annotations: metagenes, heat maps, bootstrap, processing index."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators.intervals import point_join
from bindery.operators.lineage import cut
from bindery.operators.sites import ordinal

KEYS = (("seqid", "a_seqid"), ("strand", "a_strand"))


def _around(annots: DataFrame, end: str, outside: int, inner: int) -> DataFrame:
    """Windows of outside + inner + 1 positions at the 5' (start) or 3' (stop) end, mirrored on the minus strand."""
    plus = F.col("strand") == "+"
    five = end == "start"
    at = F.when(plus == F.lit(five), F.col("start_pos")).otherwise(F.col("end_pos"))
    before, after = (outside, inner) if five else (inner, outside)
    return annots.select("annot_id", F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), (at - F.when(plus, before).otherwise(after)).alias("start_pos"), (at + F.when(plus, after).otherwise(before)).alias("end_pos"))


def offsets(sites: DataFrame, windows: DataFrame, sense: bool = True) -> DataFrame:
    """annot_id, offset in reading direction, occupancy: hits of sites in windows of the same (or other) strand."""
    w = windows if sense else windows.withColumn("a_strand", F.when(F.col("a_strand") == "+", "-").otherwise("+")).withColumn("flipped", F.lit(True))
    hits = point_join(sites.select("seqid", "strand", "position", "occupancy"), w, KEYS)
    forward = (F.col("a_strand") == "+") == F.lit(sense)
    off = F.when(forward, F.col("position") - F.col("start_pos")).otherwise(F.col("end_pos") - F.col("position"))
    return hits.select("annot_id", off.alias("offset"), "occupancy")


def profile(sites: DataFrame, annots: DataFrame) -> DataFrame:
    """offset, total: occupancy by place in annotations, over all of them."""
    w = annots.select("annot_id", F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), "start_pos", "end_pos")
    return offsets(sites, w).groupBy("offset").agg(F.sum("occupancy").alias("total"))


def dense(sums: DataFrame, width: int, n: int) -> DataFrame:
    """offset 0..width-1, mean: sums by n with zeros where nothing was hit; `width` rows."""
    grid = sums.sparkSession.range(width).withColumnRenamed("id", "offset")
    return grid.join(F.broadcast(sums), "offset", "left").select("offset", (F.coalesce("total", F.lit(0.0)) / n).alias("mean"))


def smooth(mean: DataFrame, window: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Centred moving mean that narrows at the ends; over the offsets of a profile."""
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("offset").rowsBetween(-(window // 2), (window - 1) // 2)
    return mean.withColumn("mean", F.avg("mean").over(w))


def smooth_flat(mean: DataFrame, half: int, width: int) -> DataFrame:
    """Centred moving mean whose first and last `half` values repeat the first and last full ones."""
    w = Window.partitionBy(F.lit(0)).orderBy("offset")
    full = F.avg("mean").over(w.rowsBetween(-half, half))
    inner = mean.withColumn("full", full)
    place = F.least(F.greatest(F.col("offset"), F.lit(half)), F.lit(width - 1 - half))
    flat = inner.select(F.col("offset").alias("o"), F.col("full").alias("smoothed"))
    return mean.withColumn("o", place).join(F.broadcast(flat), "o").select("offset", F.col("smoothed").alias("mean"))


def metagene(sites: DataFrame, annots: DataFrame, upstream: int, downstream: int, gene: int, window: int = 0, sense: bool = True) -> DataFrame:
    """offset, mean: mean occupancy around the 5' end, then around the 3' end, upstream + downstream + 2 gene + 2 values.

    Occupancy is summed by offset before zeros are filled in; smoothing is linear, so the mean is smoothed."""
    n = annots.count()
    parts = []
    for end, outside in (("start", upstream), ("stop", downstream)):
        size = outside + gene + 1
        sums = offsets(sites, _around(annots, end, outside, gene), sense).groupBy("offset").agg(F.sum("occupancy").alias("total"))
        mean = dense(sums, size, max(n, 1))
        mean = smooth(mean, window) if window else mean
        parts.append(mean.withColumn("offset", F.col("offset") + (0 if end == "start" else upstream + gene + 1)))
    return parts[0].unionByName(parts[1])


def raw_matrix(sites: DataFrame, annots: DataFrame, end: str, outside: int, inner: int, sense: bool = True) -> DataFrame:
    """annot_id, values: the occupancy around one end of each annotation, one array in reading direction a row, zeros
    where nothing was hit; annotations without a hit are rows of zeros."""
    size = outside + inner + 1
    sums = offsets(sites, _around(annots, end, outside, inner), sense).groupBy("annot_id", "offset").agg(F.sum("occupancy").alias("o"))
    found = sums.groupBy("annot_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("offset").cast("int"), "o"))).alias("m"))  # at most `size` entries
    values = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0.0)))
    return annots.select("annot_id").join(found, "annot_id", "left").select("annot_id", values.alias("values"))


#: Poisson weights of a bootstrap: how often an annotation is drawn, by an even number in [0, 1).
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8)]


def weight(draw: Column, annot_id: Column, seed: int) -> Column:
    """Poisson(1) weight of an annotation in a draw, from two steps of an arithmetic generator."""
    step = (draw * 7919 + F.pmod(annot_id, F.lit(2147483647)) * 104729 + seed) * 48271 % 2147483647
    u = ((step + draw * 31) * 16807 % 2147483647) / 2147483647.0
    out = F.lit(len(POISSON))
    for k in range(len(POISSON) - 1, -1, -1):
        out = F.when(u < POISSON[k], k).otherwise(out)
    return out


def bootstrap(sites: DataFrame, annots: DataFrame, upstream: int, gene: int, draws: int, seed: int = 42) -> DataFrame:
    """draw, offset, mean: each draw resamples the annotations with replacement.

    How often an annotation is drawn is Poisson(1), which is what drawing as many as there are comes to, and follows
    from its id and the draw alone; so draws are added up in place, and only draws x offsets sums are shuffled."""
    spark = annots.sparkSession
    each = F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")
    drawn = lambda df, *cols: df.select(*cols, "annot_id", each).withColumn("w", weight(F.col("draw").cast("long"), F.col("annot_id").cast("long"), seed)).where("w > 0")
    hits = offsets(sites, _around(annots, "start", upstream, gene)).groupBy("annot_id", "offset").agg(F.sum("occupancy").alias("o"))
    sums = drawn(hits, "offset", "o").groupBy("draw", "offset").agg(F.sum(F.col("o") * F.col("w")).alias("total"))
    counts = drawn(annots).groupBy("draw").agg(F.sum("w").alias("n"))  # one row a draw
    grid = spark.range(draws).select(F.col("id").cast("int").alias("draw")).crossJoin(F.broadcast(spark.range(upstream + gene + 1).withColumnRenamed("id", "offset")))
    full = grid.join(sums, ["draw", "offset"], "left").join(F.broadcast(counts), "draw", "left")
    return full.select("draw", "offset", F.coalesce(F.col("total") / F.col("n"), F.lit(0.0)).alias("mean"))


def block_counts(n: int, per: int, block: int, draws: int, seed: int) -> np.ndarray:
    """How many of n draws with replacement from n rows fall into a block of `per` rows, for each draw.

    Rows are halved, block by block, down to the one asked for; how many fall to the left is binomial, by a generator that
    follows from the half alone. So every task finds the same numbers, and those of all blocks add up to n."""
    low, high, counts = 0, -(-n // per), np.full(draws, n, np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left, whole = (middle - low) * per, min(high * per, n) - low * per
        to_left = np.random.default_rng([seed, low, high]).binomial(counts, left / whole)
        low, high, counts = (low, middle, to_left) if block < middle else (middle, high, counts - to_left)
    return counts


def block_weights(n: int, per: int, block: int, draws: int, seed: int) -> np.ndarray:
    """draws x rows of a block: how often each row is drawn."""
    size = min(per, n - block * per)
    return np.random.default_rng([seed, block]).multinomial(block_counts(n, per, block, draws, seed), np.full(size, 1 / size))


def bootstrap_exact(sites: DataFrame, annots: DataFrame, upstream: int, gene: int, draws: int, seed: int = 42, per: int = 4096) -> DataFrame:
    """draw, offset, mean: in each draw exactly as many annotations as there are, with replacement.

    Annotations are numbered by annot_id and dealt into blocks of `per`. A task has the profile of one block, at most `per` rows
    at each offset, and draws all its weights itself (see `block_weights`), so that only draws x offsets sums leave it."""
    spark = annots.sparkSession
    size, n = upstream + gene + 1, annots.count()
    numbered = cut(ordinal(annots.select("annot_id").withColumn("_one", F.lit(1).cast("long")), "_one", "annot_id").select("annot_id", "ordinal"))
    sums = offsets(sites, _around(annots, "start", upstream, gene)).groupBy("annot_id", "offset").agg(F.sum("occupancy").alias("o"))
    blocks = sums.join(numbered, "annot_id").select(F.floor(F.col("ordinal") / per).alias("block"), (F.col("ordinal") % per).alias("row"), F.col("offset").cast("int").alias("offset"), F.col("o").cast("double").alias("o"))

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        weights = block_weights(n, per, block, draws, seed)
        profile = np.zeros((weights.shape[1], size))
        pdf = pdf.sort_values(["row", "offset"])
        profile[pdf["row"].to_numpy(int), pdf["offset"].to_numpy(int)] = pdf["o"].to_numpy(float)
        draw, offset = np.divmod(np.arange(draws * size), size)
        return pd.DataFrame({"draw": draw, "offset": offset, "total": (weights @ profile).ravel()})

    total = blocks.groupBy("block").applyInPandas(add_up, "draw int, offset bigint, total double").groupBy("draw", "offset").agg(F.sum("total").alias("total"))
    grid = spark.range(draws).select(F.col("id").cast("int").alias("draw")).crossJoin(F.broadcast(spark.range(size).withColumnRenamed("id", "offset")))
    return grid.join(total, ["draw", "offset"], "left").select("draw", "offset", (F.coalesce("total", F.lit(0.0)) / max(n, 1)).alias("mean"))


def interval_of(draws: DataFrame, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """offset, lower, upper: linear-interpolation quantiles over the draws."""
    return draws.groupBy("offset").agg(F.expr(f"percentile(mean, {low}D)").alias("lower"), F.expr(f"percentile(mean, {high}D)").alias("upper"))


def heatmap(sites: DataFrame, annots: DataFrame, xbins: int, ybins: int, scaled: bool = False) -> DataFrame:
    """y, x, mean: annotations in order of size, shrunk to xbins places each and averaged over ybins groups of rows.

    scaled puts every annotation on the same xbins places; otherwise places are those of the longest annotation
    and cells beyond an annotation's end are left out."""
    size = F.col("end_pos") - F.col("start_pos") + 1
    n, longest = annots.agg(F.count(F.lit(1)), F.max(size)).first()
    step = max(1, round((n or 0) / ybins))
    w = annots.select("annot_id", F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), "start_pos", "end_pos", size.alias("size"), F.floor(F.col("ordinal") / step).alias("y"))
    whole = F.col("size") if scaled else F.lit(longest or 1)
    hits = offsets(sites, w.drop("size", "y")).join(w.select("annot_id", "size", "y"), "annot_id")
    x = F.least(F.floor(F.col("offset") * xbins / whole), F.lit(xbins - 1)).cast("long")
    cells = hits.groupBy("y", x.alias("x")).agg(F.sum("occupancy").alias("total"))
    rows = w.groupBy("y").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    grid = rows.crossJoin(F.broadcast(annots.sparkSession.range(xbins).withColumnRenamed("id", "x")))
    if not scaled:
        grid = grid.where(F.col("x") <= F.floor((F.col("size") - 1) * xbins / F.lit(longest or 1)))
    return grid.join(cells, ["y", "x"], "left").select("y", "x", (F.coalesce("total", F.lit(0.0)) / F.col("rows")).alias("mean"))


def processing_index(sites: DataFrame, annots: DataFrame, width: int) -> DataFrame:
    """log2(downstream / max(1, upstream - downstream)) of mean occupancy sums at 3' ends; both sums begin at 1."""
    sums = offsets(sites, _around(annots, "stop", width, width)).agg(
        F.coalesce(F.sum(F.when(F.col("offset") < width, F.col("occupancy"))), F.lit(0.0)).alias("u"), F.coalesce(F.sum(F.when(F.col("offset") > width, F.col("occupancy"))), F.lit(0.0)).alias("d")
    )
    up, down = F.col("u") + 1, F.col("d") + 1
    return sums.select(F.log2(down / F.greatest(F.lit(1.0), up - down)).alias("processing_index"))
