"""Joins of points and closed, 1-based intervals.

A range condition alone makes Spark compare all rows of an equi key, of which genomes have few. So
intervals are listed under each bin of `width` that they touch, a point has one bin, and the bin joins the
equi keys. Intervals longer than LONG bins use bins LONG times as wide, in a join of their own, which keeps
the number of listed rows near the number of intervals. Which of the two kinds occur is looked up first, over the
intervals alone, so that points are read and dealt out once where one does. Adaptive execution splits a bin that
many rows share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, LONG = 1000, 64


def _bin(c: Column, width: int) -> Column:
    return F.floor(c / width).cast("long")


def _levels(intervals: DataFrame, start: Column, stop: Column, width: int) -> list[tuple[DataFrame, int]]:
    """The intervals of each kind that occurs, with the width of its bins."""
    long = stop - start > width * LONG
    some = intervals.where(start <= stop).agg(F.bool_or(long).alias("long"), F.bool_or(~long).alias("short")).first()
    if some["long"] and some["short"]:
        return [(intervals.where(~long), width), (intervals.where(long), width * LONG)]
    return [(intervals, width * LONG if some["long"] else width)]


def _listed(intervals: DataFrame, start: Column, stop: Column, width: int) -> DataFrame:
    return intervals.withColumn("_bin", F.explode(F.sequence(_bin(start, width), _bin(stop, width))))


def _joined(points: DataFrame, intervals: DataFrame, on: tuple, pos: str, low: Column, high: Column, width: int, how: str) -> DataFrame:
    """on: pairs of (point column, interval column); interval columns must not be names of point columns."""
    i = _listed(intervals.withColumns({"_low": low, "_high": high}).where("_low <= _high"), F.col("_low"), F.col("_high"), width)
    p = points.withColumn("_pbin", _bin(F.col(pos), width))
    same = reduce(lambda a, b: a & b, [p[x] == i[y] for x, y in on], p["_pbin"] == i["_bin"])
    out = p.join(i, same & (p[pos] >= i["_low"]) & (p[pos] <= i["_high"]), how)
    return out.drop("_pbin", "_bin", "_low", "_high")


def point_join(points: DataFrame, intervals: DataFrame, on: tuple, how: str = "inner", pos: str = "position", low: Column | None = None, high: Column | None = None, width: int = WIDTH) -> DataFrame:
    """Points with the intervals [low, high] around them; how: inner, left_semi, left_anti or left."""
    low, high = F.col("start_pos") if low is None else low, F.col("end_pos") if high is None else high
    parts = _levels(intervals, low, high, width)
    if how == "left_anti" and len(parts) > 1:
        return reduce(lambda p, part: _joined(p, part[0], on, pos, low, high, part[1], "left_anti"), parts, points)
    if len(parts) == 1:
        return _joined(points, parts[0][0], on, pos, low, high, parts[0][1], how)
    if how == "left_semi":
        (short, w), (long, v) = parts
        found = _joined(points, short, on, pos, low, high, w, "left_semi")
        return found.unionByName(_joined(_joined(points, short, on, pos, low, high, w, "left_anti"), long, on, pos, low, high, v, "left_semi"))
    found = reduce(DataFrame.unionByName, [_joined(points, part, on, pos, low, high, w, "inner") for part, w in parts])
    if how == "inner":
        return found
    alone = point_join(points, intervals, on, "left_anti", pos, low, high, width)
    return found.unionByName(alone, allowMissingColumns=True)


def range_join(a: DataFrame, b: DataFrame, on: tuple, width: int = WIDTH) -> DataFrame:
    """Pairs of overlapping intervals (a_start, a_end) and (b_start, b_end), each once: under the first bin both touch."""
    la = _listed(a, F.col("a_start"), F.col("a_end"), width).withColumnRenamed("_bin", "_abin")
    lb = _listed(b, F.col("b_start"), F.col("b_end"), width)
    same = reduce(lambda x, y: x & y, [la[x] == lb[y] for x, y in on], la["_abin"] == lb["_bin"])
    first = la["_abin"] == F.greatest(_bin(la["a_start"], width), _bin(lb["b_start"], width))
    return la.join(lb, same & first & (la["a_start"] <= lb["b_end"]) & (lb["b_start"] <= la["a_end"])).drop("_abin", "_bin")


def extent(intervals: DataFrame, *keys: str) -> DataFrame:
    """Smallest start and largest end of each key."""
    return intervals.groupBy(*keys).agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count(F.lit(1)).alias("n"))


def insert(intervals: DataFrame, more: DataFrame) -> DataFrame:
    return intervals.unionByName(more)


def remove(intervals: DataFrame, gone: DataFrame, *keys: str) -> DataFrame:
    return intervals.join(gone, list(keys), "left_anti")


def closed(df: DataFrame, zero_based: bool) -> DataFrame:
    """0-based half-open starts made 1-based closed; raises at run time for intervals that end before they begin."""
    start = F.col("start_pos") + 1 if zero_based else F.col("start_pos")
    good = F.when(start <= F.col("end_pos"), start).otherwise(F.raise_error(F.lit("interval ends before it begins")).cast("long"))
    return df.withColumn("start_pos", good)
