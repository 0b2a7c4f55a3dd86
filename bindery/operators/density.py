"""Decreasing densities of p-values, range by range.

The density of a group is the slope of the least concave majorant of its distribution. Majorants merge: that of all points is the
majorant of those of parts. So distinct p-values are dealt into ranges of their order; a table of one row for each range and group
tells how many values come before; each range gives the few corners of its own majorant, and a group's corners
alone meet in one task. Densities at p-values are then looked up range by range, with the knots that reach into each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators.lineage import cut

#: Distinct p-values of a range.
EACH = 200_000


def concave_majorant(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(knots, slope from each knot on) of the least concave majorant, by pooling segments whose slopes rise."""
    blocks: list[list[float]] = []  # width, rise, segments
    for s, r in zip(np.diff(x).tolist(), np.diff(y).tolist(), strict=True):
        blocks.append([s, r, 1])
        while len(blocks) > 1 and blocks[-1][1] * blocks[-2][0] >= blocks[-2][1] * blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    knots = x[np.r_[0, np.cumsum([b[2] for b in blocks])]]
    slopes = np.array([b[1] / b[0] for b in blocks])
    return knots, np.r_[slopes, slopes[-1]]


def corners(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the points that the majorant of these points touches at its bends, ends included."""
    kept: list[int] = []
    xs, ys = x.tolist(), y.tolist()
    for i in range(len(xs)):
        while len(kept) > 1 and (ys[i] - ys[kept[-1]]) * (xs[kept[-1]] - xs[kept[-2]]) >= (ys[kept[-1]] - ys[kept[-2]]) * (xs[i] - xs[kept[-1]]):
            kept.pop()
        kept.append(i)
    return np.array(kept, int)


def _padded(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(knots, density from each knot on) of points of a distribution, on [0, 1]."""
    if x[-1] != 1:
        x, y = np.r_[x, 1.0], np.r_[y, 1.0]
    if x[0] != 0:
        x, y = np.r_[0.0, x], np.r_[0.0, y]
    return concave_majorant(x, y) if len(x) > 1 else (np.array([0.0, 1.0]), np.array([1.0, 1.0]))


def _dealt(values: DataFrame, by: str, ranges: int | None) -> tuple[DataFrame, int]:
    """Distinct p-values of each group with their count c, their range, and how many values of the group come before it and in all; and the number of ranges."""
    counts = cut(values.groupBy(by, "p").agg(F.count(F.lit(1)).alias("c")))
    n = ranges or max(1, -(-counts.count() // EACH))
    rows = cut(counts.repartitionByRange(n, by, "p").withColumn("_range", F.spark_partition_id())) if n > 1 else counts.withColumn("_range", F.lit(0))
    sums = rows.groupBy(by, "_range").agg(F.sum("c").alias("_s"))
    group = Window.partitionBy(by)  # one row a range
    before = F.coalesce(F.sum("_s").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col(by).alias("_by"), F.col("_range").alias("_r"), before.alias("_before"), F.sum("_s").over(group).alias("_total"))
    return rows.join(sums, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_r"))).drop("_by", "_r"), n


def _knots(rows: DataFrame, by: str) -> DataFrame:
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("p")
        x, y = pdf["p"].to_numpy(float), (int(pdf["_before"].iloc[0]) + np.cumsum(pdf["c"].to_numpy(np.int64))) / int(pdf["_total"].iloc[0])
        k = corners(x, y)
        return pd.DataFrame({by: pdf[by].iloc[0], "x": x[k], "y": y[k]})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        knots, slopes = _padded(pdf["x"].to_numpy(float), pdf["y"].to_numpy(float))
        return pd.DataFrame({by: pdf[by].iloc[0], "x": knots, "f": slopes})

    return rows.groupBy(by, "_range").applyInPandas(part, f"{by} bigint, x double, y double").groupBy(by).applyInPandas(whole, f"{by} bigint, x double, f double")


def grenander(values: DataFrame, by: str, ranges: int | None = None) -> DataFrame:
    """Group, x, f: knots of the decreasing density of p-values, on [0, 1]."""
    return _knots(_dealt(values, by, ranges)[0], by)


def bayes_factors(values: DataFrame, by: str, ranges: int | None = None) -> DataFrame:
    """Group, p, bf, q for each distinct p-value: the density at its last knot by the least density, less one, and one
    less that least density."""
    rows, n = _dealt(values, by, ranges)
    found = _knots(rows, by)
    knots = cut(found) if n > 1 else found
    # A knot counts from its place to the next one; each range gets those that reach into it, and the least density.
    group = Window.partitionBy(by).orderBy("x")
    low = knots.groupBy(by).agg(F.greatest(F.min("f"), F.lit(1e-6)).alias("_low"))  # a density that falls to zero leaves some null
    spans = knots.withColumn("_next", F.lead("x").over(group)).join(low.withColumnRenamed(by, "_b"), F.col(by).eqNullSafe(F.col("_b"))).drop("_b")
    ends = rows.groupBy(by, "_range").agg(F.min("p").alias("_from"), F.max("p").alias("_to")).withColumnRenamed(by, "_g")
    reach = spans.join(ends, F.col(by).eqNullSafe(F.col("_g")) & (F.col("x") <= F.col("_to")) & (F.col("_next").isNull() | (F.col("_next") > F.col("_from"))))

    def look(p: pd.DataFrame, k: pd.DataFrame) -> pd.DataFrame:
        k = k.sort_values("x")
        x, f, least = k["x"].to_numpy(float), k["f"].to_numpy(float), float(k["_low"].iloc[0])
        at = p["p"].to_numpy(float)
        return pd.DataFrame({by: p[by], "p": at, "bf": f[np.searchsorted(x, at, "right") - 1] / least - 1, "q": 1 - least})

    keyed = reach.select(F.col(by).alias("_g2"), F.col("_range").alias("_r2"), "x", "f", "_low")
    return rows.select(by, "_range", "p").groupBy(by, "_range").cogroup(keyed.groupBy("_g2", "_r2")).applyInPandas(look, f"{by} bigint, p double, bf double, q double")
