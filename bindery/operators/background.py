"""The background of conversions: a binomial for noise and a beta-binomial for the rest, fitted by many restarts.

A fit needs the counts of few depths only, at most depth + 1 numbers each, so those are all that the driver and the tasks hold.
The restarts are rows of a table that Spark spreads; each is a quasi-Newton descent with the exact gradient.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Where the first descent of a depth begins, and the range of the others: the logits of noise rate and weight
#: (both by 1 / (1 + e^x)), and the logarithms of alpha and beta between them.
START, SPREAD = (2.94, -4.8, -2.0, 0.0), 4.0


def loss_and_gradient(t: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log likelihood of counts of k = 0..n, and its gradient. t: rho, log alpha, log beta, r as above."""
    n = len(counts) - 1
    k = np.arange(n + 1)
    t = np.clip(t, -30, 30)
    rho, a, b, r = 1 / (1 + math.exp(t[0])), math.exp(t[1]), math.exp(t[2]), 1 / (1 + math.exp(t[3]))
    choose = np.array([math.comb(n, int(i)) for i in k], float)
    # log rho and log (1 - rho), exact for rates near 0 and 1.
    noise = choose * np.exp(-k * np.logaddexp(0, t[0]) - (n - k) * np.logaddexp(0, -t[0]))
    rising = lambda x: np.r_[0.0, np.cumsum(np.log(x + np.arange(n)))]
    inverse = lambda x: np.r_[0.0, np.cumsum(1 / (x + np.arange(n)))]
    both = choose * np.exp(rising(a)[k] + rising(b)[n - k] - rising(a + b)[n])
    p = np.maximum(r * noise + (1 - r) * both, 1e-300)
    total = counts.sum()
    share = counts / total / p
    drop = inverse(a + b)[n]
    gradient = np.array([
        -(r * noise * -(k - n * rho) * share).sum(), -((1 - r) * both * a * (inverse(a)[k] - drop) * share).sum(),
        -((1 - r) * both * b * (inverse(b)[n - k] - drop) * share).sum(), -((noise - both) * -r * (1 - r) * share).sum(),
    ])
    return float(-(counts * np.log(p)).sum() / total), gradient


def descend(start: np.ndarray, counts: np.ndarray, steps: int = 400, tolerance: float = 1e-5) -> tuple[np.ndarray, float, bool]:
    """Parameters, loss, and whether the gradient vanished: a quasi-Newton descent whose steps are halved until they pay."""
    t, inverse = np.array(start, float), np.eye(4)
    here, gradient = loss_and_gradient(t, counts)
    for _ in range(steps):
        if np.abs(gradient).max() < tolerance:
            return t, here, True
        move = -inverse @ gradient
        if move @ gradient >= 0:
            move, inverse = -gradient, np.eye(4)
        move *= min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        scale = 1.0
        while True:
            value, ahead = loss_and_gradient(t + scale * move, counts)
            if value <= here + 1e-4 * scale * (move @ gradient) or scale < 1e-10:
                break
            scale /= 2
        if scale < 1e-10:
            break
        s, y = scale * move, ahead - gradient
        t, here, gradient = t + s, value, ahead
        if s @ y > 1e-12:
            rest = np.eye(4) - np.outer(s, y) / (s @ y)
            inverse = rest @ inverse @ rest.T + np.outer(s, s) / (s @ y)
    return t, here, bool(np.abs(gradient).max() < tolerance)


def restarts_of(counts: DataFrame, depths: range = range(5, 11), restarts: int = 100, seed: int = 1) -> DataFrame:
    """depth, restart, loss, done, t: each descent of each depth that occurs. Restart 0 begins at START. counts: k, n."""
    spark = counts.sparkSession
    rows = counts.where(F.col("n").isin(*depths) & (F.col("k") <= F.col("n"))).groupBy("k", "n").count().collect()  # at most depth + 1 rows a depth
    known = {d: np.zeros(d + 1) for d in depths if any(r["n"] == d for r in rows)}
    for r in rows:
        known[r["n"]][r["k"]] = r["count"]
    jobs = [(d, i) for d in known for i in range(restarts + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for d, i in zip(pdf["depth"].tolist(), pdf["restart"].tolist(), strict=True):
                start = np.random.default_rng([seed, d, i]).uniform(-SPREAD, SPREAD, 4) if i else np.array(START)
                t, loss, done = descend(start, known[d])
                out.append((d, i, loss, done, t.tolist()))
            yield pd.DataFrame(out, columns=["depth", "restart", "loss", "done", "t"])

    table = spark.createDataFrame(jobs, "depth int, restart int").repartition(max(1, min(len(jobs), spark.sparkContext.defaultParallelism)), "depth", "restart")
    return table.mapInPandas(run, "depth int, restart int, loss double, done boolean, t array<double>")


def fit(counts: DataFrame, depths: range = range(5, 11), restarts: int = 100, seed: int = 1, average: str = "best") -> tuple[float, float, float, float]:
    """(r, rho, alpha, beta) of the background, the mean over depths of the parameters found.

    average: `best` takes the best descent of each depth; `running` takes the best so far after each restart, all of them, as
    older tools do. A descent counts from restart 1 on if it came to an end; where the best so far has not, it is left out."""
    tried = restarts_of(counts, depths, restarts, seed)
    value = F.when((F.col("restart") == 0) | F.col("done"), F.col("loss")).otherwise(F.lit(math.inf))
    order = F.struct(value.alias("value"), "restart", "done", "t")
    if average == "running":
        upto = Window.partitionBy("depth").orderBy("restart").rowsBetween(Window.unboundedPreceding, 0)
        found = tried.withColumn("best", F.min(order).over(upto)).where("restart > 0 or depth < 0")
    else:
        found = tried.groupBy("depth").agg(F.min(order).alias("best"))
    kept = found.where("best.done").select(*[F.avg(F.col("best.t")[i]).alias(f"t{i}") for i in range(4)]).first()
    if kept["t0"] is None:
        raise ValueError("no site has a depth to fit")
    t = [kept[f"t{i}"] for i in range(4)]
    return 1 / (1 + math.exp(t[3])), 1 / (1 + math.exp(t[0])), math.exp(t[1]), math.exp(t[2])
