"""Statistical models of conversions.

Fits run on the driver over aggregated histograms, whose size does not follow the number of sites;
probabilities are computed once for distinct (n, k) and joined back.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.operators.density import bayes_factors, concave_majorant, grenander  # noqa: F401

TERMS = 50_000


def log_rising(x: float, upto: int) -> np.ndarray:
    """log of x (x+1) ... (x+m-1) for m = 0..upto."""
    return np.r_[0.0, np.cumsum(np.log(x + np.arange(upto)))]


def beta_binomial(k: np.ndarray, n: np.ndarray, a: float, b: float) -> np.ndarray:
    """P(k | n)."""
    top = int(max(np.max(n, initial=0), 1))
    ra, rb, rab, one = log_rising(a, top), log_rising(b, top), log_rising(a + b, top), log_rising(1.0, top)
    return np.exp(one[n] - one[k] - one[n - k] + ra[k] + rb[n - k] - rab[n])


def fit_geometric_mixture(histogram: dict[int, int], components: int = 3, iterations: int = 250) -> tuple[np.ndarray, np.ndarray]:
    """(weights, rates g) of P(k) = sum w g / (1 + g)^(k + 1), by expectation maximisation on {k: count}.

    Starts near the mean with weights 0.01 and 0.99; each further component begins at the largest value with
    weight 0.01, after five steps of those before it."""
    k = np.array(sorted(histogram), float)
    c = np.array([histogram[int(x)] for x in k], float)
    success = 1 / (1 + (k * c).sum() / c.sum())
    p, w = np.array([success, 1.05 * success]), np.array([0.01, 0.99])

    def em(p: np.ndarray, w: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(steps):
            r = w[:, None] * (1 - p[:, None]) ** k * p[:, None]
            r = r / r.sum(0) * c
            mass = r.sum(1)
            p, w = mass / (r @ (k + 1)), mass / c.sum()
        return p, w

    for m in range(3, max(components, 3) + 1):
        p, w = np.r_[p, 1 / (1 + k.max())], np.r_[w, 0.01]
        w = w / w.sum()
        if m < components:
            p, w = em(p, w, 5)
    p, w = em(p, w, iterations)
    return w, p / (1 - p)


def fit_beta_binomial(histogram: dict[tuple[int, int], int], steps: int = 100) -> tuple[float, float]:
    """Maximum-likelihood (alpha, beta) on {(k, n): count}, by Newton steps on their logarithms with numeric derivatives."""
    k, n = np.array([x for x, _ in histogram], int), np.array([x for _, x in histogram], int)
    c = np.array(list(histogram.values()), float)

    def loss(t: np.ndarray) -> float:
        return -float((c * np.log(np.maximum(beta_binomial(k, n, *np.exp(t)), 1e-300))).sum()) / c.sum()

    t, h = np.zeros(2), 1e-4
    e = np.eye(2) * h
    for _ in range(steps):
        g = np.array([(loss(t + x) - loss(t - x)) / (2 * h) for x in e])
        H = np.array([[(loss(t + x + y) - loss(t + x - y) - loss(t - x + y) + loss(t - x - y)) / (4 * h * h) for y in e] for x in e])
        H = H + np.eye(2) * max(0.0, 1e-3 - np.linalg.eigvalsh(H)[0])
        move, here, scale = -np.linalg.solve(H, g), loss(t), 1.0
        while scale > 1e-6 and loss(np.clip(t + scale * move, -8, 8)) > here:
            scale /= 2
        t = np.clip(t + scale * move, -8, 8)
        if np.abs(scale * move).max() < 1e-7:
            break
    return tuple(np.exp(t))


def fit_background(histogram: dict[tuple[int, int], int], depths: range = range(5, 11), restarts: int = 20, seed: int = 1) -> tuple[float, float, float, float]:
    """(r, rho, alpha, beta) of the background mixture: the best of seeded restarts of gradient descent a depth, averaged over depths."""
    rng = np.random.default_rng(seed)
    found = []
    for depth in depths:
        k = np.array([a for (a, n) in histogram if n == depth], int)
        if not len(k):
            continue
        c = np.array([histogram[(int(a), depth)] for a in k], float)
        n = np.full(len(k), depth)
        choose = np.array([math.comb(depth, int(a)) for a in k], float)

        def loss(t: np.ndarray, k=k, n=n, c=c, choose=choose) -> float:
            r, rho = 1 / (1 + np.exp(-t[:2]))
            p = r * choose * rho**k * (1 - rho) ** (n - k) + (1 - r) * beta_binomial(k, n, *np.exp(t[2:]))
            return -float((c * np.log(np.maximum(p, 1e-300))).sum()) / c.sum()

        best = (math.inf, None)
        for s in range(restarts):
            t = np.array([2.0, -4.0, 0.0, 0.0]) + (rng.normal(0, 1, 4) if s else 0)
            rate, here = 0.5, loss(t)
            for _ in range(150):
                g = np.array([(loss(t + x) - loss(t - x)) / 2e-5 for x in np.eye(4) * 1e-5])
                new = np.clip(t - rate * g, -12, 6)
                value = loss(new)
                t, here, rate = (new, value, rate * 1.2) if value < here else (t, here, rate / 2)
                if rate < 1e-6:
                    break
            best = min(best, (here, tuple(t)), key=lambda x: x[0])
        found.append(best[1])
    if not found:
        raise ValueError("no site has a depth to fit")
    t = np.mean(found, 0)
    return (*(1 / (1 + np.exp(-t[:2]))), *np.exp(t[2:]))


def background_pmf(n: int, background: tuple[float, float, float, float]) -> np.ndarray:
    """P(k | n) for k = 0..n."""
    r, rho, a, b = background
    k = np.arange(n + 1)
    one = log_rising(1.0, max(n, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        noise = np.exp(one[n] - one[k] - one[n - k] + np.where(k > 0, k * np.log(rho), 0.0) + np.where(k < n, (n - k) * np.log1p(-rho), 0.0))
    return r * noise + (1 - r) * beta_binomial(k, np.full(n + 1, n), a, b)


def tail_table(pairs: DataFrame, background: tuple[float, float, float, float], snp_likely: bool = False, cap: int = 500) -> DataFrame:
    """n, k, p_value for distinct pairs: the probability of k or more; above `cap` k is rescaled to it.

    snp_likely leaves k = n out of the tail, and k >= n has p-value 1. Each n makes its tail once, as a running sum
    from the end, which takes time linear in the smaller of n and cap."""

    def one_n(pdf: pd.DataFrame) -> pd.DataFrame:
        n, k = int(pdf["n"].iloc[0]), pdf["k"].to_numpy(np.int64)
        size = min(n, cap)
        hits = np.rint(k / n * cap).astype(np.int64) if n > cap else k
        p = background_pmf(size, background)
        if snp_likely:
            p = np.r_[p[:-1], 0.0]
        tail = np.r_[np.cumsum(p[::-1])[::-1], 0.0]
        value = tail[np.clip(hits, 0, size + 1)]
        return pd.DataFrame({"n": pdf["n"], "k": pdf["k"], "p_value": np.where(hits >= size, 1.0, value) if snp_likely else value})

    return pairs.select(F.col("n").cast("long"), F.col("k").cast("long")).distinct().groupBy("n").applyInPandas(one_n, "n bigint, k bigint, p_value double")


def snp_likely(background: tuple[float, float, float, float], depth: int = 11, start: int = 5) -> bool:
    """Whether full conversion is more likely than all counts from `start` below it."""
    p = background_pmf(depth, background)
    return bool(p[depth] > p[start:depth].sum())


def call_sites(counts: DataFrame, background: tuple[float, float, float, float], min_coverage: int = 5, max_p: float = 0.001, snp: bool = False) -> DataFrame:
    """Sites with coverage above (not at) min_coverage, a conversion, and a p-value up to max_p; score is 1 - p."""
    some = counts.where((F.col("n") > min_coverage) & (F.col("k") > 0))
    table = tail_table(some, background, snp)
    return some.join(table, ["n", "k"]).where(F.col("p_value") <= max_p).select(
        F.col("chrom").alias("seqid"), F.col("pos").alias("position"), F.col("k").alias("transitions"), F.col("n").alias("coverage"), (1 - F.col("p_value")).alias("score"), "strand", F.lit(None).cast("double").alias("occupancy"), "p_value"
    )


def kk_table(pairs: DataFrame, weights, rates, coverage: float, mock_coverage: float) -> DataFrame:
    """k, k_mock, pval_kk for distinct pairs: 1 less the probabilities of fewer conversions given the mock's, at least 0."""
    bar = (coverage + mock_coverage) / 2
    km = F.col("k_mock")

    def total(scale: float, one: float, power: Column) -> Column:
        out = F.lit(0.0)
        for w, g in zip(weights, rates, strict=True):
            out = out + float(w) * (g / scale) / F.pow(F.lit(one + g / scale), power)
        return out

    # One pass over i, which carries what is left of one and the logarithm of i + k_mock over i.
    def step(a: Column, i: Column) -> Column:
        log_p = -F.log(total(mock_coverage, 1.0, km + 1)) + a["choose"] + km * math.log(mock_coverage / bar) + i * math.log(coverage / bar)
        left = F.greatest(a["left"] - F.exp(log_p + F.log(total(bar, 2.0, i + km + 1))), F.lit(0.0))
        return F.struct(left.alias("left"), (a["choose"] + F.log((i + km + 1) / (i + 1))).alias("choose"))

    some = pairs.select("k", "k_mock").distinct()
    start = F.struct(F.lit(1.0).alias("left"), F.lit(0.0).alias("choose"))
    upto = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("k"), F.lit(1)).cast("long") - 1)
    below = F.when(F.col("k") > 0, F.aggregate(upto, start, step, lambda a: a["left"])).otherwise(F.lit(1.0))
    return some.withColumn("pval_kk", below)


def nk_table(pairs: DataFrame, weights, rates, coverage: float, alpha: float, beta: float, terms: int = TERMS) -> DataFrame:
    """n, k, pval_nk for distinct pairs: P(k..n | k), at most 1. One group for each k computes its normalising sum once."""
    w, g = np.array(weights, float), np.array(rates, float) / coverage

    def one_k(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["k"].iloc[0])
        n = np.arange(k, terms)
        p_n = (w[:, None] * g[:, None] * np.exp(-n * np.log1p(g[:, None]))).sum(0)
        joint = beta_binomial(np.full(len(n), k), n, alpha, beta) * p_n
        upto = np.minimum(np.cumsum(joint) / joint.sum(), 1.0)
        at = pdf["n"].to_numpy(int) - k
        return pd.DataFrame({"n": pdf["n"], "k": pdf["k"], "pval_nk": np.where(at >= 0, upto[np.clip(at, 0, len(upto) - 1)], 0.0)})

    return pairs.select(F.col("n").cast("long"), F.col("k").cast("long")).distinct().groupBy("k").applyInPandas(one_k, "n bigint, k bigint, pval_nk double")


def ecdf(values: DataFrame, by: str) -> DataFrame:
    """Group, x, y: empirical distribution over distinct values."""
    n = values.groupBy(by, "p").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(by)
    return n.select(by, F.col("p").alias("x"), (F.sum("c").over(w.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("c").over(w)).alias("y"))


def posterior(table: DataFrame, kk: DataFrame, nk: DataFrame, max_k_mock: int, lump: int = 10, scale: bool = False) -> DataFrame:
    """The transition table with bf_kk, bf_nk, pval_kk, pval_nk, posterior, for k_factor > 0 and k_mock <= max_k_mock.

    Densities are fitted a k_mock, and a k_factor lumped at `lump`. Bayes factors are found once for each distinct
    p-value of a group, and meet the rows by equality; what is joined grows with distinct (n, k), and its size is
    left to the planner to look at."""
    lumped = F.least(F.col("k_factor"), F.lit(lump)).cast("long")
    t = table.where(F.col("k_mock") <= max_k_mock).join(kk.withColumnRenamed("k", "k_factor"), ["k_factor", "k_mock"])
    t = t.join(nk.withColumnsRenamed({"k": "k_factor", "n": "n_factor"}), ["k_factor", "n_factor"], "left").withColumn("lump", lumped).withColumn("mock", F.col("k_mock").cast("long"))
    if scale:
        top_kk, top_nk = t.groupBy("mock").agg(F.max("pval_kk").alias("top_kk")), t.where("n_factor > 0").groupBy("lump").agg(F.max("pval_nk").alias("top_nk"))
        # At most max_k_mock + 1 rows, and lump + 1.
        t = t.join(F.broadcast(top_kk), "mock").join(F.broadcast(top_nk), "lump", "left").withColumn("pval_kk", F.col("pval_kk") / F.col("top_kk")).withColumn("pval_nk", F.col("pval_nk") / F.col("top_nk")).drop("top_kk", "top_nk")
    a = bayes_factors(t.select("mock", F.col("pval_kk").alias("p")), "mock").select("mock", F.col("p").alias("pval_kk"), F.col("bf").alias("bf_kk"))
    b = bayes_factors(t.where("n_factor > 0").select("lump", F.col("pval_nk").alias("p")), "lump").select("lump", F.col("p").alias("pval_nk"), F.col("bf").alias("bf_nk"), "q")
    hit = t.where("k_factor > 0").join(a, ["mock", "pval_kk"]).join(b, ["lump", "pval_nk"])
    # A group whose density never exceeds its minimum holds no signal: its posterior is zero.
    bf = F.try_divide(F.col("bf_kk") * F.col("bf_nk") * (1 - F.col("q")), F.col("q"))
    return hit.select(*table.columns, "bf_kk", "bf_nk", "pval_kk", "pval_nk", F.coalesce(F.try_divide(bf, 1 + bf), F.lit(0.0)).alias("posterior"))


def posterior_sites(post: DataFrame, threshold: float, min_k: int = 1) -> DataFrame:
    """Sites of a posterior table: score is the sum of the log Bayes factors, occupancy null until normalised."""
    return post.where((F.col("posterior") >= threshold) & (F.col("k_factor") >= min_k)).select(
        F.col("chrom").alias("seqid"), F.col("pos").alias("position"), F.col("k_factor").alias("transitions"), F.col("n_factor").alias("coverage"), (F.log("bf_kk") + F.log("bf_nk")).alias("score"), "strand", F.lit(None).cast("double").alias("occupancy"), "posterior"
    )


def null_fraction(table: DataFrame) -> DataFrame:
    """eta0: (share of k=0 less share of k=1) of the factor by that of the mock."""
    share = lambda c, v: F.avg((F.col(c) == v).cast("double"))
    return table.agg(((share("k_factor", 0) - share("k_factor", 1)) / (share("k_mock", 0) - share("k_mock", 1))).alias("eta0"))


def weighted_coverage(post: DataFrame) -> DataFrame:
    """Coverage of bound and of unbound sites, weighted by the posterior."""
    return post.agg(F.sum(F.col("n_factor") * F.col("posterior")).alias("bound"), F.sum(F.col("n_factor") * (1 - F.col("posterior"))).alias("unbound"))


@dataclass(frozen=True)
class MockModel:
    """What is fitted on mock counts: coverage, mixtures of k and of n, and the beta-binomial of k given n."""

    coverage: float
    pk_weights: tuple[float, ...]
    pk_rates: tuple[float, ...]
    pn_weights: tuple[float, ...]
    pn_rates: tuple[float, ...]
    alpha: float
    beta: float

    def save(self, spark: SparkSession, path: str) -> None:
        """One line of JSON, by Spark's writer, so that any store will do."""
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> MockModel:
        values = json.loads(spark.read.text(path).first()["value"])
        return MockModel(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def fit_mock(counts: DataFrame, coverage: float, components: int = 3, iterations: int = 250, k: str = "k", n: str = "n") -> MockModel:
    """The mock model of a table of counts. One pass brings the (k, n) histogram to the driver, whose rows follow the
    depths that occur, not the sites; the mixtures fit its margins, the beta-binomial the pairs with n > 0."""
    pairs = {(int(r[k]), int(r[n])): int(r["count"]) for r in counts.groupBy(k, n).count().collect()}
    by_k, by_n = Counter(), Counter()
    for (a, b), c in pairs.items():
        by_k[a] += c
        by_n[b] += c
    wk, gk = fit_geometric_mixture(by_k, components, iterations)
    wn, gn = fit_geometric_mixture(by_n, components, iterations)
    alpha, beta = fit_beta_binomial({p: c for p, c in pairs.items() if p[1] > 0})
    plain = lambda x: tuple(float(v) for v in x)
    return MockModel(float(coverage), plain(wk), plain(gk * coverage), plain(wn), plain(gn * coverage), float(alpha), float(beta))


def score_with(table: DataFrame, model: MockModel, coverage: float, max_k_mock: int, scale: bool = False) -> DataFrame:
    """p-values, Bayes factors and posteriors of a transition table under a fitted mock model and the factor's coverage."""
    kk = kk_table(table.select(F.col("k_factor").alias("k"), "k_mock"), model.pk_weights, model.pk_rates, coverage, model.coverage)
    nk = nk_table(table.select(F.col("k_factor").alias("k"), F.col("n_factor").alias("n")), model.pn_weights, model.pn_rates, coverage, model.alpha, model.beta)
    return posterior(table, kk, nk, max_k_mock, scale=scale)
