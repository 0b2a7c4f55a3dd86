"""Fits against planted values, and the chain from counts to posteriors against its parts."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from bindery.operators import background, models

BACKGROUND = (0.9, 0.03, 0.8, 2.0)


def test_geometric_mixture_by_a_plain_loop():
    h = {0: 500, 1: 260, 2: 120, 3: 70, 5: 30, 9: 12, 14: 5}
    w, g = models.fit_geometric_mixture(h, 3, 40)
    n = sum(h.values())
    s = 1 / (1 + sum(k * c for k, c in h.items()) / n)
    p, v = [s, 1.05 * s, 1 / 15], [0.01 / 1.01, 0.99 / 1.01, 0.01 / 1.01]
    likelihood = []
    for _ in range(40):
        mass, tries = [0.0] * 3, [0.0] * 3
        for k, c in h.items():
            r = [v[j] * (1 - p[j]) ** k * p[j] for j in range(3)]
            for j in range(3):
                mass[j] += c * r[j] / sum(r)
                tries[j] += c * r[j] / sum(r) * (k + 1)
        p, v = [mass[j] / tries[j] for j in range(3)], [m / n for m in mass]
        likelihood.append(sum(c * math.log(sum(v[j] * (1 - p[j]) ** k * p[j] for j in range(3))) for k, c in h.items()))
    assert w == pytest.approx(v) and g == pytest.approx([x / (1 - x) for x in p])
    assert all(b >= a - 1e-9 for a, b in zip(likelihood, likelihood[1:], strict=False))
    assert len(models.fit_geometric_mixture(h, 5, 10)[0]) == 5


def test_beta_binomial_recovers_planted_values():
    rng = np.random.default_rng(3)
    n = rng.integers(5, 40, 20_000)
    k = rng.binomial(n, rng.beta(1.5, 4.0, len(n)))
    h = {}
    for pair in zip(k.tolist(), n.tolist(), strict=True):
        h[pair] = h.get(pair, 0) + 1
    a, b = models.fit_beta_binomial(h)
    assert a == pytest.approx(1.5, rel=0.07) and b == pytest.approx(4.0, rel=0.07)
    assert sum(models.beta_binomial(np.arange(31), np.full(31, 30), a, b)) == pytest.approx(1)


def test_background_and_snp_check():
    h = {}
    for n in range(5, 11):
        for k, p in enumerate(models.background_pmf(n, BACKGROUND)):
            h[(k, n)] = round(p * 1_000_000)
    fitted = models.fit_background(h, restarts=3)
    for n in (6, 9):
        assert models.background_pmf(n, fitted) == pytest.approx(models.background_pmf(n, BACKGROUND), abs=5e-3)
    assert sum(models.background_pmf(500, BACKGROUND)) == pytest.approx(1)
    assert models.snp_likely((0.2, 0.01, 20.0, 0.5)) and not models.snp_likely(BACKGROUND)
    with pytest.raises(ValueError):
        models.fit_background({(1, 3): 5})


@pytest.mark.parametrize("snp", [False, True])
def test_tails(spark, snp):
    pairs = [(7, 0), (7, 3), (7, 7), (12, 5), (800, 3), (800, 640), (800, 800), (100_000, 40_000)]
    got = {(r.n, r.k): r.p_value for r in models.tail_table(spark.createDataFrame(pairs * 2, "n bigint, k bigint"), BACKGROUND, snp).collect()}
    for n, k in pairs:
        size, hits = (500, round(k / n * 500)) if n > 500 else (n, k)
        p = models.background_pmf(size, BACKGROUND)
        assert got[(n, k)] == pytest.approx(1.0 if snp and hits >= size else p[hits : size if snp else size + 1].sum(), abs=1e-12)


def test_majorant_lies_above_and_touches():
    rng = np.random.default_rng(2)
    for _ in range(30):
        x = np.unique(np.r_[0, rng.random(25).round(2), 1])
        y = np.sort(np.r_[0, rng.random(len(x) - 2), 1])
        knots, slopes = models.concave_majorant(x, y)
        over = np.interp(x, knots, y[np.searchsorted(x, knots)])
        assert (over >= y - 1e-12).all() and (np.diff(slopes) <= 1e-9).all() and set(knots) <= set(x)


@pytest.mark.parametrize("scale", [False, True])
def test_posterior_by_brute_force(spark, tmp_path, scale):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        n, m = int(rng.integers(0, 12)), int(rng.integers(0, 12))
        rows.append(("c", i, int(rng.integers(0, n + 1)), n, int(rng.integers(0, min(m, 4) + 1)), m, "+-"[i % 2]))
    t = spark.createDataFrame(rows, "chrom string, pos bigint, k_factor bigint, n_factor bigint, k_mock bigint, n_mock bigint, strand string")
    mock = t.selectExpr("k_mock as k", "n_mock as n")
    model = models.fit_mock(mock, 2.0, 3, 30)
    model.save(spark, f"{tmp_path}/model")
    assert models.MockModel.load(spark, f"{tmp_path}/model") == model
    kk = {(r.k, r.k_mock): r.pval_kk for r in models.kk_table(t.selectExpr("k_factor as k", "k_mock"), model.pk_weights, model.pk_rates, 3.0, 2.0).collect()}
    nk = {(r.n, r.k): r.pval_nk for r in models.nk_table(t.selectExpr("k_factor as k", "n_factor as n"), model.pn_weights, model.pn_rates, 3.0, model.alpha, model.beta).collect()}
    assert all(0 <= p <= 1 for p in [*kk.values(), *nk.values()]) and kk[(0, 1)] == 1
    some = [r for r in rows if r[4] <= 3]
    a, b = {}, {}
    for _, i, k, n, m, _, _ in some:
        a.setdefault(m, {})[i] = kk[(k, m)]
        if n > 0:
            b.setdefault(min(k, 10), {})[i] = nk[(n, k)]
    if scale:
        a, b = ({g: {i: p / max(ps.values()) for i, p in ps.items()} for g, ps in d.items()} for d in (a, b))

    def factors(ps):
        p = np.array(sorted(ps.values()))
        x = np.unique(p)
        y = np.searchsorted(p, x, "right") / len(p)
        x, y = (np.r_[x, 1.0], np.r_[y, 1.0]) if x[-1] != 1 else (x, y)
        x, y = (np.r_[0.0, x], np.r_[0.0, y]) if x[0] != 0 else (x, y)
        knots, slopes = models.concave_majorant(x, y)
        low = max(slopes.min(), 1e-6)
        return {i: slopes[[j for j, k in enumerate(knots) if k <= v][-1]] / low - 1 for i, v in ps.items()}, 1 - low

    fa, fb = {g: factors(ps) for g, ps in a.items()}, {g: factors(ps) for g, ps in b.items()}
    got = {r.pos: r.posterior for r in models.score_with(t, model, 3.0, 3, scale).collect()}
    assert set(got) == {r[1] for r in some if r[2] > 0}
    for _, i, k, _, m, _, _ in some:
        if k > 0:
            q = fb[min(k, 10)][1]
            bf = fa[m][0][i] * fb[min(k, 10)][0][i] * (1 - q) / q if q else 0.0
            assert got[i] == pytest.approx(bf / (1 + bf), rel=1e-6, abs=1e-9)


def test_bootstrap_draws_as_many_as_there_are(spark):
    from bindery.operators import profiles

    for n, per in ((1, 4), (10, 4), (64, 4), (1003, 50)):
        weights = np.hstack([profiles.block_weights(n, per, b, 40, 7) for b in range(-(-n // per))])
        assert weights.shape == (40, n) and (weights.sum(axis=1) == n).all()
    many = np.hstack([profiles.block_weights(200, 7, b, 3000, 1) for b in range(29)])
    # Each row is drawn once on average, with variance (n - 1) / n, wherever it lies; rows of different blocks are hardly correlated.
    assert abs(many.mean(axis=0) - 1).max() < 0.08 and abs(many.var(axis=0) - 0.995).max() < 0.15
    assert abs(np.corrcoef(many[:, 0], many[:, 199])[0, 1]) < 0.07
    annots = spark.createDataFrame([(100 - k, "c", 50 * k, 50 * k + 20, "+-"[k % 2], "g") for k in range(1, 31)], "annot_id bigint, seqid string, start_pos bigint, end_pos bigint, strand string, feature string")
    sites_ = spark.createDataFrame([("c", p, "+-"[p % 2], p % 7 / 7) for p in range(0, 1600, 3)], "seqid string, position bigint, strand string, occupancy double")
    got = {(r.draw, r.offset): r.mean for r in profiles.bootstrap_exact(sites_, annots, 5, 3, 20, seed=3, per=8).collect()}
    weights = np.hstack([profiles.block_weights(30, 8, b, 20, 3) for b in range(4)])
    hits = {(r.annot_id, r.offset): r.o for r in profiles.offsets(sites_, profiles._around(annots, "start", 5, 3)).groupBy("annot_id", "offset").agg(F.sum("occupancy").alias("o")).collect()}
    ids = sorted(r.annot_id for r in annots.collect())
    assert len(got) == 20 * 9
    for (draw, offset), mean in got.items():
        assert abs(mean - sum(weights[draw, i] * hits.get((a, offset), 0.0) for i, a in enumerate(ids)) / 30) < 1e-9
    assert all(r.mean == 0 for r in profiles.bootstrap_exact(sites_, annots.limit(0), 5, 3, 2).collect())


def test_gradient_of_the_background():
    r = np.random.default_rng(4)
    for _ in range(40):
        counts, t = r.integers(1, 500, r.integers(3, 12)).astype(float), r.uniform(-3, 3, 4)
        _, g = background.loss_and_gradient(t, counts)
        e = np.eye(4) * 1e-6
        numeric = [(background.loss_and_gradient(t + x, counts)[0] - background.loss_and_gradient(t - x, counts)[0]) / 2e-6 for x in e]
        assert g == pytest.approx(numeric, abs=1e-5)
    p = models.background_pmf(7, (0.3, 0.05, 0.7, 2.0))
    t = np.array([math.log(1 / 0.05 - 1), math.log(0.7), math.log(2.0), math.log(1 / 0.3 - 1)])
    assert background.loss_and_gradient(t, p)[0] == pytest.approx(-(p * np.log(p)).sum())


def test_background_of_planted_parameters(spark):
    rows = [(k, n, round(p * 400_000)) for n in range(4, 12) for k, p in enumerate(models.background_pmf(n, BACKGROUND))]
    counts = spark.createDataFrame([(k, n, c) for k, n, c in rows if c], "k long, n long, c long").selectExpr("k", "n", "explode(sequence(1L, c)) as x").drop("x")
    tried = background.restarts_of(counts, restarts=12).collect()
    assert len(tried) == 6 * 13 and sum(x.done for x in tried) > 30
    for depth in (7, 10):
        h = np.array([c for k, n, c in rows if n == depth], float)
        best = min(x.loss for x in tried if x.depth == depth and (x.done or x.restart == 0))
        # A grid around the planted values finds nothing better.
        r, rho, a, b = BACKGROUND
        grid = [background.loss_and_gradient(np.array([math.log(1 / (rho * s) - 1), math.log(a * u), math.log(b * w), math.log(1 / z - 1)]), h)[0] for s in (0.8, 0.9, 1, 1.1, 1.25) for u in (0.5, 0.75, 1, 1.5, 2) for w in (0.5, 0.75, 1, 1.5, 2) for z in (0.85, 0.88, 0.9, 0.92, 0.95)]
        assert best <= min(grid) + 1e-6
    for average in ("best", "running"):
        found = background.fit(counts, restarts=12, average=average)
        for n in (6, 9):
            assert models.background_pmf(n, found) == pytest.approx(models.background_pmf(n, BACKGROUND), abs=2e-2 if average == "running" else 8e-3), average
    with pytest.raises(ValueError, match="no site"):
        background.fit(counts.where("n > 90"), restarts=1)


def test_streams_agree_with_batch(spark, tmp_path):
    """Files that arrive one after another, one row of them too late."""
    from datetime import datetime, timedelta

    from bindery.streaming import reads as stream

    at = lambda s: datetime(2020, 1, 1) + timedelta(seconds=s)
    schema = "chrom string, pos long, ref string, bases string, arrived timestamp"
    batches = [[("c", p, "AT"[p % 2], "..C,,g"[: 3 + p % 4], at(20 * b + p)) for p in range(8)] for b in range(4)]
    late = [("c", 1, "T", "CCCC", at(1))]
    for k, rows in enumerate([*batches, [("c", 3, "T", ".", at(500))], [("c", 3, "T", ".", at(510))], late, [("c", 3, "T", ",", at(900))]]):
        (tmp_path / "in").mkdir(exist_ok=True)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/part{k}")
        next((tmp_path / f"part{k}").glob("*.parquet")).rename(tmp_path / "in" / f"{k}.parquet")
    incoming = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def drained(df, mode, name):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()
        return spark.table(name)

    got = {tuple(x) for x in drained(stream.conversions(incoming(), "30 seconds", "60 seconds"), "append", "stream_counts").where("begin < '2020-01-01 00:02:00'").collect()}
    want = {tuple(x) for x in stream.conversions(spark.createDataFrame([x for b in batches for x in b], schema), "30 seconds", "60 seconds").collect()}
    assert got == want and got
    seqs = drained(stream.deduplicate(incoming().withColumnRenamed("bases", "seq"), "60 seconds"), "append", "stream_reads")
    # Each once, the late row not at all.
    assert sorted(x.seq for x in seqs.collect()) == sorted({x[3] for b in batches for x in b} | {".", ","})
    named = incoming().selectExpr("concat(chrom, pos) as read_id", "chrom as place", "ref as umi", "arrived")
    once = drained(stream.molecules(named, "1 hour"), "complete", "stream_molecules")
    assert {(x.umi, x.n) for x in once.collect()} == {("A", 4), ("T", 4)}


@pytest.mark.parametrize("ranges", [3, 40])
def test_densities_in_ranges(spark, ranges):
    from bindery.operators import density

    r = np.random.default_rng(ranges)
    rows = [(g, float(round(x, 3))) for g, n in ((0, 900), (1, 300), (2, 5), (3, 1)) for x in np.minimum(r.exponential(0.2, n), 1.0)] + [(4, 0.0), (4, 1.0), (5, 0.0), (6, 1.0), (6, 1.0)]
    values = spark.createDataFrame(rows, "g long, p double")
    one, many = ({(x.g, round(x.x, 9)): x.f for x in density.grenander(values, "g", n).collect()} for n in (1, ranges))
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(one[k], rel=1e-9) for k in one)
    for g in range(7):
        p = np.sort([x for y, x in rows if y == g])
        x, c = np.unique(p, return_counts=True)
        knots, slopes = density._padded(x, np.cumsum(c) / len(p))
        assert {k: f for (y, k), f in many.items() if y == g} == {round(k, 9): pytest.approx(f, rel=1e-9) for k, f in zip(knots.tolist(), slopes.tolist(), strict=True)}
        got = {x.p: (x.bf, x.q) for x in density.bayes_factors(values.where(f"g = {g}"), "g", ranges).collect()}
        low = max(slopes.min(), 1e-6)
        assert got == {v: (pytest.approx(slopes[np.searchsorted(knots, v, "right") - 1] / low - 1, rel=1e-8, abs=1e-9), pytest.approx(1 - low)) for v in x.tolist()}
    assert density.grenander(values.limit(0), "g").count() == 0 and density.bayes_factors(values.limit(0), "g").count() == 0
