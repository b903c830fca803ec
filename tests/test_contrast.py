"""The two-group model: dispersions, outliers, score equations, cut of low means."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.operators import contrast


def made(seed, genes, per_group, dispersion=0.1, changed=40):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(genes):
        mean = float(np.exp(rng.uniform(1, 7)))
        for s in range(2 * per_group):
            mu = mean * (4 if g < changed and s >= per_group else 1) * (1 + 0.3 * (s % 2))
            n = int(rng.negative_binomial(1 / dispersion, 1 / (1 + dispersion * mu)))
            rows.append([s, "control" if s < per_group else "patient", g, n])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], "sample int, condition string, gene int, n bigint")


def test_quantile_and_log_gamma():
    assert contrast.f_quantile(0.99, 2, 4) == pytest.approx(18.0, abs=1e-6)
    assert contrast.f_quantile(0.95, 1, 10) == pytest.approx(4.9646, abs=1e-4)
    x = np.array([1e-3, 0.5, 1.0, 3.7, 8.0, 50.0, 1e8])
    assert contrast._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], abs=1e-9, rel=1e-12)


def test_dispersions_maximise_the_profile():
    rng = np.random.default_rng(2)
    patient = np.array([0] * 8 + [1] * 8)
    counts = rng.negative_binomial(4, 4 / (4 + 80), size=(50, 16)).astype(float)
    mu = contrast._group_means(counts, np.ones(16), patient)
    found = contrast._likeliest(counts, mu, patient)
    fine = np.linspace(math.log(1e-8), math.log(16), 4001)
    best = np.exp(fine[contrast._profile(counts, mu, patient, np.tile(fine, (50, 1))).argmax(axis=1)])
    assert np.log(found) == pytest.approx(np.log(best), abs=0.01)
    assert np.median(found) == pytest.approx(0.25, rel=0.3)


def test_fit_solves_its_equations_and_finds_changes(spark):
    rows = made(3, 300, 4)
    df = frame(spark, rows)
    fitted = contrast.fit_contrast(df)
    got = fitted.toPandas().set_index("gene")
    assert got.converged.all() and not got.replaced.any()
    scores = contrast.score_equations(fitted, df).toPandas()
    assert len(scores) == 2 * len(got) and scores.score.abs().max() < 1e-3
    strong = [g for g in range(40) if got.base_mean.get(g, 0) > 50 and not got.outlier[g]]
    assert (got.loc[strong, "lfc"] - 2).abs().median() < 0.4 and (got.loc[strong, "padj"] < 0.1).mean() > 0.9
    null = got.loc[[g for g in got.index if g >= 40]]
    assert (null.padj < 0.1).mean() < 0.06


@pytest.mark.parametrize("per_group", [3, 8])
def test_outliers_are_flagged_or_replaced(spark, per_group):
    rows = made(4, 200, per_group, 0.02)
    for r in rows:
        if r[2] == 100 and r[0] == 1:
            r[3] = 200_000
    got = contrast.fit_contrast(frame(spark, rows)).toPandas().set_index("gene")
    assert got.outlier[100] == (per_group == 3) and got.replaced[100] == (per_group == 8)
    assert (got.p.isna() == got.outlier).all()
    if per_group == 8:
        assert abs(got.lfc[100]) < 2 and max(got.used[100]) < 200_000
        assert not got.replaced.drop(100)[got.base_mean > 20].mean() > 0.1


def test_cut_of_low_means(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(g), float(rng.uniform() ** (8 if g > 600 else 1))) for g in range(1000)] + [(1000, 5.0, None)]
    fitted = spark.createDataFrame(rows, "gene int, base_mean double, p double")
    got = {r.step: (r.cut, r.rejected) for r in contrast.rejection_cut(fitted).collect()}
    means = np.array([r[1] for r in rows])
    for step in range(50):
        cut = np.quantile(means, 0.95 * step / 49)
        p = np.sort([r[2] for r in rows if r[1] >= cut and r[2] is not None])
        below = np.flatnonzero(p <= 0.1 * np.arange(1, len(p) + 1) / len(p))
        assert got[step][0] == pytest.approx(cut) and got[step][1] == (below[-1] + 1 if len(below) else 0)
    best = max(n for _, n in got.values())
    out = contrast.filtered_p(fitted).toPandas()
    lowest = min(c for c, n in got.values() if n == best)
    assert (out.padj < 0.1).sum() == best and out[out.base_mean < lowest].padj.isna().all()
    assert out.p.notna().sum() == 1000


def test_no_genes(spark):
    empty = spark.createDataFrame([], "gene int, base_mean double, p double")
    assert contrast.rejection_cut(empty).count() == 0
    assert contrast.filtered_p(empty).agg(F.count("gene")).first()[0] == 0


def test_counts_are_written_once(spark, monkeypatch):
    """The steps of a fit read the table of counts, not the query that makes it."""
    written, keep = [], contrast.materialised
    monkeypatch.setattr(contrast, "materialised", lambda df, label: written.append(label) or keep(df, label))
    rng = np.random.default_rng(4)
    rows = [(s, "control" if s < 3 else "patient", g, int(rng.negative_binomial(3, 0.03))) for s in range(6) for g in range(60)]
    bulk = spark.createDataFrame(rows, "sample int, condition string, gene int, n bigint")
    fitted = contrast.fit_contrast(bulk)
    assert written.count("bulk") == 1
    scores = contrast.score_equations(fitted, bulk).collect()
    assert written.count("bulk") == 2 and max(abs(r["score"]) for r in scores) < 1e-3
