"""Regression of genes on cell covariates, against dense least squares."""

import numpy as np
import pandas as pd
import pytest

from strandflow.operators import cells

NAMES = ("depth", "share")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    n, g = 60, 17
    cov = np.column_stack([rng.integers(100, 900, n).astype(float), rng.random(n)])
    y = np.where(rng.random((n, g)) < 0.3, rng.random((n, g)) * 3 + cov[:, :1] / 400, 0.0)
    y[:, 3] = 0.0
    y[5] = 0.0  # a cell without any value
    y[7, 2] = 400.0  # clipped where deviations are few
    at = np.argwhere(y)
    x = spark.createDataFrame(pd.DataFrame({"cell": at[:, 0], "gene": at[:, 1], "x": y[tuple(at.T)]}))
    covariates = spark.createDataFrame(pd.DataFrame({"cell": np.arange(n), "depth": cov[:, 0], "share": cov[:, 1], "other": 1}))
    genes = spark.createDataFrame([(k,) for k in range(g) if k != 4], "gene bigint")
    full = np.column_stack([np.ones(n), cov])
    residual = y - full @ np.linalg.lstsq(full, y, rcond=None)[0]
    return x, covariates, genes, y, residual


def test_rows_and_dense(data):
    x, covariates, genes, y, residual = data
    got = {(r.cell, r.gene): (r.residual, r.zero) for r in cells.residual_rows(x, covariates, genes, NAMES).collect()}
    assert got.keys() == {(i, j) for i, j in np.argwhere(y).tolist() if j != 4}
    for (i, j), (r, zero) in got.items():
        assert r == pytest.approx(residual[i, j], abs=1e-8) and zero == pytest.approx(residual[i, j] - y[i, j], abs=1e-8)
    whole = cells.regressed(x, covariates.select("cell"), covariates, genes, NAMES).collect()
    assert len(whole) == 60 * 15  # of 17 genes one is not chosen, one has no value
    assert all(r.residual == pytest.approx(residual[r.cell, r.gene], abs=1e-8) for r in whole)


@pytest.mark.parametrize("block", [4, 1024])
def test_covariance(data, block):
    x, covariates, genes, y, residual = data
    want = np.cov(residual.T)
    got = {(r.a, r.b): r.covariance for r in cells.residual_covariance(x, covariates, genes, NAMES, block).collect()}
    assert len(got) == 15 * 16 // 2
    assert all(v == pytest.approx(want[a, b], abs=1e-7) for (a, b), v in got.items())


def test_vectors(data):
    x, covariates, genes, y, residual = data
    rows, order = cells.residual_vectors(x, covariates, genes, NAMES, 5.0)
    assert order == [k for k in range(17) if k not in (3, 4)]
    want = np.minimum(residual[:, order] / residual[:, order].std(axis=0, ddof=1), 5.0)
    got = {r.cell: r.v for r in rows.collect()}
    assert len(got) == 60 and max(map(max, got.values())) == 5.0
    for i, v in got.items():
        assert v == pytest.approx(list(want[i]), abs=1e-8)


def test_no_genes(data):
    x, covariates, genes, *_ = data
    none = genes.limit(0)
    assert cells.residual_rows(x, covariates, none, NAMES).count() == 0
    assert cells.residual_covariance(x, covariates, none, NAMES).count() == 0
    rows, order = cells.residual_vectors(x, covariates, none, NAMES)
    assert order == [] and {tuple(r.v) for r in rows.collect()} == {()}
