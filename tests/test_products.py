"""Products and distances of samples in blocks, against whole matrices."""

import numpy as np
import pandas as pd
import pytest

from strandflow.operators import bulk


def table(spark, n, genes, seed, share=0.4):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random((n, genes)) < share, rng.normal(size=(n, genes)), 0.0)
    values[:, 0] = 1.0  # a gene of all samples
    at = np.argwhere(values)
    names = np.array([f"s{k:05d}" for k in rng.permutation(n)])
    pdf = pd.DataFrame({"sample": names[at[:, 0]], "gene": [f"g{g}" for g in at[:, 1]], "x": values[tuple(at.T)]})
    return spark.createDataFrame(pdf.sample(frac=1, random_state=seed)), names, values


@pytest.mark.parametrize(("block", "slices"), [(1024, None), (8, None), (8, 3), (5, 1), (1, 1)])
def test_distances_in_blocks(spark, block, slices, monkeypatch):
    monkeypatch.setattr(bulk, "GENES_AT_ONCE", 4)
    x, names, values = table(spark, 21, 30, 5)
    got = {(r.a, r.b): r.dot for r in bulk.sample_products(x, block, slices).collect()}
    where = {s: k for k, s in enumerate(names)}
    assert len(got) == 21 * 22 // 2 and all(a <= b for a, b in got)
    for (a, b), dot in got.items():
        assert dot == pytest.approx(values[where[a]] @ values[where[b]], abs=1e-9)
    far = {(r.a, r.b): r.distance for r in bulk.sample_distances(x, block).collect()}
    assert len(far) == 21 * 20 // 2
    for (a, b), d in far.items():
        assert d == pytest.approx(np.linalg.norm(values[where[a]] - values[where[b]]), abs=1e-6)


def test_products_over_batches(spark):
    """A gene that is cut by the end of an Arrow batch counts once."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        x, names, values = table(spark, 9, 12, 3, 0.9)
        got = {(r.a, r.b): r.dot for r in bulk.sample_products(x, 4).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    where = {s: k for k, s in enumerate(names)}
    assert all(dot == pytest.approx(values[where[a]] @ values[where[b]]) for (a, b), dot in got.items())


def test_odd_rows(spark):
    """Missing samples, genes and values are skipped, repeated rows add up, no common gene is no lost pair."""
    kind = "sample int, gene int, x double"
    rows = [(1, 1, 2.0), (1, 1, 1.0), (2, 2, 4.0), (None, 1, 5.0), (1, None, 5.0), (3, 1, None)]
    got = bulk.sample_distances(spark.createDataFrame(rows, kind)).collect()
    assert [(r.a, r.b, r.distance) for r in got] == [(1, 2, 5.0)]
    assert bulk.sample_distances(spark.createDataFrame([], kind)).count() == 0
