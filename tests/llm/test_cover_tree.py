"""Blocks of vectors meet in rounds, whatever the number of open pairs."""

import numpy as np
from pyspark.sql.readwriter import DataFrameWriter

from strandflow.llm import cover_tree


def test_blocks_are_not_shuffled_to_pairs(spark, monkeypatch):
    """Random vectors leave all pairs of blocks open; their comparison has no exchange, and gives what all pairs give."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[200:] = x[:100] + rng.normal(size=(100, 16)).astype(np.float32) * 0.2
    x[299] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(cover_tree, "ROUND_BYTES", 20_000, raising=False)
    plans, kept = [], DataFrameWriter.parquet

    def spied(self, path, *args, **more):
        if "/found-" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return kept(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.cosine_links(df, block=40).collect()}
    assert plans and not any("Exchange hashpartitioning" in p for p in plans)
    assert len(plans) > 1
    unit = x.astype(np.float64)
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    near = unit @ unit.T >= 0.9
    label = np.arange(300)
    while True:
        after = np.array([label[near[i]].min() for i in range(300)])
        if (after == label).all():
            break
        label = after
    assert got == {i: (int(near[i].sum()) - 1, int(label[i]), int(label[i]) == i) for i in range(300)}
