"""Methods against brute force, with one group holding a large part of the rows."""

import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandflow.functions import tails
from strandflow.functions.missing import drop_missing, float_division
from strandflow.operators import bulk, cells, contrast, graph, homozygosity, joins, labels, markers, neighbors, ordered, reads, reduce, variants


def skewed(n=4000, seed=1):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", i, rng.choice([1.0, 2.0, rng.random() * 9])) for i in range(n)]


def test_exact_quantiles(spark):
    data = skewed()
    df = spark.createDataFrame(data, "g string, i int, v double")
    got = {r["g"]: (r["a"], r["b"]) for r in ordered.exact_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95}).collect()}
    pdf = pd.DataFrame(data, columns=["g", "i", "v"])
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx((part.v.quantile(0.5), part.v.quantile(0.95)))


def test_average_ranks(spark):
    data = skewed()
    df = spark.createDataFrame(data, "g string, i int, v double")
    ranks = {(r["g"], r["v"]): r["rank"] for r in ordered.average_ranks(df, ["g"], "v").collect()}
    pdf = pd.DataFrame(data, columns=["g", "i", "v"])
    pdf["r"] = pdf.groupby("g").v.rank()
    assert all(ranks[(r.g, r.v)] == pytest.approx(r.r) for r in pdf.itertuples())


def test_global_index(spark):
    ids = random.Random(2).sample(range(10**6), 3000)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r["id"]: r["row_index"] for r in ordered.global_index(df, "id").collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_the_plain_join(spark, how):
    fact = spark.createDataFrame(skewed(), "g string, i int, v double")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "g string, d int")
    cols = ["g", "i"] + (["d"] if how in ("inner", "left") else [])
    want = sorted(tuple(r) for r in fact.join(dim, "g", how).select(*cols).collect())
    assert joins.hot_keys(fact, ["g"])
    for hot in (None, joins.hot_keys(fact, ["g"]), []):
        got = joins.spread_join(fact, dim, ["g"], ["i"], how, hot=hot)
        assert sorted(((tuple(r)) for r in got.select(*cols).collect()), key=str) == sorted(want, key=str)


def test_range_join(spark):
    rng = random.Random(3)
    points = [("1" if rng.random() < 0.5 else "2", rng.choice([77, rng.randrange(200000)]), i) for i in range(3000)]
    spans = [("1", s, s + rng.choice([1, 50, 60000]), f"n{s}") for s in range(0, 180000, 9000)]
    p = spark.createDataFrame(points, "chrom string, pos bigint, i int")
    s = spark.createDataFrame(spans, "chrom string, iv_start bigint, iv_end bigint, name string")
    got = sorted((r["i"], r["name"]) for r in joins.range_join(p, s, spread_by=["i"]).select("i", "name").collect())
    want = sorted((i, n) for c, x, i in points for d, a, b, n in spans if c == d and a <= x < b)
    assert got == want


def step_up(p):
    p = np.asarray(p)
    order = np.argsort(p)
    out = np.empty(len(p))
    low = 1.0
    for rank in range(len(p), 0, -1):
        i = order[rank - 1]
        low = min(low, p[i] * len(p) / rank)
        out[i] = low
    return out


def test_adjusted_p(spark):
    rng = random.Random(4)
    p = [rng.choice([1.0, 0.01, rng.random()]) for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)] + [(9999, None)], "gene int, p double")
    got = {r["gene"]: r["padj"] for r in bulk.adjusted_p(df).collect()}
    assert got.pop(9999) is None
    want = step_up(p)
    assert [got[i] for i in range(len(p))] == pytest.approx(list(want))
    assert all(got[i] >= v - 1e-12 for i, v in enumerate(p)) and max(got.values()) <= 1


def test_tails():
    assert tails.t_p(np.array([2.0, 0.0]), np.array([10.0, 3.0])) == pytest.approx([0.07338803, 1.0])
    assert tails.t_p(np.array([30.0]), np.array([4.0])) == pytest.approx([7.35e-6], rel=0.01)
    assert tails.chi2_p(np.array([3.841458820694124, 0.0, 25.0]), np.array([1.0, 2.0, 10.0])) == pytest.approx([0.05, 1.0, 0.005345505], rel=1e-5)
    assert tails.normal_p(np.array([1.959963984540054])) == pytest.approx([0.05])


@pytest.mark.parametrize("df", [1e4, 5e4, 1e5, 1e6, 1e7])
def test_tails_of_many_degrees(df):
    # The median is df - 2/3 and the density there 1 / (4 pi df)^0.5, up to higher terms.
    want = 0.5 - 1 / (3 * math.sqrt(math.pi * df))
    got = tails.chi2_p(np.array([df, np.nan, np.inf, 0.0]), np.array([df, 3.0, 3.0, 3.0]))
    assert got[0] == pytest.approx(want, abs=2e-5) and np.isnan(got[1]) and got[2] == 0 and got[3] == 1
    assert tails.t_p(np.array([1.959963984540054]), np.array([df])) == pytest.approx([0.05], abs=5 / df)


def test_float_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 1.0)], "a double, b double")
    got = drop_missing(df.select(float_division(F.col("a"), F.col("b")).alias("q")))
    assert sorted(r["q"] for r in got.collect()) == [-math.inf, 2.0, math.inf]


def brute_neighbors(points, k):
    ids, m = [p[0] for p in points], np.array([p[1] for p in points])
    out = {}
    for i, a in zip(ids, m):
        d = np.sqrt(((m - a) ** 2).sum(1))
        out[i] = sorted(float(x) for x, j in zip(d, ids) if j != i)[:k]
    return out


@pytest.mark.parametrize("copies", [0, 120])
def test_nearest_neighbors(spark, monkeypatch, copies):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 20)
    monkeypatch.setattr(neighbors, "ONE_CELL_BLOCKS", 1)
    rng = np.random.default_rng(5)
    points = [(i, (rng.normal(size=3) + 6 * (i % 4)).tolist()) for i in range(300)]
    points += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(copies)]
    df = spark.createDataFrame(points, "id bigint, v array<double>")
    near = neighbors.nearest_neighbors(df, 5).collect()
    got = {}
    for r in near:
        assert r["src"] != r["dst"]
        got.setdefault(r["src"], {})[r["place"]] = r["distance"]
    want = brute_neighbors(points, 5)
    assert set(got) == set(want)
    for i, places in got.items():
        assert sorted(places) == [1, 2, 3, 4, 5]
        assert [places[p] for p in range(1, 6)] == pytest.approx(want[i], abs=1e-9)
    incoming = pd.Series([r["dst"] for r in near]).value_counts()
    assert incoming.max() < 60  # copies do not all point at the same few


def test_neighbors_of_structureless_vectors_are_sent_once_per_tile(spark, monkeypatch):
    """Where no bound prunes, a vector goes to every tile once, however many cells the tile has."""
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 200)
    monkeypatch.setattr(neighbors, "ONE_CELL_BLOCKS", 1)
    written, keep = {}, neighbors.materialised
    monkeypatch.setattr(neighbors, "materialised", lambda df, label: written.setdefault(label, keep(df, label)))
    rng = np.random.default_rng(11)
    points = [(i, rng.random(16).tolist()) for i in range(900)]
    near = neighbors.nearest_neighbors(spark.createDataFrame(points, "id bigint, v array<double>"), 5).collect()
    got = {}
    for r in sorted(near, key=lambda r: r["place"]):
        got.setdefault(r["src"], []).append(r["distance"])
    want = brute_neighbors(points, 5)
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)
    assert written["cells"].select("cell").distinct().count() > 20
    sent = [r["n"] for r in written["visits"].select(F.size("tiles").alias("n")).collect()]
    assert 0 < max(sent) <= 9 and all(len(set(r["tiles"])) == len(r["tiles"]) for r in written["visits"].collect())


def test_neighbors_at_equal_distance_come_by_id(spark):
    points = [(i, [float(i == j) for j in range(40)]) for i in range(40)]
    near = neighbors.nearest_neighbors(spark.createDataFrame(points, "id bigint, v array<double>"), 3).collect()
    got = {i: [r["dst"] for r in sorted(near, key=lambda r: r["place"]) if r["src"] == i] for i in range(40)}
    assert got == {i: [j for j in range(5) if j != i][:3] for i in range(40)}


@pytest.mark.parametrize("odd", [[[1.0, 2.0], None, [3.0, 4.0]], [[1.0, 2.0], [3.0], [4.0, 5.0, 6.0]]])
def test_neighbors_need_whole_vectors(spark, odd):
    df = spark.createDataFrame(list(enumerate(odd)), "id bigint, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="missing or differ|inhomogeneous"):
        neighbors.nearest_neighbors(df, 1).collect()


def test_shared_neighbor_weights(spark):
    rng = random.Random(6)
    k, lists = 6, {}
    for i in range(120):
        lists[i] = set(rng.sample([j for j in range(120) if j != i], k - 1)) | {0 if i else 1}
        while len(lists[i]) < k:
            lists[i].add(rng.choice([j for j in range(120) if j != i]))
    df = spark.createDataFrame([(i, j) for i, l in lists.items() for j in l], "src bigint, dst bigint")
    got = {(r["src"], r["dst"]): r["w"] for r in neighbors.shared_neighbor_weights(df, k, 0.2).collect()}
    want = {}
    for i in lists:
        for j in lists:
            if i < j:
                a, b = lists[i] | {i}, lists[j] | {j}
                w = len(a & b) / len(a | b)
                if w >= 0.2:
                    want[(i, j)] = w
    assert got == pytest.approx(want)


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, 1001 + i) for i in range(300)]
    edges += [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(parent)}
    rng.shuffle(edges)
    got = graph.connected_components(spark.createDataFrame(edges, "src bigint, dst bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_communities(spark):
    edges = []
    for block in range(3):
        nodes = range(block * 8, block * 8 + 8)
        edges += [(a, b) for a in nodes for b in nodes if a < b]
    edges += [(0, 8), (8, 16)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    found = {r["node"]: r["community"] for r in graph.communities(df).collect()}
    groups = [{found[n] for n in range(b * 8, b * 8 + 8)} for b in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    g = graph.undirected(df)
    single = spark.createDataFrame([(n, n) for n in range(24)], "node bigint, community bigint")
    mine = spark.createDataFrame(list(found.items()), "node bigint, community bigint")
    assert graph.modularity(g, mine) > graph.modularity(g, single)


def test_autozygous_runs_match_one_pass(spark):
    rng = random.Random(8)
    rows, pos = [], 0
    for i in range(900):
        pos += rng.randrange(1000, 9000)
        stretch = 300 <= i < 600
        dose = rng.choice([0, 2]) if stretch else rng.choice([0, 1, 1, 2])
        rows.append(("s", "1", pos, dose, 0.5))
    df = spark.createDataFrame(rows, "sample string, chrom string, pos bigint, dosage int, af double")
    got = [(r["start"], r["end"], r["n_markers"]) for r in homozygosity.autozygous_runs(df).orderBy("start").collect()]
    p = np.array([r[2] for r in rows], dtype=float)
    emit = homozygosity._log_emissions(np.full(900, 0.5), np.array([r[3] for r in rows]), 1e-3)
    steps = homozygosity._log_moves(np.diff(p, prepend=p[0])) + emit[:, None, :]
    score, back = np.zeros(2), []
    for s in steps:
        options = score[:, None] + s
        back.append(options.argmax(0))
        score = options.max(0)
    state, path = int(score.argmax()), []
    for b in back[::-1]:
        path.append(state)
        state = int(b[state])
    path = path[::-1]
    want, i = [], 0
    while i < 900:
        if path[i] == 1:
            j = i
            while j + 1 < 900 and path[j + 1] == 1:
                j += 1
            want.append((int(p[i]), int(p[j]), j - i + 1))
            i = j
        i += 1
    assert got == want and len(got) >= 1


def test_rank_sums_with_one_dominant_gene(spark):
    rng = random.Random(9)
    cell_rows = [(c, c % 3) for c in range(90)]
    expr = [(c, 0, float(rng.randrange(1, 6))) for c in range(90)] + [(c, g, float(rng.randrange(1, 4))) for g in range(1, 6) for c in range(90) if rng.random() < 0.2]
    x = spark.createDataFrame(expr, "cell int, gene int, x double")
    cl = spark.createDataFrame(cell_rows, "cell int, cluster int")
    got = {(r["gene"], r["cluster"]): (r["u"], r["p"]) for r in markers.rank_sums(x, cl).collect()}
    for gene in range(6):
        full = np.zeros(90)
        for c, g, v in expr:
            if g == gene:
                full[c] = v
        ranks = pd.Series(full).rank().to_numpy()
        for k in range(3):
            mine = np.array([c % 3 == k for c in range(90)])
            assert got[(gene, k)][0] == pytest.approx(ranks[mine].sum() - 30 * 31 / 2)
            assert 0 <= got[(gene, k)][1] <= 1


def test_contrast_finds_changed_genes(spark):
    rng = np.random.default_rng(10)
    rows = []
    for g in range(300):
        mean = rng.uniform(50, 500)
        for s in range(6):
            mu = mean * (4 if g < 10 and s >= 3 else 1) * (1 + 0.2 * (s % 2))
            rows.append((s, "control" if s < 3 else "patient", g, int(rng.negative_binomial(20, 20 / (20 + mu)))))
    df = spark.createDataFrame(rows, "sample int, condition string, gene int, n bigint")
    got = contrast.fit_contrast(df).toPandas().set_index("gene")
    assert (got.loc[range(10), "lfc"] - 2).abs().max() < 1
    assert (got.loc[range(10), "padj"] < 0.05).all() and (got.loc[range(10, 300), "padj"] < 0.05).mean() < 0.1
    small = contrast.shrunken_changes(spark.createDataFrame(got.reset_index()[["gene", "lfc", "lfc_se"]])).toPandas()
    assert (small.lfc_shrunk.abs() <= small.lfc.abs() + 1e-9).all()
    assert (np.sign(small.lfc_shrunk) == np.sign(small.lfc)).mean() > 0.99


def test_components_are_orthonormal(spark):
    rng = np.random.default_rng(11)
    m = rng.normal(size=(80, 6)) * np.array([5, 3, 2, 1, 1, 0.5])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id int, v array<double>")
    scores, loadings, share = reduce.principal_components(df, 4)
    table = loadings.toPandas().pivot(index="feature", columns="component", values="loading").to_numpy()
    assert table.T @ table == pytest.approx(np.eye(4), abs=1e-9)
    assert share == sorted(share, reverse=True) and sum(share) <= 1
    got = np.array([r["pcs"] for r in scores.orderBy("id").collect()])
    assert got == pytest.approx((m - m.mean(0)) @ table, abs=1e-9)
    assert all(table[np.abs(table[:, j]).argmax(), j] > 0 for j in range(4))


def test_duplicates_keep_the_best_read(spark):
    rows = [("lib", 1, 10, 0, i % 7, i) for i in range(500)] + [("lib", 2, 5, 1, 3, 900)]
    df = spark.createDataFrame(rows, "library string, chrom int, pos bigint, strand int, qual_sum bigint, name bigint")
    kept = reads.mark_duplicates(df).where("NOT duplicate").select("name").collect()
    assert sorted(r["name"] for r in kept) == [6, 900]


def test_mates_share_their_fate(spark):
    rows = [  # r1 and r2 share the place of mate 1 only; r3 is a copy of r1; r4 is single at that place
        ("lib", "r1", 1, 1, 10, 0, 30), ("lib", "r1", 2, 1, 90, 1, 30), ("lib", "r2", 1, 1, 10, 0, 40),
        ("lib", "r2", 2, 2, 95, 1, 40), ("lib", "r3", 1, 1, 10, 0, 20), ("lib", "r3", 2, 1, 90, 1, 39),
        ("lib", "r4", 1, 1, 10, 0, 99),
    ]
    df = spark.createDataFrame(rows, "library string, name string, mate int, chrom int, pos bigint, strand int, qual_sum bigint")
    got = sorted((r["name"], r["mate"], r["duplicate"]) for r in reads.mark_duplicates(df).collect())
    assert got == [(r[1], r[2], r[1] == "r3") for r in rows]


def test_absent_barcode_fails(spark):
    known = spark.createDataFrame([(1, "A")], "cell int, barcode string")
    with pytest.raises(Exception, match="barcode not in the data"):
        cells.listed_cells(known, spark.createDataFrame([("B",)], "barcode string")).collect()


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(), "cell string, gene int, n double")
    plan = cells.top_shares(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_quality_filters_reach_the_scan(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumnRenamed("l_linenumber", "dp")
    plan = variants.min_genotype_depth(items).select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_linenumber,6)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_majority_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "cluster int, label string")
    got = sorted((r["cluster"], r["majority"]) for r in labels.majority_labels(df, "cluster", "label").collect())
    assert got == [(1, "a"), (2, "c")]


def test_best_paths_compose_and_are_plain_arithmetic():
    """Ties go to the first state, as with array operations, which take several times as long per marker."""
    rng = np.random.default_rng(3)
    steps = np.round(np.log(rng.random((20000, 2, 2))), 0)
    began = time.perf_counter()
    score, back = np.array([[0.0, -np.inf], [-np.inf, 0.0]]), []
    for step in steps:
        options = score[:, :, None] + step[None, :, :]
        back.append(options.argmax(axis=1))
        score = options.max(axis=1)
    arrays = time.perf_counter() - began
    took = []
    for _ in range(3):
        began = time.perf_counter()
        got = homozygosity._best_paths(steps)
        took.append(time.perf_counter() - began)
    assert np.array_equal(got[0], score) and np.array_equal(got[1], np.array(back))
    assert min(took) < arrays / 2
    empty = homozygosity._best_paths(steps[:0])
    assert empty[1].shape == (0, 2, 2)


def test_incomplete_beta_takes_one_fraction_and_lets_settled_values_go(monkeypatch):
    calls, keep = [], tails.beta_fraction
    monkeypatch.setattr(tails, "beta_fraction", lambda a, b, x: calls.append(len(x)) or keep(a, b, x))
    a, x = np.array([0.5, 3.0, 15000.0, 2.0, 2.0]), np.array([0.2, 0.99, 0.9999, 0.0, 1.0])
    got = tails.incomplete_beta(a, np.full(5, 0.5), x)
    assert calls == [5]
    steps = (np.arange(200000) + 0.5) / 200000
    for i, (p, at) in enumerate(zip(a[:3], x[:3])):
        t = math.sqrt(1 - at) * steps  # x = 1 - t * t takes the pole away
        above = 2 * np.sum((1 - t * t) ** (p - 1)) * math.sqrt(1 - at) / len(steps)
        full = math.exp(math.lgamma(p) + math.lgamma(0.5) - math.lgamma(p + 0.5))
        assert got[i] == pytest.approx(1 - above / full, abs=1e-7)
    assert got[3] == 0.0 and got[4] == 1.0
