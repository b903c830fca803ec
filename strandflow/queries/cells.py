"""Queries over cell x gene counts."""

from pyspark.sql import functions as F

from ..operators import cells, labels, markers
from ..operators.ordered import exact_quantiles
from ..shared import materialised
from .base import register, rounded, table, view

N = "(SELECT COUNT(*) FROM v_cells)"
TOTAL = "tot AS (SELECT cell, CAST(SUM(n) AS BIGINT) AS total, COUNT(*) AS n_genes FROM v_expr GROUP BY cell)"
QC = """qc AS (SELECT c.cell, c.cluster, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_counts, COUNT(n) AS n_genes,
 100.0 * (CAST(SUM(CASE WHEN mt THEN n ELSE 0 END) AS DOUBLE) / NULLIF(SUM(n), 0)) AS pct_flagged
 FROM v_cells c LEFT JOIN v_expr e ON c.cell = e.cell LEFT JOIN v_genes g ON e.gene = g.gene GROUP BY c.cell, c.cluster)"""
NORM = f"{TOTAL}, x AS (SELECT e.cell, gene, ln(1 + (CAST(n AS DOUBLE) / total) * 10000.0) AS x FROM v_expr e JOIN tot t ON e.cell = t.cell)"


def _expr(spark, d):
    return view(spark, d, "v_expr")


def _cells(spark, d):
    return view(spark, d, "v_cells")


def _qc(spark, d):
    flagged = view(spark, d, "v_genes").where("mt")
    return cells.cell_qc(_expr(spark, d), _cells(spark, d), flagged)


def _norm(spark, d):
    return cells.normalised(_expr(spark, d))


@register("A01_cell_qc", f", {QC} SELECT cell, total_counts, n_genes, round(pct_flagged, 6) AS pct_flagged FROM qc", "v_expr v_cells v_genes")
def cell_qc(spark, d):
    return rounded(_qc(spark, d))


@register(
    "A02_gene_qc",
    f"SELECT gene, COUNT(*) AS n_cells, CAST(SUM(n) AS BIGINT) AS total, round(SUM(n) / CAST({N} AS DOUBLE), 6) AS mean, round(100.0 * (1.0 - COUNT(*) / CAST({N} AS DOUBLE)), 6) AS pct_dropout FROM v_expr GROUP BY gene",
    "v_expr v_cells",
)
def gene_qc(spark, d):
    return rounded(cells.gene_qc(_expr(spark, d), _cells(spark, d)))


@register(
    "A03_top_gene_shares",
    f""", {TOTAL}, r AS (SELECT cell, n, row_number() OVER (PARTITION BY cell ORDER BY n DESC, gene) AS rn FROM v_expr)
SELECT t.cell, {', '.join(f'round(100.0 * (CAST(SUM(CASE WHEN rn <= {k} THEN n ELSE 0 END) AS DOUBLE) / total), 6) AS pct_top_{k}' for k in (50, 100, 200, 500))},
 round(ln(1 + total), 6) AS log1p_total_counts, round(ln(1 + n_genes), 6) AS log1p_n_genes
 FROM r JOIN tot t ON r.cell = t.cell GROUP BY t.cell, total, n_genes""",
    "v_expr",
)
def top_shares(spark, d):
    return rounded(cells.top_shares(_expr(spark, d)))


HIGHEST = f""", {TOTAL}, m AS (SELECT gene, SUM(100.0 * (CAST(n AS DOUBLE) / total)) / CAST({N} AS DOUBLE) AS mean_percent FROM v_expr e JOIN tot t ON e.cell = t.cell GROUP BY gene)
SELECT gene, round(mean_percent, 6) AS mean_percent FROM m ORDER BY round(mean_percent, 9) DESC, gene LIMIT 20"""


@register("A04_highest_expressed", HIGHEST, "v_expr v_cells")
def highest(spark, d):
    return rounded(cells.highest_expressed(_expr(spark, d), _cells(spark, d)))


@register("T05_top_by_value", "SELECT gene, total FROM (SELECT gene, CAST(SUM(n) AS BIGINT) AS total FROM v_expr GROUP BY gene) AS g ORDER BY total DESC, gene LIMIT 10", "v_expr")
def top_by_value(spark, d):
    totals = _expr(spark, d).groupBy("gene").agg(F.sum("n").alias("total"))
    return cells.top_genes(totals, "total", 10)


FLOOR = """kc AS (SELECT * FROM v_expr WHERE cell IN (SELECT cell FROM v_expr GROUP BY cell HAVING COUNT(*) >= {0})),
kg AS (SELECT * FROM kc WHERE gene IN (SELECT gene FROM kc GROUP BY gene HAVING COUNT(*) >= {1}))"""


@register("P13_floor_cells_and_genes", f", {FLOOR.format(190, 8)} SELECT cell, gene, n FROM kg", "v_expr")
def floored(spark, d):
    return cells.floor_cells_and_genes(_expr(spark, d), 190, 8).select("cell", "gene", "n")


@register("P13_default_floor", f", {FLOOR.format(200, 3)} SELECT COUNT(*) AS n, COUNT(DISTINCT cell) AS n_cells, COUNT(DISTINCT gene) AS n_genes FROM kg", "v_expr")
def default_floor(spark, d):
    kept = cells.floor_cells_and_genes(_expr(spark, d))
    return kept.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cell").alias("n_cells"), F.count_distinct("gene").alias("n_genes")
    )


@register("P14_cells_within_qc", f", {QC} SELECT cell, total_counts, n_genes, round(pct_flagged, 6) AS pct_flagged FROM qc WHERE n_genes > 188 AND n_genes < 530 AND pct_flagged < 4.5", "v_expr v_cells v_genes")
def within_qc(spark, d):
    return rounded(cells.within_qc(_qc(spark, d), 188, 530, 4.5))


@register(
    "P15_without_outliers",
    f""", {QC}, b AS (SELECT cluster, AVG(CAST(total_counts AS DOUBLE)) AS m, stddev_samp(CAST(total_counts AS DOUBLE)) AS s FROM qc GROUP BY cluster)
SELECT cell, qc.cluster AS sample, total_counts FROM qc JOIN b ON qc.cluster = b.cluster WHERE total_counts BETWEEN m - s AND m + s AND pct_flagged < 10""",
    "v_expr v_cells v_genes",
)
def outliers(spark, d):
    qc = _qc(spark, d).join(_cells(spark, d).select("cell", F.col("cluster").alias("sample")), "cell")
    return cells.without_outliers(qc, width=1.0).select("cell", "sample", "total_counts")


@register("P16_flagged_genes", "SELECT gene, symbol, starts_with(symbol, 'red') AS mt FROM v_genes", "v_genes")
def flagged(spark, d):
    return cells.flag_genes(view(spark, d, "v_genes").select("gene", "symbol"), "red")


@register("P17_listed_cells", "SELECT cell, barcode, cluster FROM v_cells WHERE condition = 'patient'", "v_cells")
def listed(spark, d):
    every = _cells(spark, d)
    wanted = every.where("condition = 'patient'").select("barcode")
    return cells.listed_cells(every.select("cell", "barcode", "cluster"), wanted)


@register("J05_attached_labels", "SELECT cell, barcode, CASE WHEN condition = 'patient' THEN condition END AS label FROM v_cells", "v_cells")
def attached(spark, d):
    every = _cells(spark, d)
    outside = every.where("condition = 'patient'").select("barcode", F.col("condition").alias("label"))
    return cells.attach_labels(every.select("cell", "barcode"), outside, "label").select("cell", "barcode", "label")


@register("F02_normalised", f", {NORM} SELECT cell, gene, round(x, 6) AS x FROM x", "v_expr")
def normalised(spark, d):
    return rounded(_norm(spark, d))


@register(
    "F02_median_normalised",
    f", {TOTAL} SELECT e.cell, gene, round(ln(1 + (CAST(n AS DOUBLE) / total) * (SELECT quantile_cont(total, 0.5) FROM tot)), 6) AS x FROM v_expr e JOIN tot t ON e.cell = t.cell",
    "v_expr",
)
def median_normalised(spark, d):
    return rounded(cells.normalised(_expr(spark, d), None))


MOMENTS = f"mom AS (SELECT gene, SUM(x) / {N} AS mean, (SUM(x * x) - SUM(x) * SUM(x) / {N}) / ({N} - 1) AS var FROM x GROUP BY gene)"


@register(
    "F03_scaled",
    f", {NORM}, {MOMENTS} SELECT cell, x.gene, round(least(2.0, (x - mean) / sqrt(var)), 5) AS z FROM x JOIN mom ON x.gene = mom.gene",
    "v_expr v_cells",
)
def scaled(spark, d):
    return rounded(cells.scaled(_norm(spark, d), _cells(spark, d), 2.0)[0], 5)


@register("F03_scaled_zero", f", {NORM}, {MOMENTS} SELECT gene, round(-mean / sqrt(var), 5) AS zero FROM mom", "v_expr v_cells")
def scaled_zero(spark, d):
    return rounded(cells.scaled(_norm(spark, d), _cells(spark, d))[1], 5)


DISPERSION = f"""{NORM}, lin AS (SELECT gene, SUM(exp(x) - 1) / {N} AS m, (SUM((exp(x) - 1) * (exp(x) - 1)) - SUM(exp(x) - 1) * SUM(exp(x) - 1) / {N}) / ({N} - 1) AS v FROM x GROUP BY gene),
base AS (SELECT gene, ln(1 + m) AS mean, ln(v / m) AS dispersion FROM lin),
span AS (SELECT MIN(mean) AS lo, MAX(mean) AS hi FROM base),
binned AS (SELECT base.*, CAST(least(greatest(ceil((mean - lo) / ((hi - lo) / 20.0)), 1), 20) AS INT) AS bin FROM base, span),
st AS (SELECT bin, AVG(dispersion) AS m, stddev_samp(dispersion) AS s FROM binned GROUP BY bin),
score AS (SELECT gene, mean, dispersion, b.bin, CASE WHEN s IS NULL THEN 1.0 ELSE (dispersion - m) / s END AS score FROM binned b JOIN st ON b.bin = st.bin)"""


def _scores(spark, d):
    return cells.dispersion_scores(_norm(spark, d), _cells(spark, d))


@register("W09_dispersion_scores", f", {DISPERSION} SELECT gene, round(mean, 5) AS mean, round(dispersion, 5) AS dispersion, bin, round(score, 5) AS score FROM score", "v_expr v_cells")
def dispersion(spark, d):
    return rounded(_scores(spark, d), 5)


@register("W09_variable_by_cutoff", f", {DISPERSION} SELECT gene FROM score WHERE mean > 0.0125 AND mean < 3 AND score > 0.5", "v_expr v_cells")
def by_cutoff(spark, d):
    return cells.variable_by_cutoff(_scores(spark, d)).select("gene")


@register("W09_variable_top", f", {DISPERSION} SELECT gene FROM score ORDER BY score DESC, gene LIMIT 100", "v_expr v_cells")
def by_top(spark, d):
    return cells.top_genes(_scores(spark, d), "score", 100).select("gene")


def _det(a):
    return (
        f"({a[0][0]} * ({a[1][1]} * {a[2][2]} - {a[1][2]} * {a[2][1]}) - {a[0][1]} * ({a[1][0]} * {a[2][2]} - {a[1][2]} * {a[2][0]})"
        f" + {a[0][2]} * ({a[1][0]} * {a[2][1]} - {a[1][1]} * {a[2][0]}))"
    )


_M = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
_COEF = ", ".join(
    f"{_det([[f't{r}' if c == i else _M[r][c] for c in range(3)] for r in range(3)])} / {_det(_M)} AS c{i}" for i in range(3)
)
VST = f"""mom AS (SELECT gene, COUNT(*) AS k, SUM(n) / CAST({N} AS DOUBLE) AS mean, (SUM(n * n) - CAST(SUM(n) AS DOUBLE) * SUM(n) / {N}) / ({N} - 1) AS var FROM v_expr GROUP BY gene),
lg AS (SELECT gene, k, mean, log10(mean) - (SELECT AVG(log10(mean)) FROM mom WHERE var > 0) AS u, log10(var) AS v FROM mom WHERE var > 0),
sm AS (SELECT CAST(COUNT(*) AS DOUBLE) AS s0, SUM(u) AS s1, SUM(u*u) AS s2, SUM(u*u*u) AS s3, SUM(u*u*u*u) AS s4, SUM(v) AS t0, SUM(u*v) AS t1, SUM(u*u*v) AS t2 FROM lg),
cf AS (SELECT {_COEF} FROM sm),
ft AS (SELECT gene, k, mean, sqrt(pow(10.0, c0 + c1*u + c2*u*u)) AS sd FROM lg, cf),
vst AS (SELECT f.gene, MAX(f.mean) AS mean, (SUM(pow(least((n - f.mean) / f.sd, sqrt({N})), 2)) + ({N} - MAX(f.k)) * pow(MAX(f.mean) / MAX(f.sd), 2)) / ({N} - 1) AS variance
 FROM v_expr e JOIN ft f ON e.gene = f.gene GROUP BY f.gene)"""


@register("W10_stabilised_variance", f", {VST} SELECT gene, round(mean, 5) AS mean, round(variance, 5) AS variance FROM vst", "v_expr v_cells")
def stabilised(spark, d):
    return rounded(cells.stabilised_variance(_expr(spark, d), _cells(spark, d)), 5)


@register("W10_variable_top", f", {VST} SELECT gene FROM vst ORDER BY variance DESC, gene LIMIT 100", "v_expr v_cells")
def stabilised_top(spark, d):
    return cells.top_genes(cells.stabilised_variance(_expr(spark, d), _cells(spark, d)), "variance", 100).select("gene")


@register(
    "G08_regressed",
    f""", {QC}, {NORM}, sel AS (SELECT gene FROM v_expr GROUP BY gene ORDER BY SUM(n) DESC, gene LIMIT 50),
z AS (SELECT cell, total_counts - (SELECT AVG(total_counts) FROM qc) AS a, pct_flagged - (SELECT AVG(pct_flagged) FROM qc) AS b FROM qc),
sh AS (SELECT SUM(a*a) AS aa, SUM(a*b) AS ab, SUM(b*b) AS bb, COUNT(*) AS n FROM z),
dn AS (SELECT z.cell, sel.gene, a, b, COALESCE(x.x, 0) AS y FROM z CROSS JOIN sel LEFT JOIN x ON x.cell = z.cell AND x.gene = sel.gene),
fit AS (SELECT gene, SUM(y) / MAX(n) AS b0, (SUM(y*a) * MAX(bb) - SUM(y*b) * MAX(ab)) / (MAX(aa)*MAX(bb) - MAX(ab)*MAX(ab)) AS b1,
 (SUM(y*b) * MAX(aa) - SUM(y*a) * MAX(ab)) / (MAX(aa)*MAX(bb) - MAX(ab)*MAX(ab)) AS b2 FROM dn, sh GROUP BY gene)
SELECT dn.cell, dn.gene, round(y - b0 - b1*a - b2*b, 5) AS residual FROM dn JOIN fit ON dn.gene = fit.gene""",
    "v_expr v_cells v_genes",
)
def regressed(spark, d):
    expr = _expr(spark, d)
    totals = expr.groupBy("gene").agg(F.sum("n").alias("total"))
    chosen = cells.top_genes(totals, "total", 50)
    return rounded(
        cells.regressed(_norm(spark, d), _cells(spark, d), _qc(spark, d), chosen, ("total_counts", "pct_flagged")), 5
    )


RESIDUALS = f"""{QC}, {DISPERSION}, sel AS (SELECT gene FROM score WHERE mean > 0.0125 AND mean < 3 AND score > 0.5),
z AS (SELECT cell, total_counts - (SELECT AVG(total_counts) FROM qc) AS a, pct_flagged - (SELECT AVG(pct_flagged) FROM qc) AS b FROM qc),
sh AS (SELECT SUM(a*a) AS aa, SUM(a*b) AS ab, SUM(b*b) AS bb, COUNT(*) AS n FROM z),
dn AS (SELECT z.cell, sel.gene, a, b, x.x, COALESCE(x.x, 0) AS y FROM z CROSS JOIN sel LEFT JOIN x ON x.cell = z.cell AND x.gene = sel.gene),
fit AS (SELECT gene, SUM(y) / MAX(n) AS b0, (SUM(y*a) * MAX(bb) - SUM(y*b) * MAX(ab)) / (MAX(aa)*MAX(bb) - MAX(ab)*MAX(ab)) AS b1,
 (SUM(y*b) * MAX(aa) - SUM(y*a) * MAX(ab)) / (MAX(aa)*MAX(bb) - MAX(ab)*MAX(ab)) AS b2 FROM dn, sh GROUP BY gene),
rs AS (SELECT dn.cell, dn.gene, x, y - b0 - b1*a - b2*b AS r, - b0 - b1*a - b2*b AS z FROM dn JOIN fit ON dn.gene = fit.gene)"""


def _residual_input(spark, d):
    x = materialised(_norm(spark, d), "normalised")
    chosen = materialised(cells.variable_by_cutoff(cells.dispersion_scores(x, _cells(spark, d))).select("gene"), "chosen")
    return x, _qc(spark, d), chosen, ("total_counts", "pct_flagged")


@register(
    "G08_residual_rows",
    f", {RESIDUALS} SELECT cell, gene, round(r, 5) AS residual, round(z, 5) AS zero FROM rs WHERE x IS NOT NULL",
    "v_expr v_cells v_genes",
)
def residual_rows(spark, d):
    """Residuals of the stored values of all variable genes."""
    return rounded(cells.residual_rows(*_residual_input(spark, d)), 5)


@register(
    "G08_residual_covariance",
    f", {RESIDUALS} SELECT p.gene AS a, q.gene AS b, round(SUM(p.r * q.r) / (COUNT(*) - 1), 5) + 0.0 AS covariance FROM rs p JOIN rs q ON p.cell = q.cell AND p.gene <= q.gene GROUP BY p.gene, q.gene",
    "v_expr v_cells v_genes",
)
def residual_covariance(spark, d):
    """Covariance of the residuals of all variable genes, zeros included."""
    return rounded(cells.residual_covariance(*_residual_input(spark, d)), 5)


@register(
    "P27_display_clip",
    f", {NORM}, q AS (SELECT gene, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM x GROUP BY gene) SELECT cell, x.gene, round(least(greatest(x, lo), hi), 6) AS x FROM x JOIN q ON x.gene = q.gene",
    "v_expr",
)
def display_clip(spark, d):
    return rounded(cells.display_clip(_norm(spark, d)))


@register(
    "A36_stage_counts",
    f", {QC} SELECT 0 AS stage, 'before' AS name, COUNT(*) AS n FROM qc UNION ALL SELECT 1, 'after', COUNT(*) FROM qc WHERE n_genes > 0 AND n_genes < 195 AND pct_flagged < 20",
    "v_expr v_cells v_genes",
)
def stage_counts(spark, d):
    qc = _qc(spark, d)
    return cells.stage_counts({"before": qc, "after": cells.within_qc(qc, 0, 195)})


@register(
    "A34_histogram",
    """WITH s AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 60.0)), 59) AS INT) AS bin, COUNT(*) AS n FROM lineitem, s GROUP BY 1""",
)
def histogram(spark, d):
    return cells.histogram(table(spark, d, "lineitem"), "l_extendedprice")


QUANTS = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}


@register(
    "A34_quantiles",
    "SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS {n}" for n, p in QUANTS.items()) + " FROM lineitem GROUP BY l_returnflag",
)
def quantiles(spark, d):
    return rounded(exact_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", QUANTS))


SIZES = f"sz AS (SELECT cluster, COUNT(*) AS n_in, {N} - COUNT(*) AS n_out FROM v_cells GROUP BY cluster)"
DENSE = f"""{SIZES}, dn AS (SELECT g.gene, c.cell, c.cluster, COALESCE({{value}}, 0) AS x FROM (SELECT DISTINCT gene FROM v_expr) g CROSS JOIN v_cells c
 LEFT JOIN {{source}} e ON e.gene = g.gene AND e.cell = c.cell)"""
STATS = f"""{NORM}, {DENSE.format(value='e.x', source='x')},
ms AS (SELECT gene, sz.cluster, SUM(CASE WHEN dn.cluster = sz.cluster AND x > 0 THEN 1 ELSE 0 END) / CAST(MAX(n_in) AS DOUBLE) AS pct_in,
 SUM(CASE WHEN dn.cluster <> sz.cluster AND x > 0 THEN 1 ELSE 0 END) / CAST(MAX(n_out) AS DOUBLE) AS pct_out,
 log2((SUM(CASE WHEN dn.cluster = sz.cluster THEN exp(x) - 1 ELSE 0 END) / MAX(n_in) + 1) / (SUM(CASE WHEN dn.cluster <> sz.cluster THEN exp(x) - 1 ELSE 0 END) / MAX(n_out) + 1)) AS avg_log2fc
 FROM dn CROSS JOIN sz GROUP BY gene, sz.cluster)"""


def _stats(spark, d):
    return markers.marker_stats(_norm(spark, d), _cells(spark, d))


@register("A18_marker_stats", f", {STATS} SELECT gene, cluster, round(pct_in, 6) AS pct_in, round(pct_out, 6) AS pct_out, round(avg_log2fc, 6) AS avg_log2fc FROM ms", "v_expr v_cells")
def marker_stats(spark, d):
    return rounded(_stats(spark, d))


@register("A18_marker_filter", f", {STATS} SELECT gene, cluster, round(avg_log2fc, 6) AS avg_log2fc FROM ms WHERE greatest(pct_in, pct_out) >= 0.25 AND avg_log2fc >= 0.25 AND abs(pct_in - pct_out) >= 0.1", "v_expr v_cells")
def marker_filter(spark, d):
    kept = markers.marker_filter(_stats(spark, d), min_diff=0.1)
    return rounded(kept.select("gene", "cluster", "avg_log2fc"))


WELCH = f"""{NORM}, {DENSE.format(value='e.x', source='x')},
w AS (SELECT gene, sz.cluster, MAX(n_in) AS n1, MAX(n_out) AS n2,
 AVG(CASE WHEN dn.cluster = sz.cluster THEN x END) AS m1, var_samp(CASE WHEN dn.cluster = sz.cluster THEN x END) / MAX(n_in) AS v1,
 AVG(CASE WHEN dn.cluster <> sz.cluster THEN x END) AS m2, var_samp(CASE WHEN dn.cluster <> sz.cluster THEN x END) / MAX(n_out) AS v2
 FROM dn CROSS JOIN sz GROUP BY gene, sz.cluster)"""


@register(
    "A19_welch",
    f", {WELCH} SELECT gene, cluster, round((m1 - m2) / sqrt(v1 + v2), 5) AS t, round((v1 + v2) * (v1 + v2) / (v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1)), 4) AS df FROM w",
    "v_expr v_cells",
)
def welch(spark, d):
    stats = markers.welch(_norm(spark, d), _cells(spark, d), with_p=False)
    return stats.select("gene", "cluster", F.round("t", 5).alias("t"), F.round("df", 4).alias("df"))


@register("A19_welch_p")
def welch_p(spark, d):
    return rounded(markers.welch(_norm(spark, d), _cells(spark, d)))


RANKS = f"""{DENSE.format(value='e.n', source='v_expr')},
rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY x) + (COUNT(*) OVER (PARTITION BY gene, x) - 1) / 2.0 AS r, COUNT(*) OVER (PARTITION BY gene, x) AS t FROM dn),
tie AS (SELECT gene, CAST(SUM(CAST(t AS DOUBLE) * t - 1) AS DOUBLE) AS tie FROM rk GROUP BY gene),
us AS (SELECT rk.gene, sz.cluster, MAX(n_in) AS n1, MAX(n_out) AS n2, MAX(tie) AS tie,
 SUM(CASE WHEN rk.cluster = sz.cluster THEN r ELSE 0 END) - MAX(n_in) * (MAX(n_in) + 1) / 2.0 AS u
 FROM rk CROSS JOIN sz JOIN tie ON rk.gene = tie.gene GROUP BY rk.gene, sz.cluster)"""
VAR = "(CAST(n1 AS DOUBLE) * n2 / 12.0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1.0))))"


@register(
    "A20_rank_sums",
    f", {RANKS} SELECT gene, cluster, CAST(u AS DOUBLE) AS u, round((u - n1 * n2 / 2.0) / sqrt({VAR}), 5) AS z FROM us",
    "v_expr v_cells",
)
def rank_sums(spark, d):
    stats = markers.rank_sums(_expr(spark, d), _cells(spark, d), "n", with_p=False)
    return stats.select("gene", "cluster", "u", F.round("z", 5).alias("z"))


@register("A20_rank_sum_p")
def rank_sum_p(spark, d):
    return rounded(markers.rank_sums(_expr(spark, d), _cells(spark, d), "n"))


@register("A21_auc", f", {RANKS} SELECT gene, round(CAST(u AS DOUBLE) / (n1 * n2), 6) AS auc FROM us WHERE cluster = 0", "v_expr v_cells")
def auc(spark, d):
    stats = markers.rank_sums(_expr(spark, d), _cells(spark, d), "n", with_p=False)
    return rounded(stats.where("cluster = 0").select("gene", "auc"))


MS = f"{STATS}, m6 AS (SELECT gene, cluster, round(avg_log2fc, 6) AS fc FROM ms)"


def _fc(spark, d):
    return rounded(_stats(spark, d).select("gene", "cluster", F.col("avg_log2fc").alias("fc")))


@register("W02_first_per_group", f", {MS} SELECT gene, cluster, fc FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY fc DESC, gene) AS rn FROM m6 WHERE fc > 1) AS r WHERE rn <= 10", "v_expr v_cells")
def first_per_group(spark, d):
    return markers.first_per_group(_fc(spark, d).where("fc > 1"), 10, [F.desc("fc"), F.asc("gene")])


@register("W03_best_with_ties", f", {MS} SELECT gene, cluster, floor(fc * 10) AS fc10 FROM (SELECT *, rank() OVER (PARTITION BY cluster ORDER BY floor(fc * 10) DESC) AS rn FROM m6) AS r WHERE rn <= 2", "v_expr v_cells")
def best_with_ties(spark, d):
    coarse = _fc(spark, d).select("gene", "cluster", F.floor(F.col("fc") * 10).cast("double").alias("fc10"))
    return markers.best_with_ties(coarse, 2, "fc10")


@register(
    "W04_names_table",
    f", {MS} SELECT place, {', '.join(f'MAX(CASE WHEN cluster = {g} THEN gene END) AS c{g}' for g in range(5))} FROM (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY fc DESC, gene) AS INT) AS place FROM m6) AS r WHERE place <= 5 GROUP BY place",
    "v_expr v_cells",
)
def names_table(spark, d):
    return markers.names_table(_fc(spark, d), range(5), 5, [F.desc("fc"), F.asc("gene")])


@register("W11_relabelled", "SELECT cell, cluster, ordinal, concat('type ', CAST(ordinal AS STRING)) AS cell_type FROM v_cells JOIN (SELECT cluster AS k, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, cluster) - 1 AS INT) AS ordinal FROM v_cells GROUP BY cluster) AS o ON cluster = k", "v_cells")
def relabelled(spark, d):
    names = [f"type {i}" for i in range(5)]
    return markers.relabelled(_cells(spark, d).select("cell", "cluster"), names)


@register("W13_downsampled")
def downsampled(spark, d):
    return markers.downsampled(_cells(spark, d), 10)


@register("W13_downsampled_sizes", "SELECT cluster, CAST(least(COUNT(*), 10) AS BIGINT) AS n FROM v_cells GROUP BY cluster", "v_cells")
def downsampled_sizes(spark, d):
    return markers.downsampled(_cells(spark, d), 10).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


PROFILE = "SELECT c.cluster AS label, c.condition AS profile, e.gene, CAST(SUM(n) AS DOUBLE) AS x FROM v_expr e JOIN v_cells c ON e.cell = c.cell GROUP BY c.cluster, c.condition, e.gene"


@register(
    "G10_reference_labels",
    f""", pr AS ({PROFILE}), gs AS (SELECT DISTINCT gene FROM pr),
cd AS (SELECT c.cell, gs.gene, COALESCE(e.n, 0) AS x FROM (SELECT DISTINCT cell FROM v_expr) c CROSS JOIN gs LEFT JOIN v_expr e ON e.cell = c.cell AND e.gene = gs.gene),
cr AS (SELECT cell, gene, rank() OVER (PARTITION BY cell ORDER BY x) + (COUNT(*) OVER (PARTITION BY cell, x) - 1) / 2.0 AS r FROM cd),
pd AS (SELECT p.label, p.profile, gs.gene, COALESCE(pr.x, 0) AS x FROM (SELECT DISTINCT label, profile FROM pr) p CROSS JOIN gs LEFT JOIN pr ON pr.label = p.label AND pr.profile = p.profile AND pr.gene = gs.gene),
rr AS (SELECT label, profile, gene, rank() OVER (PARTITION BY label, profile ORDER BY x) + (COUNT(*) OVER (PARTITION BY label, profile, x) - 1) / 2.0 AS s FROM pd),
co AS (SELECT cell, label, profile, corr(CAST(r AS DOUBLE), CAST(s AS DOUBLE)) AS c FROM cr JOIN rr ON cr.gene = rr.gene GROUP BY cell, label, profile),
sc AS (SELECT cell, label, quantile_cont(c, 0.8) AS score FROM co GROUP BY cell, label)
SELECT cell, label, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY score DESC, label) AS rn FROM sc) AS b WHERE rn = 1""",
    "v_expr v_cells",
)
def reference_labels(spark, d):
    expr, cell = _expr(spark, d), _cells(spark, d)
    profiles = (
        expr.join(cell, "cell").groupBy(F.col("cluster").alias("label"), F.col("condition").alias("profile"), "gene")
        .agg(F.sum("n").cast("double").alias("x"))
    )
    mine = expr.select("cell", "gene", F.col("n").cast("double").alias("x"))
    return rounded(labels.reference_labels(mine, profiles))


SCORES = f"{NORM}, sc AS (SELECT cell, label, 1.0 / (1.0 + exp(-(SUM(x * w) - 250.0))) AS score FROM x JOIN v_weights w ON x.gene = w.gene GROUP BY cell, label)"


def _model(spark, d):
    return labels.model_scores(_norm(spark, d), view(spark, d, "v_weights"), -250.0)


@register("G11_model_scores", f", {SCORES} SELECT cell, label, round(score, 6) AS score FROM sc", "v_expr v_weights")
def model_scores(spark, d):
    return rounded(_model(spark, d))


@register("A33_majority_labels", f", {SCORES}, best AS (SELECT cell, label FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY score DESC, label) AS rn FROM sc) AS b WHERE rn = 1) SELECT cluster, label AS majority, n FROM (SELECT cluster, label, COUNT(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, label) AS rn FROM best JOIN v_cells c ON best.cell = c.cell GROUP BY cluster, label) AS v WHERE rn = 1", "v_expr v_cells v_weights")
def majority(spark, d):
    best = labels.best_label(_model(spark, d)).join(_cells(spark, d).select("cell", "cluster"), "cell")
    return labels.majority_labels(best, "cluster", "label")
