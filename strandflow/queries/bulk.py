"""Queries over bulk counts, genes, sets and manifests."""

from pyspark.sql import functions as F

from ..operators import bulk, contrast, genes, manifest, sets
from .base import register, rounded, table, view

FACTORS = """ref AS (SELECT gene, AVG(ln(n)) AS ref FROM v_bulk WHERE n > 0 GROUP BY gene HAVING COUNT(*) = (SELECT COUNT(DISTINCT sample) FROM v_bulk)),
sf AS (SELECT sample, exp(quantile_cont(ln(n) - ref, 0.5)) AS size_factor FROM v_bulk b JOIN ref ON b.gene = ref.gene WHERE n > 0 GROUP BY sample),
nq AS (SELECT b.sample, condition, gene, n, n / size_factor AS q FROM v_bulk b JOIN sf ON b.sample = sf.sample)"""
S = "CAST((SELECT COUNT(DISTINCT sample) FROM v_bulk) AS DOUBLE)"


def _bulk(spark, d):
    return view(spark, d, "v_bulk")


def _normal(spark, d):
    b = _bulk(spark, d)
    return bulk.normalised_counts(b, bulk.size_factors(b))


MAPPED = "SELECT q.sample, q.tx, t.gene, q.n, q.len, q.tpm FROM v_quant q JOIN (SELECT DISTINCT tx_base, gene FROM v_tx2gene) t ON regexp_replace(q.tx, '\\..*$', '') = t.tx_base"


@register("J01_transcripts_to_genes", f"SELECT sample, tx, gene FROM ({MAPPED}) AS m", "v_quant v_tx2gene")
def transcripts(spark, d):
    mapped = bulk.to_genes(view(spark, d, "v_quant"), view(spark, d, "v_tx2gene"))
    return mapped.select("sample", "tx", "gene")


@register(
    "A05_gene_summary",
    f"SELECT sample, gene, CAST(SUM(n) AS BIGINT) AS n, round(SUM(tpm), 6) AS tpm, round(SUM(tpm * len) / SUM(tpm), 6) AS len FROM ({MAPPED}) AS m GROUP BY sample, gene",
    "v_quant v_tx2gene",
)
def gene_summary(spark, d):
    return rounded(bulk.gene_summary(view(spark, d, "v_quant"), view(spark, d, "v_tx2gene")))


@register("P22_nonzero_length", "SELECT sample, gene, CASE WHEN len % 300 = 0 THEN 1 ELSE len END AS len FROM v_bulk", "v_bulk")
def nonzero_length(spark, d):
    emptied = _bulk(spark, d).select("sample", "gene", F.when(F.col("len") % 300 == 0, 0).otherwise(F.col("len")).alias("len"))
    return bulk.nonzero_length(emptied)


@register("A06_size_factors", f", {FACTORS} SELECT sample, round(size_factor, 6) AS size_factor FROM sf", "v_bulk")
def size_factors(spark, d):
    return rounded(bulk.size_factors(_bulk(spark, d)))


@register("A07_top_by_mean", f", {FACTORS} SELECT gene, round(SUM(q) / {S}, 5) AS mean FROM nq GROUP BY gene ORDER BY round(SUM(q) / {S}, 6) DESC, gene LIMIT 20", "v_bulk")
def top_by_mean(spark, d):
    return rounded(bulk.top_by_mean(_normal(spark, d)), 5)


LOGS = f"{FACTORS}, lg AS (SELECT sample, gene, log2(q + 1) AS x FROM nq)"


@register("F04_log_counts", f", {LOGS} SELECT sample, gene, round(x, 6) AS x FROM lg", "v_bulk")
def log_counts(spark, d):
    return rounded(bulk.log_counts(_normal(spark, d)))


@register(
    "A09_mean_sd",
    f""", {LOGS}, m AS (SELECT gene, SUM(x) / {S} AS mean, sqrt(greatest((SUM(x * x) - SUM(x) * SUM(x) / {S}) / ({S} - 1), 0)) AS sd, round(SUM(x) / {S}, 9) AS k FROM lg GROUP BY gene)
SELECT gene, round(mean, 6) AS mean, round(sd, 5) AS sd, CAST(rank() OVER (ORDER BY k) + (COUNT(*) OVER (PARTITION BY k) - 1) / 2.0 AS DOUBLE) AS rank FROM m""",
    "v_bulk",
)
def mean_sd(spark, d):
    table = bulk.mean_sd(bulk.log_counts(_normal(spark, d)))
    return table.select("gene", F.round("mean", 6).alias("mean"), (F.round("sd", 5) + 0.0).alias("sd"), "rank")


@register(
    "J10_sample_distances",
    f""", {LOGS}, s AS (SELECT DISTINCT sample FROM v_bulk), g AS (SELECT DISTINCT gene FROM v_bulk), f AS (SELECT s.sample, g.gene, COALESCE(x, 0) AS x FROM s CROSS JOIN g LEFT JOIN lg ON lg.sample = s.sample AND lg.gene = g.gene)
SELECT a.sample AS a, b.sample AS b, round(sqrt(SUM((a.x - b.x) * (a.x - b.x))), 5) AS distance FROM f a JOIN f b ON a.gene = b.gene AND a.sample < b.sample GROUP BY a.sample, b.sample""",
    "v_bulk",
)
def distances(spark, d):
    return rounded(bulk.sample_distances(bulk.log_counts(_normal(spark, d))), 5)


@register("J14_sample_sheet", "SELECT sample, gene, n, condition FROM v_bulk", "v_bulk")
def sample_sheet(spark, d):
    b = _bulk(spark, d)
    sheet = b.select("sample", "condition").distinct()
    return bulk.with_condition(b.select("sample", "gene", "n"), sheet)


BH = """bh AS (SELECT gene, lfc, p, CASE WHEN p IS NOT NULL THEN least(1.0, MIN(p * m / rk) OVER (ORDER BY p DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS padj
 FROM (SELECT *, rank() OVER (ORDER BY p NULLS LAST) + COUNT(*) OVER (PARTITION BY p) - 1 AS rk, COUNT(p) OVER () AS m FROM v_de) AS r)"""


def _adjusted(spark, d):
    return bulk.adjusted_p(view(spark, d, "v_de"))


@register("W01_adjusted_p", f", {BH} SELECT gene, p, round(padj, 6) AS padj FROM bh", "v_de")
def adjusted(spark, d):
    return _adjusted(spark, d).select("gene", "p", F.round("padj", 6).alias("padj"))


@register(
    "A08_significance_summary",
    f""", {BH} SELECT COUNT(CASE WHEN padj < 0.1 THEN 1 END) AS significant, COUNT(CASE WHEN padj < 0.1 AND lfc > 0 THEN 1 END) AS up,
 COUNT(CASE WHEN padj < 0.1 AND lfc < 0 THEN 1 END) AS down, COUNT(CASE WHEN padj IS NULL THEN 1 END) AS missing FROM bh""",
    "v_de",
)
def summary(spark, d):
    return bulk.significance_summary(_adjusted(spark, d))


@register(
    "F01_rank_metric",
    """SELECT gene, round(CASE WHEN lfc = 0 THEN CASE WHEN p < 1 THEN CAST('Infinity' AS DOUBLE) END ELSE -log10(p) / sign(lfc) END, 6) + 0.0 AS metric
FROM v_de WHERE p IS NOT NULL AND NOT (lfc = 0 AND p = 1)""",
    "v_de",
)
def rank_metric(spark, d):
    return rounded(bulk.rank_metric(view(spark, d, "v_de")))


@register("T01_ordered_by_p", "SELECT gene, lfc, p FROM v_de", "v_de")
def ordered(spark, d):
    return bulk.ordered_by_p(view(spark, d, "v_de")).select("gene", "lfc", "p")


@register(
    "T04_best_gene_counts",
    f", {BH}, {FACTORS} SELECT gene, sample, round(q + 0.5, 6) AS count FROM nq WHERE gene = (SELECT gene FROM bh WHERE padj IS NOT NULL ORDER BY padj, gene LIMIT 1)",
    "v_bulk v_de",
)
def best_gene(spark, d):
    return rounded(bulk.best_gene_counts(_adjusted(spark, d), _normal(spark, d)))


@register(
    "G06_gene_moments",
    f""", {FACTORS}, mm AS (SELECT gene, SUM(q) / {S} AS m, (SUM(q * q) - SUM(q) * SUM(q) / {S}) / ({S} - 1) AS v FROM nq GROUP BY gene)
SELECT gene, round(m, 4) AS base_mean, round(v, 3) AS base_var, round(greatest((v - (SELECT AVG(1 / size_factor) FROM sf) * m) / (m * m), 1e-8), 5) AS disp_gene FROM mm""",
    "v_bulk",
)
def moments(spark, d):
    rows = contrast.gene_moments(_normal(spark, d))
    return rows.select(
        "gene", F.round("base_mean", 4).alias("base_mean"), F.round("base_var", 3).alias("base_var"), F.round("disp_gene", 5).alias("disp_gene")
    )


def _fit(spark, d):
    return contrast.fit_contrast(_bulk(spark, d).select("sample", "condition", "gene", "n"))


@register("G06_fitted_contrast")
def fitted(spark, d):
    return _fit(spark, d).drop("cooks", "used")


@register(
    "G06_score_equations",
    "SELECT gene, g, TRUE AS zero, TRUE AS converged FROM (SELECT gene FROM v_bulk GROUP BY gene HAVING SUM(n) > 0) AS t, (SELECT unnest([0, 1]) AS g) AS s",
    "v_bulk",
)
def score_equations(spark, d):
    """The fit solves its equations: the derivative by both group means is zero for every gene."""
    bulk_rows = _bulk(spark, d).select("sample", "condition", "gene", "n")
    fitted = _fit(spark, d)
    scores = contrast.score_equations(fitted, bulk_rows)
    return scores.join(fitted.select("gene", "converged"), "gene").select(
        "gene", "g", (F.abs("score") < 1e-3).alias("zero"), "converged"
    )


@register("G06_rejection_cuts")
def rejection_cuts(spark, d):
    """Rejections by the step-up rule for every cut of low means."""
    return contrast.rejection_cut(_fit(spark, d))


@register("G06_shrunken_changes")
def shrunken(spark, d):
    return contrast.shrunken_changes(_fit(spark, d))


@register("G07_outlier_measures")
def outliers(spark, d):
    return contrast.outlier_measures(_fit(spark, d))


@register("G07_dispersion_table")
def dispersions(spark, d):
    return contrast.dispersion_table(_fit(spark, d))


@register("F05_stabilised_counts")
def stabilised(spark, d):
    return bulk.stabilised_counts(_normal(spark, d), *contrast.trend_of(_bulk(spark, d)))


@register(
    "F05_stabilised_fixed_trend",
    f", {FACTORS} SELECT sample, gene, round(log2((1 + 2.0 + 2 * 0.1 * q + 2 * sqrt(0.1 * q * (1 + 2.0 + 0.1 * q))) / (4 * 0.1)), 6) AS x FROM nq",
    "v_bulk",
)
def stabilised_fixed(spark, d):
    return rounded(bulk.stabilised_counts(_normal(spark, d), F.lit(0.1), F.lit(2.0)))


@register(
    "S04_unique_names",
    "SELECT gene, CASE WHEN k = 0 THEN symbol ELSE concat(symbol, '-', CAST(k AS STRING)) END AS unique_name FROM (SELECT gene, symbol, row_number() OVER (PARTITION BY symbol ORDER BY gene) - 1 AS k FROM v_genes) AS r",
    "v_genes",
)
def unique_names(spark, d):
    return genes.unique_names(view(spark, d, "v_genes")).select("gene", "unique_name")


@register("J06_mapped_genes", "SELECT DISTINCT g.symbol, p.p_brand AS other FROM v_genes g JOIN part p ON g.symbol = p.p_name", "v_genes")
def mapped_genes(spark, d):
    every = view(spark, d, "v_genes")
    ids = every.select("gene")
    other = table(spark, d, "part").select(F.col("p_name").alias("symbol"), F.col("p_brand").alias("other"))
    return genes.map_genes(ids, every.select("gene", "symbol"), other)


@register("U02_distinct_pairs", "SELECT DISTINCT p_name AS symbol, p_brand AS other FROM part")
def distinct_pairs(spark, d):
    return table(spark, d, "part").select(F.col("p_name").alias("symbol"), F.col("p_brand").alias("other")).distinct()


FLAGS = ["s1", "s2", "s3", "s4", "s5"]


@register("P11_presence", "SELECT id, " + ", ".join(f"{c}" for c in FLAGS) + " FROM v_sets", "v_sets")
def presence(spark, d):
    raw = view(spark, d, "v_sets").select("id", *[F.when(F.col(c) == 1, F.lit(7.5)).alias(c) for c in FLAGS])
    return sets.presence(raw, FLAGS)


@register("A16_exclusive_intersections", f"SELECT {', '.join(FLAGS)}, COUNT(*) AS n FROM v_sets GROUP BY {', '.join(FLAGS)}", "v_sets")
def intersections(spark, d):
    return sets.exclusive_intersections(view(spark, d, "v_sets"), FLAGS)


@register(
    "A17_set_sizes",
    "SELECT set_name, size, round(log2(size), 6) AS log2_size, round(log10(size), 6) AS log10_size FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS set_name, CAST(SUM({c}) AS BIGINT) AS size FROM v_sets" for c in FLAGS)
    + ") AS s",
    "v_sets",
)
def set_sizes(spark, d):
    return rounded(sets.set_sizes(view(spark, d, "v_sets"), FLAGS))


@register("U03_common_and_only", "SELECT 'common' AS part, id FROM v_sets WHERE s1 = 1 AND s2 = 1 UNION ALL SELECT 'only', id FROM v_sets WHERE s1 = 1 AND s2 = 0", "v_sets")
def common_and_only(spark, d):
    flags = view(spark, d, "v_sets")
    common = sets.common_members(flags, "s1", "s2").select(F.lit("common").alias("part"), "id")
    return common.unionByName(sets.only_members(flags, "s1", "s2").select(F.lit("only").alias("part"), "id"))


PATTERNS = [("1-URGENT", True), ("2-HIGH", True), ("3-MEDIUM", True), ("4-NOT SPECIFIED", False), ("5-LOW", False)]


@register("J13_retention_tags", "SELECT c_custkey AS id, suffix, substr(suffix, 1, 1) < '4' AS archive FROM customer JOIN v_listing ON c_custkey = id", "v_listing")
def tags(spark, d):
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return manifest.retention_tags(people, view(spark, d, "v_listing"), PATTERNS)


@register("U04_included", "SELECT id, suffix FROM v_listing WHERE suffix LIKE '4-%'", "v_listing")
def included(spark, d):
    return manifest.included(view(spark, d, "v_listing"), "4-", "suffix")


@register("P25_groomed_names", "SELECT c_custkey, lower(c_name) AS name, concat('run', CAST(c_nationkey AS STRING), '/', lower(c_name), '.hg19.g.vcf.gz') AS path FROM customer")
def groomed(spark, d):
    from ..functions.text import groomed_name

    people = table(spark, d, "customer")
    raw = people.select(
        "c_custkey", "c_nationkey", F.concat(F.lit("S3://Bucket/In/"), F.col("c_name"), F.lit(".hg19.G.VCF.gz")).alias("raw")
    )
    name = groomed_name(F.col("raw"), ".hg19.g.vcf")
    return raw.select(
        "c_custkey", name.alias("name"),
        F.concat(F.lit("run"), F.col("c_nationkey").cast("string"), F.lit("/"), name, F.lit(".hg19.g.vcf.gz")).alias("path"),
    )


@register("P26_repeat_ids", "SELECT p_partkey, concat('ID', CAST(p_size AS STRING)) AS varid FROM part WHERE p_partkey % 3 <> 0")
def repeat_ids(spark, d):
    from ..functions.text import tag_value

    parts = table(spark, d, "part")
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("ID_"), F.col("p_size"))).otherwise(F.concat(F.lit("ID"), F.col("p_size")))
    info = F.concat(F.lit("END=9;REF=3;RL=2;RU=CAG;VARID="), name, F.lit(";REPID=x"))
    return parts.select("p_partkey", tag_value(info, "VARID").alias("varid")).where(~F.col("varid").contains("_"))


@register(
    "J13_sample_files",
    "SELECT s_name, COUNT(*) AS n, CAST(SUM(CASE WHEN a THEN 1 ELSE 0 END) AS BIGINT) AS archived FROM supplier, (SELECT unnest([true, true, true, true, true, true, false, false, false, true]) AS a) AS f GROUP BY s_name",
)
def sample_files(spark, d):
    people = table(spark, d, "supplier").select("s_name", F.lit("C1").alias("cohort"), F.col("s_nationkey").cast("string").alias("run"))
    files = manifest.per_sample_files(people, "cohort", "run", "s_name")
    return files.groupBy("s_name").agg(F.count("path").alias("n"), F.count_if("archive").alias("archived"))


@register("G01_sample_components")
def sample_components(spark, d):
    from ..operators import cells, reduce
    from ..shared import materialised

    x = materialised(bulk.log_counts(_normal(spark, d)), "logs")
    chosen = cells.top_genes(bulk.mean_sd(x), "sd", 500).select("gene")
    names = [r["gene"] for r in chosen.orderBy("gene").collect()]  # 500 rows
    vectors = reduce.feature_vectors(x, names, "sample", "gene", "x").withColumnRenamed("sample", "id")
    scores, _, _ = reduce.principal_components(vectors, 2)
    return rounded(scores.select("id", F.get("pcs", F.lit(0)).alias("pc1"), F.get("pcs", F.lit(1)).alias("pc2")))
