"""Queries over vectors, graphs, splicing and model output."""

from pyspark.sql import functions as F

from ..functions.arrays import argmax, one_hot
from ..functions.missing import fill_zero
from ..functions.text import has_unknown_base
from ..operators import classify, evaluate, graph, neighbors, reduce, splicing
from .base import register, rounded, table, view

REPORT = """
cls AS (SELECT * FROM (VALUES (0, 'Benign'), (1, 'Dominant'), (2, 'Recessive')) AS c(k, label)),
src AS (SELECT 'all' AS slice, y, yhat FROM v_pred UNION ALL SELECT var_type, y, yhat FROM v_pred),
per AS (SELECT slice, label, CAST(SUM(CASE WHEN y = k AND yhat = k THEN 1 ELSE 0 END) AS DOUBLE) AS tp, CAST(SUM(CASE WHEN y = k THEN 1 ELSE 0 END) AS DOUBLE) AS tr,
 CAST(SUM(CASE WHEN yhat = k THEN 1 ELSE 0 END) AS DOUBLE) AS sd FROM src CROSS JOIN cls GROUP BY slice, label),
prf AS (SELECT slice, label, tp, tr, COALESCE(tp / NULLIF(sd, 0), 0) AS p, COALESCE(tp / NULLIF(tr, 0), 0) AS r FROM per),
f AS (SELECT *, COALESCE(2 * p * r / NULLIF(p + r, 0), 0) AS f1 FROM prf),
rep AS (SELECT slice, label, p AS precision, r AS recall, f1, CAST(tr AS BIGINT) AS support FROM f
 UNION ALL SELECT slice, 'accuracy', SUM(tp) / SUM(tr), SUM(tp) / SUM(tr), SUM(tp) / SUM(tr), CAST(SUM(tr) AS BIGINT) FROM f GROUP BY slice
 UNION ALL SELECT slice, 'macro avg', AVG(p), AVG(r), AVG(f1), CAST(SUM(tr) AS BIGINT) FROM f GROUP BY slice
 UNION ALL SELECT slice, 'weighted avg', SUM(p * tr) / SUM(tr), SUM(r * tr) / SUM(tr), SUM(f1 * tr) / SUM(tr), CAST(SUM(tr) AS BIGINT) FROM f GROUP BY slice)"""


@register("A22_classification_report", f", {REPORT} SELECT slice, label, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1, support FROM rep", "v_pred")
def report(spark, d):
    return rounded(evaluate.classification_report(view(spark, d, "v_pred")), 3)


@register(
    "A22_binary_report",
    f", {REPORT.replace('v_pred', 'b_pred').replace(', (2, ' + repr('Recessive') + ')', '').replace('Dominant', 'Pathogenic')}  SELECT slice, label, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1, support FROM rep WHERE slice = 'all'".replace(
        "\ncls AS", "\nb_pred AS (SELECT var_type, CASE WHEN y > 0 THEN 1 ELSE 0 END AS y, CASE WHEN yhat > 0 THEN 1 ELSE 0 END AS yhat FROM v_pred), cls AS"
    ),
    "v_pred",
)
def binary_report(spark, d):
    pred = view(spark, d, "v_pred").select((F.col("y") > 0).cast("int").alias("y"), (F.col("yhat") > 0).cast("int").alias("yhat"))
    return rounded(evaluate.classification_report(pred, evaluate.BINARY_NAMES, None), 3)


def _probs(spark, d):
    pred = view(spark, d, "v_pred")
    p = F.array(*[F.when(F.col("yhat") == i, 0.6).otherwise(0.2) for i in range(3)])
    return pred.withColumn("p", p)


@register(
    "A23_loss_and_accuracy",
    "SELECT round(AVG(-ln(CASE WHEN y = yhat THEN 0.6 ELSE 0.2 END)), 6) AS loss, round(AVG(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END), 6) AS accuracy, COUNT(*) AS n FROM v_pred",
    "v_pred",
)
def loss(spark, d):
    return rounded(evaluate.loss_and_accuracy(_probs(spark, d)))


@register("T06_argmax_class", "SELECT l_orderkey, l_linenumber, CASE WHEN l_tax >= l_discount AND l_tax >= 0.05 THEN 0 WHEN l_discount >= 0.05 THEN 1 ELSE 2 END AS best FROM lineitem")
def argmax_class(spark, d):
    p = F.array("l_tax", "l_discount", F.lit(0.05))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", argmax(p).alias("best"))


@register("F09_one_hot", "SELECT var_type, y, concat(CASE WHEN y = 0 THEN '1' ELSE '0' END, CASE WHEN y = 1 THEN '1' ELSE '0' END, CASE WHEN y = 2 THEN '1' ELSE '0' END) AS code, COUNT(*) AS n FROM v_pred GROUP BY ALL", "v_pred")
def one_hot_code(spark, d):
    coded = view(spark, d, "v_pred").select(
        "var_type", "y", F.array_join(one_hot(F.col("y"), 3).cast("array<string>"), "").alias("code")
    )
    return coded.groupBy("var_type", "y", "code").agg(F.count(F.lit(1)).alias("n"))


@register("P12_without_unknown_bases", "SELECT doc_id FROM documents WHERE NOT contains(text, 'N') AND NOT contains(upper(lang), 'N')")
def known_bases(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("wt"), F.upper("lang").alias("alt"))
    return docs.where(~has_unknown_base("wt", "alt")).select("doc_id")


@register("G13_batches", "SELECT doc_id AS id, position, CAST(floor(position / 64) AS BIGINT) AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) AS r")
def batches(spark, d):
    return evaluate.batches(table(spark, d, "documents").select(F.col("doc_id").alias("id")))


@register("G13_shuffled_batch_sizes", "SELECT CAST(floor(position / 64) AS BIGINT) AS batch, COUNT(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) AS r GROUP BY 1")
def shuffled(spark, d):
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return evaluate.batches(ids, epoch=3).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


POSITIONS, WIDTH = 8, 8


def _variant_vectors(spark, d):
    """Embeddings as positions x features per variant and allele."""
    rows = table(spark, d, "embeddings").select(
        F.floor(F.col("vec_id") / 2).alias("var_id"),
        F.when(F.col("vec_id") % 2 == 0, "WT").otherwise("Alt").alias("allele"),
        "label",
        F.posexplode(
            F.transform(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: F.slice("embedding", i * WIDTH + 1, F.lit(WIDTH)))
        ).alias("position", "v"),
    )
    return rows


def _pooled(spark, d, k=4):
    return evaluate.pooled_features(evaluate.paired_features(_variant_vectors(spark, d), k), 2 * k)


PAIRS = """pos AS (SELECT unnest(range(8)) AS position), feat AS (SELECT unnest(range(4)) AS f),
al AS (SELECT vec_id // 2 AS var_id, vec_id % 2 AS a, CAST(position AS INT) AS position, CAST(f + 4 * (vec_id % 2) AS INT) AS feature, CAST(embedding[position * 8 + f + 1] AS DOUBLE) AS x
 FROM embeddings, pos, feat), pr AS (SELECT var_id FROM embeddings, (SELECT 1) AS o(one) , (SELECT vec_id // 2 AS var_id FROM embeddings GROUP BY 1 HAVING COUNT(*) = 2) AS p WHERE vec_id // 2 = p.var_id GROUP BY var_id)"""


@register(
    "J11_paired_features",
    f"WITH {PAIRS.replace('SELECT var_id FROM embeddings', 'SELECT p.var_id AS var_id FROM embeddings').replace('GROUP BY var_id)', 'GROUP BY p.var_id)')} SELECT al.var_id, position, feature, round(x, 6) AS x FROM al JOIN pr ON al.var_id = pr.var_id",
)
def paired_features(spark, d):
    rows = evaluate.paired_features(_variant_vectors(spark, d), 4)
    return rounded(
        rows.select("var_id", "position", F.posexplode("v").alias("feature", "x")).withColumn("x", F.col("x").cast("double"))
    )


POOLED_SQL = """SELECT var_id, feature, round(MAX(x), 6) AS x FROM (
 SELECT vec_id // 2 AS var_id, CAST(f + 4 * (vec_id % 2) AS INT) AS feature, CAST(embedding[position * 8 + f + 1] AS DOUBLE) AS x
 FROM embeddings, (SELECT unnest(range(8)) AS position) AS p, (SELECT unnest(range(4)) AS f) AS q) AS a
 WHERE var_id IN (SELECT vec_id // 2 FROM embeddings GROUP BY 1 HAVING COUNT(*) = 2) GROUP BY var_id, feature"""


@register("A35_pooled_features", POOLED_SQL)
def pooled(spark, d):
    rows = _pooled(spark, d).select("var_id", F.posexplode("pooled").alias("feature", "x"))
    return rounded(rows.withColumn("x", F.col("x").cast("double")))


@register("S14_arrays_by_key", "SELECT vec_id // 2 AS var_id, CASE WHEN vec_id % 2 = 0 THEN 'WT' ELSE 'Alt' END AS allele, CAST(len(embedding) AS BIGINT) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings")
def arrays_by_key(spark, d):
    from ..shared import materialised

    stored = materialised(_variant_vectors(spark, d).drop("label"), "arrays")
    sizes = stored.groupBy("var_id", "allele").agg(
        F.sum(F.size("v")).cast("bigint").alias("n"),
        F.max(F.when(F.col("position") == 0, F.get("v", F.lit(0)))).cast("double").alias("first"),
    )
    return rounded(sizes)


def _classes(spark, d):
    labels = _variant_vectors(spark, d).where("allele = 'WT' AND position = 0").select("var_id", (F.col("label") % 3).alias("y"))
    joined = _pooled(spark, d).join(labels, "var_id").withColumn("af", (F.col("var_id") % 100) / F.lit(100.0))
    ready = classify.with_vector(fill_zero(joined), "pooled", ["af"])
    held = F.pmod(F.xxhash64("var_id"), F.lit(5)) == 0
    return ready.where(~held), ready.where(held)


@register("G12_class_predictions")
def predictions(spark, d):
    train, validation = _classes(spark, d)
    model = classify.best_model(train, validation)
    return classify.predictions(model, validation).select("var_id", "y", "yhat", F.get("p", F.lit(0)).alias("p_benign"))


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )


def _pca(spark, d, k=5):
    return reduce.principal_components(_vectors(spark, d), k)


@register("G01_component_scores")
def scores(spark, d):
    return rounded(_pca(spark, d)[0].select("id", *[F.get("pcs", F.lit(i)).alias(f"pc{i + 1}") for i in range(5)]))


@register(
    "G01_score_variance",
    """WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(64)) AS f FROM embeddings),
m AS (SELECT f, AVG(x) AS mu FROM e GROUP BY f) SELECT round(SUM(pow(x - mu, 2)) / ((SELECT COUNT(*) FROM embeddings) - 1), 5) AS total FROM e JOIN m ON e.f = m.f""",
)
def score_variance(spark, d):
    all_scores, _, _ = _pca(spark, d, 64)
    var = all_scores.select("id", F.posexplode("pcs").alias("c", "s")).groupBy("c").agg(F.var_samp("s").alias("v"))
    return rounded(var.agg(F.sum("v").alias("total")), 5)


@register("W12_strongest_loadings")
def loadings(spark, d):
    return rounded(reduce.strongest_loadings(_pca(spark, d)[1]))


@register("W12_extreme_rows")
def extremes(spark, d):
    return rounded(reduce.extreme_rows(_pca(spark, d)[0], 1, 10))


KNN = """em AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, CAST(label AS INT) AS label FROM embeddings),
dd AS (SELECT a.id AS src, b.id AS dst, list_distance(a.v, b.v) AS distance FROM em a JOIN em b ON a.id <> b.id),
nn AS (SELECT src, dst, distance, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS place FROM dd QUALIFY place <= 10)"""


@register("G03_nearest_neighbors", f"WITH {KNN} SELECT src, dst, round(distance, 6) AS distance, CAST(place AS INT) AS place FROM nn")
def knn(spark, d):
    return rounded(neighbors.nearest_neighbors(_vectors(spark, d), 10))


@register(
    "G04_shared_neighbors",
    f"""WITH {KNN}, ls AS (SELECT src, dst AS token FROM nn UNION ALL SELECT DISTINCT src, src FROM nn),
ov AS (SELECT a.src AS src, b.src AS dst, COUNT(*) AS c FROM ls a JOIN ls b ON a.token = b.token AND a.src < b.src GROUP BY a.src, b.src)
SELECT src, dst, round(c / (22.0 - c), 6) AS w FROM ov WHERE c / (22.0 - c) >= 1 / 15.0""",
)
def snn(spark, d):
    near = neighbors.nearest_neighbors(_vectors(spark, d), 10)
    return rounded(neighbors.shared_neighbor_weights(near, 10))


@register(
    "G09_group_connectivity",
    f"""WITH {KNN}, pl AS (SELECT a.label AS c1, b.label AS c2, COUNT(*) AS e FROM nn JOIN em a ON nn.src = a.id JOIN em b ON nn.dst = b.id GROUP BY a.label, b.label),
sz AS (SELECT label, COUNT(*) AS n FROM em GROUP BY label), es AS (SELECT c1, SUM(e) AS es FROM pl GROUP BY c1),
cr AS (SELECT least(c1, c2) AS a, greatest(c1, c2) AS b, CAST(SUM(e) AS BIGINT) AS inter FROM pl WHERE c1 <> c2 GROUP BY 1, 2)
SELECT a, b, inter, round(least(1.0, inter / ((e1.es * s2.n + e2.es * s1.n) / ((SELECT COUNT(*) FROM em) - 1.0))), 6) AS connectivity
FROM cr JOIN sz s1 ON a = s1.label JOIN sz s2 ON b = s2.label JOIN es e1 ON a = e1.c1 JOIN es e2 ON b = e2.c1""",
)
def connectivity(spark, d):
    near = neighbors.nearest_neighbors(_vectors(spark, d), 10).select("src", "dst")
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("node"), F.col("label").alias("community"))
    return rounded(graph.group_connectivity(near, labels))


@register("G05_communities")
def communities(spark, d):
    near = neighbors.nearest_neighbors(_vectors(spark, d), 10)
    from ..shared import materialised

    return graph.communities(materialised(near.select("src", "dst"), "edges"), 0.5)


@register(
    "G02_connected_components",
    """WITH RECURSIVE e AS (SELECT c_custkey AS u, c_custkey - c_custkey % 5 AS v FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT o_custkey, -1 - o_orderkey FROM orders),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), r AS (SELECT u AS node, u AS root FROM b UNION SELECT b.v, r.root FROM r JOIN b ON r.node = b.u)
SELECT node, MIN(root) AS component FROM r GROUP BY node""",
)
def components(spark, d):
    people = table(spark, d, "customer").select(
        F.col("c_custkey").alias("src"), (F.col("c_custkey") - F.col("c_custkey") % 5).alias("dst")
    )
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), (-1 - F.col("o_orderkey")).alias("dst"))
    return graph.connected_components(people.where(F.col("src") != F.col("dst")).unionByName(orders))


CLUSTERS = """intr AS (SELECT chrom, j_start, j_end, concat(chrom, ':', CAST(j_start AS STRING), ':', CAST(j_end AS STRING)) AS intron, CAST(SUM(n) AS BIGINT) AS reads FROM v_junctions WHERE j_end - j_start <= 500000 GROUP BY chrom, j_start, j_end),
cl AS (SELECT *, MIN(intron) OVER (PARTITION BY chrom, j_start) AS cluster, SUM(reads) OVER (PARTITION BY chrom, j_start) AS total FROM intr)"""
USAGE = f"""{CLUSTERS}, rw AS (SELECT j.sample, cl.cluster, cl.intron, j.n FROM v_junctions j JOIN cl ON j.chrom = cl.chrom AND j.j_start = cl.j_start AND j.j_end = cl.j_end WHERE cl.total >= 1500),
kp AS (SELECT * FROM rw WHERE intron IN (SELECT intron FROM rw GROUP BY intron HAVING COUNT(DISTINCT sample) >= 3)),
us AS (SELECT sample, cluster, intron, n, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY sample, cluster) AS usage FROM kp)"""


def _clusters(spark, d, reads=1500):
    junctions = splicing.short_introns(view(spark, d, "v_junctions"))
    return junctions, splicing.junction_clusters(junctions, reads)


def _usage(spark, d):
    return splicing.intron_usage(*_clusters(spark, d))


@register("A28_junction_clusters", f", {CLUSTERS} SELECT intron, cluster, reads FROM cl WHERE total >= 50", "v_junctions")
def junction_clusters(spark, d):
    return _clusters(spark, d, 50)[1].select("intron", "cluster", "reads")


@register("A28_intron_usage", f", {USAGE} SELECT sample, cluster, intron, n, round(usage, 6) AS usage FROM us", "v_junctions")
def intron_usage(spark, d):
    return rounded(_usage(spark, d))


@register(
    "A29_outlier_introns",
    f", {USAGE} SELECT sample, cluster, intron, round(usage - (SUM(usage) OVER (PARTITION BY intron) - usage) / (COUNT(*) OVER (PARTITION BY intron) - 1), 6) + 0.0 AS effect FROM us",
    "v_junctions",
)
def outlier_introns(spark, d):
    return rounded(splicing.outlier_introns(_usage(spark, d)))


def _sheet(spark, d):
    return view(spark, d, "v_bulk").select("sample", "condition").distinct()


PL = f"""{USAGE}, pl AS (SELECT cluster, intron, CASE WHEN sample < 3 THEN 'control' ELSE 'patient' END AS condition, CAST(SUM(n) AS DOUBLE) AS n FROM us GROUP BY 1, 2, 3),
full_grid AS (SELECT i.cluster, i.intron, c.condition, COALESCE(pl.n, 0) AS n FROM (SELECT DISTINCT cluster, intron FROM pl) i JOIN (SELECT DISTINCT cluster, condition FROM pl) c ON i.cluster = c.cluster LEFT JOIN pl ON pl.cluster = i.cluster AND pl.intron = i.intron AND pl.condition = c.condition),
ex AS (SELECT cluster, intron, condition, n, SUM(n) OVER (PARTITION BY cluster, intron) * SUM(n) OVER (PARTITION BY cluster, condition) / SUM(n) OVER (PARTITION BY cluster) AS e FROM full_grid)"""


@register(
    "A29_cluster_differences",
    f", {PL} SELECT cluster, round(SUM((n - e) * (n - e) / e), 4) AS chi2, (COUNT(DISTINCT intron) - 1) * (COUNT(DISTINCT condition) - 1) AS df FROM ex GROUP BY cluster",
    "v_junctions",
)
def cluster_differences(spark, d):
    return rounded(splicing.cluster_differences(_usage(spark, d), _sheet(spark, d), with_p=False), 4)


@register(
    "A29_cluster_p",
    f""", {PL}, st AS (SELECT cluster, SUM((n - e) * (n - e) / e) AS chi2, (COUNT(DISTINCT intron) - 1) * (COUNT(DISTINCT condition) - 1) AS df FROM ex GROUP BY cluster)
SELECT cluster, df, round(exp(-chi2 / 2) * list_sum(list_transform(range(df // 2), lambda i: pow(chi2 / 2, i) / factorial(CAST(i AS INT)))), 6) + 0.0 AS p FROM st WHERE df % 2 = 0
UNION ALL SELECT cluster, df, CASE WHEN df = 0 THEN NULL WHEN chi2 <= 1e-9 THEN 1.0 ELSE round(1 - list_sum(list_transform(range(0, CAST(ceil(chi2 / 2 + 40 * sqrt(chi2) + 100) AS BIGINT)),
 lambda k: exp((df / 2.0 + k) * ln(chi2 / 2) - chi2 / 2 - lgamma(df / 2.0 + k + 1)))), 6) + 0.0 END AS p FROM st WHERE df % 2 = 1""",
    "v_junctions",
)
def cluster_p(spark, d):
    tests = splicing.cluster_differences(_usage(spark, d), _sheet(spark, d))
    return rounded(tests.select("cluster", "df", "p"))


@register("J15_joined_splice_results", f", {PL}, st AS (SELECT cluster, SUM((n - e) * (n - e) / e) AS chi2, (COUNT(DISTINCT intron) - 1) * (COUNT(DISTINCT condition) - 1) AS df FROM ex GROUP BY cluster), ef AS (SELECT sample, cluster, intron, usage - (SUM(usage) OVER (PARTITION BY intron) - usage) / (COUNT(*) OVER (PARTITION BY intron) - 1) AS effect FROM us) SELECT sample, ef.cluster, intron, round(effect, 6) + 0.0 AS effect, concat('gene_', split_part(ef.cluster, ':', 1)) AS gene, df, round(chi2, 4) + 0.0 AS chi2 FROM ef JOIN st ON ef.cluster = st.cluster", "v_junctions")
def joined_results(spark, d):
    usage = _usage(spark, d)
    tests = splicing.cluster_differences(usage, _sheet(spark, d))
    genes = usage.select("cluster").distinct().withColumn("gene", F.concat(F.lit("gene_"), F.split("cluster", ":")[0]))
    joined = splicing.joined_splice_results(tests, splicing.outlier_introns(usage), genes)
    return rounded(joined.select("sample", "cluster", "intron", "effect", "gene", "df", F.round("chi2", 4).alias("chi2")))


@register(
    "J15_annotated_events",
    "SELECT event, sample, inc, skip, p_brand AS gene, 'SE' AS event_type FROM v_events JOIN part ON event = p_partkey",
    "v_events",
)
def annotated_events(spark, d):
    notes = table(spark, d, "part").select(F.col("p_partkey").alias("event"), F.col("p_brand").alias("gene"))
    return splicing.annotated_events(view(spark, d, "v_events").drop("condition"), notes, "SE")


PSI = "CAST(inc AS DOUBLE) / 2.0 / NULLIF(CAST(inc AS DOUBLE) / 2.0 + skip, 0)"
LL = "(CASE WHEN {k} > 0 THEN {k} * ln({k} / {n}) ELSE 0 END + CASE WHEN {n} > {k} THEN ({n} - {k}) * ln(1 - {k} / {n}) ELSE 0 END)"


@register("A30_inclusion_levels", f"SELECT event, sample, round({PSI}, 6) AS psi FROM v_events", "v_events")
def inclusion(spark, d):
    return rounded(splicing.inclusion_levels(view(spark, d, "v_events")).select("event", "sample", "psi"))


@register(
    "A30_inclusion_differences",
    f""", s AS (SELECT event, AVG(CASE WHEN condition = 'control' THEN {PSI} END) AS a, AVG(CASE WHEN condition = 'patient' THEN {PSI} END) AS b,
 CAST(SUM(CASE WHEN condition = 'control' THEN inc ELSE 0 END) AS DOUBLE) AS i0, CAST(SUM(CASE WHEN condition = 'control' THEN inc + skip ELSE 0 END) AS DOUBLE) AS n0,
 CAST(SUM(CASE WHEN condition = 'patient' THEN inc ELSE 0 END) AS DOUBLE) AS i1, CAST(SUM(CASE WHEN condition = 'patient' THEN inc + skip ELSE 0 END) AS DOUBLE) AS n1 FROM v_events GROUP BY event)
SELECT event, round(a, 6) AS psi_ref, round(b, 6) AS psi_other, round(b - a, 6) + 0.0 AS delta, COALESCE(abs(b - a) > 0.05, false) AS called,
 round(greatest(2 * ({LL.format(k='i0', n='n0')} + {LL.format(k='i1', n='n1')} - {LL.format(k='(i0 + i1)', n='(n0 + n1)')}), 0), 5) + 0.0 AS lr FROM s""",
    "v_events",
)
def inclusion_differences(spark, d):
    rows = splicing.inclusion_differences(view(spark, d, "v_events"), with_p=False)
    return rounded(rows.withColumn("lr", F.round("lr", 5)))


@register("A30_inclusion_p")
def inclusion_p(spark, d):
    return rounded(splicing.inclusion_differences(view(spark, d, "v_events")))
