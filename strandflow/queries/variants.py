"""Queries over calls and sites."""

from pyspark.sql import functions as F

from ..functions.genotype import dosage
from ..functions.missing import drop_missing, fill_zero, to_number
from ..functions.text import joined_key, pieces, reverse_complement, tag_value
from ..operators import alleles, callreport, genetic_map, homozygosity, liftover, variants
from ..shared import materialised
from .base import register, rounded, view, view_over

SITE = "chrom, pos, ref, alt"
SNP = "length(ref) = 1 AND length(alt) = 1"
TS = "concat(ref, alt) IN ('AG', 'GA', 'CT', 'TC')"
HET_RA = "gt = '0/1'"
HET_AA = "gt = '1/2'"
HOM_AA = "gt = '1/1'"
# Mean prices of 2^n calls can lie halfway between two rounded values; both
# sides add the same small number before rounding.
NUDGE = 3e-8
MEASURES = f"""
  round(CAST(SUM(CASE WHEN {SNP} AND {TS} THEN 1 ELSE 0 END) AS DOUBLE)
        / NULLIF(SUM(CASE WHEN {SNP} AND NOT {TS} THEN 1 ELSE 0 END), 0), 6) AS tstv,
  CAST(SUM(CASE WHEN {SNP} THEN 1 ELSE 0 END) AS BIGINT) AS num_snps,
  CAST(SUM(CASE WHEN {SNP} THEN 0 ELSE 1 END) AS BIGINT) AS num_indels,
  round(AVG(CAST(dp AS DOUBLE)), 6) AS avg_depth,
  round(AVG(COALESCE(qual, 0)) + {NUDGE}, 6) AS avg_quality,
  round(CAST(SUM(CASE WHEN {HET_RA} OR {HET_AA} THEN 1 ELSE 0 END) AS DOUBLE)
        / NULLIF(SUM(CASE WHEN {HOM_AA} THEN 1 ELSE 0 END), 0), 6) AS het_hom_ratio,
  round(AVG(CAST(COALESCE(gq, 0) AS DOUBLE)), 6) AS mean_gq"""
X_RATIO = f"""
  CAST(SUM(CASE WHEN chrom = 'X' AND NOT pos BETWEEN 60001 AND 2699520 AND ({HET_RA} OR {HET_AA}) THEN 1 ELSE 0 END) AS DOUBLE)
  / NULLIF(SUM(CASE WHEN chrom = 'X' AND NOT pos BETWEEN 60001 AND 2699520 AND {HOM_AA} THEN 1 ELSE 0 END), 0)"""


def sex_sql(male: float, female: float) -> str:
    return f"""SELECT sample, CASE WHEN x_ratio <= {male} THEN 'M' WHEN x_ratio >= {female} THEN 'F' ELSE 'U' END AS sex
FROM (SELECT sample, {X_RATIO} AS x_ratio FROM v_geno GROUP BY sample) AS x"""


NAMED = ", ".join(f"'{c}'" for c in callreport.CHROMOSOMES)


@register(
    "A14_call_report",
    f"""SELECT r.*, s.sex FROM (
SELECT sample, CASE WHEN grouping(chrom) = 1 THEN 'Genome' ELSE chrom END AS chr, {MEASURES}
FROM v_geno GROUP BY GROUPING SETS ((sample), (sample, chrom))) AS r
JOIN ({sex_sql(0.2, 0.4)}) AS s ON r.sample = s.sample
WHERE r.chr = 'Genome' OR r.chr IN ({NAMED})""",
    "v_geno",
)
def call_report(spark, d):
    report = callreport.call_report(view(spark, d, "v_geno"))
    return rounded(report.withColumn("avg_quality", F.col("avg_quality") + NUDGE))


@register(
    "A14_written_report",
    f"""SELECT 'cohort.vcf' AS "fileName", CAST(sample AS STRING) AS "sampleName", chr AS "Chr", CAST(num_snps AS STRING) AS "numSNPs", CAST(num_indels AS STRING) AS "numINDELs"
FROM (SELECT sample, CASE WHEN grouping(chrom) = 1 THEN 'Genome' ELSE chrom END AS chr, {MEASURES} FROM v_geno GROUP BY GROUPING SETS ((sample), (sample, chrom))) AS r
WHERE chr = 'Genome' OR chr IN ({NAMED})""",
    "v_geno",
)
def written_report(spark, d):
    from ..shared import new_folder
    from ..sources.sinks import write_tsv
    from ..sources.text import read_table

    path = new_folder(spark, "report")
    report = callreport.call_report(view(spark, d, "v_geno"))
    write_tsv(callreport.report_text(report, "cohort.vcf"), path)
    schema = ", ".join(f"{c} string" for c in callreport.REPORT_HEADER)
    return read_table(spark, path, schema, "\t").select("fileName", "sampleName", "Chr", "numSNPs", "numINDELs")


def _part(*cols):
    def run(spark, d):
        measures = callreport.sample_measures(view(spark, d, "v_geno"))
        return rounded(measures.withColumn("avg_quality", F.col("avg_quality") + NUDGE).select("sample", *cols))

    return run


def _part_sql(*cols):
    return f"SELECT sample, {', '.join(cols)} FROM (SELECT sample, {MEASURES} FROM v_geno GROUP BY sample) AS m"


for _name, _cols in {
    "A10_transition_ratio": ["tstv"],
    "A11_snp_indel_counts": ["num_snps", "num_indels"],
    "A12_mean_depth_quality": ["avg_depth", "avg_quality", "mean_gq"],
    "A13_het_hom_ratio": ["het_hom_ratio"],
}.items():
    register(_name, _part_sql(*_cols), "v_geno")(_part(*_cols))


@register("A15_sex_calls", sex_sql(1.9, 2.1), "v_geno")
def sex_calls(spark, d):
    return variants.sex_calls(view(spark, d, "v_geno"), male_max=1.9, female_min=2.1)


@register(
    "A27_dosage",
    f"SELECT sample, {SITE}, CASE gt WHEN '0/0' THEN 0 WHEN '0/1' THEN 1 ELSE 2 END AS dosage FROM v_geno",
    "v_geno",
)
def dosages(spark, d):
    return view(spark, d, "v_geno").select("sample", "chrom", "pos", "ref", "alt", dosage().alias("dosage"))


@register("P04_site_key", "SELECT sample, concat(chrom, ':', CAST(pos AS STRING)) AS mutation_id, concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', alt) AS var_id FROM v_geno", "v_geno")
def site_key(spark, d):
    return view(spark, d, "v_geno").select(
        "sample",
        joined_key(":", "chrom", "pos").alias("mutation_id"),
        joined_key("_", "chrom", "pos", "ref", "alt").alias("var_id"),
    )


@register("P01_renamed_columns", "SELECT pos AS position, chrom AS contig, sample FROM v_geno", "v_geno")
def renamed(spark, d):
    geno = view(spark, d, "v_geno").withColumnsRenamed({"chrom": "contig", "pos": "position"})
    return geno.select("position", "contig", "sample")


@register("P02_literal_copy_numbers", f"SELECT {SITE}, 2 AS normal_cn, 0 AS minor_cn, 2 AS major_cn FROM v_sites", "v_sites")
def literals(spark, d):
    return view(spark, d, "v_sites").select(
        "chrom", "pos", "ref", "alt",
        F.lit(2).alias("normal_cn"), F.lit(0).alias("minor_cn"), F.lit(2).alias("major_cn"),
    )


@register("P05_fill_missing", f"SELECT sample, {SITE}, COALESCE(gq, 0) AS gq, COALESCE(note, '0') AS note FROM (SELECT *, CASE WHEN gq IS NULL THEN NULL ELSE gt END AS note FROM v_geno) AS g", "v_geno")
def fill_missing(spark, d):
    geno = view(spark, d, "v_geno").withColumn("note", F.when(F.col("gq").isNotNull(), F.col("gt")))
    return fill_zero(geno.select("sample", "chrom", "pos", "ref", "alt", "gq", "note"))


@register("P06_drop_missing", "SELECT sample, chrom, pos, gq FROM v_geno WHERE gq IS NOT NULL", "v_geno")
def drop_na(spark, d):
    return drop_missing(view(spark, d, "v_geno").select("sample", "chrom", "pos", "gq"))


@register(
    "P07_split_packed",
    "SELECT sample, chrom, pos, split_part(fmt, ':', 1) AS gt_part, split_part(fmt, ':', 2) AS ad_part, split_part(fmt, ':', 4) = '' AS no_fourth FROM v_geno",
    "v_geno",
)
def split_packed(spark, d):
    a, b, _, extra = pieces(F.col("fmt"), ":", 4)
    return view(spark, d, "v_geno").select(
        "sample", "chrom", "pos", a.alias("gt_part"), b.alias("ad_part"), extra.isNull().alias("no_fourth")
    )


@register("P08_text_to_number", "SELECT sample, chrom, pos, TRY_CAST(alt AS DOUBLE) IS NULL AS no_number, TRY_CAST(chrom AS DOUBLE) AS of_chrom FROM v_geno", "v_geno")
def text_to_number(spark, d):
    return view(spark, d, "v_geno").select(
        "sample", "chrom", "pos", to_number(F.col("alt")).isNull().alias("no_number"), to_number(F.col("chrom")).alias("of_chrom")
    )


AD = "CAST(split_part(split_part(fmt, ':', 2), ',', {}) AS DOUBLE)"


@register(
    "P09_allele_fraction",
    f"""SELECT sample, chrom, pos, depth, round(af, 6) AS af FROM (
SELECT sample, chrom, pos, {AD.format(1)} + {AD.format(2)} AS depth,
       {AD.format(2)} / NULLIF({AD.format(1)} + {AD.format(2)}, 0) AS af FROM v_geno) AS x
WHERE af NOT IN (0, 0.5, 1)""",
    "v_geno",
)
def fractions(spark, d):
    _, depths = pieces(F.col("fmt"), ":", 2)
    ref, var = [to_number(p) for p in pieces(depths, ",", 2)]
    af = variants.allele_fraction(ref, var)
    kept = view(spark, d, "v_geno").select("sample", "chrom", "pos", (ref + var).alias("depth"), af.alias("af"))
    return rounded(kept.where(~F.col("af").isin(0.0, 0.5, 1.0)))


@register(
    "P10_clonality_input",
    f"""SELECT concat(chrom, ':', CAST(pos AS STRING)) AS mutation_id, {AD.format(1)} AS ref_counts, {AD.format(2)} AS var_counts,
 2 AS normal_cn, 0 AS minor_cn, 2 AS major_cn FROM v_geno
WHERE {AD.format(2)} / NULLIF({AD.format(1)} + {AD.format(2)}, 0) NOT IN (0, 0.5, 1)""",
    "v_geno",
)
def clonality(spark, d):
    return variants.clonality_input(view(spark, d, "v_geno"))


@register("P18_genotype_depth", f"SELECT sample, {SITE}, dp FROM v_geno WHERE dp >= 6", "v_geno")
def genotype_depth(spark, d):
    return variants.min_genotype_depth(view(spark, d, "v_geno")).select("sample", "chrom", "pos", "ref", "alt", "dp")


@register(
    "P19_covered_sites",
    f"SELECT sample, {SITE}, dp FROM v_geno WHERE ({SITE}) IN (SELECT ({SITE}) FROM v_geno GROUP BY {SITE} HAVING MAX(dp) >= 30)",
    "v_geno",
)
def covered_sites(spark, d):
    return variants.covered_sites(view(spark, d, "v_geno"), 30).select("sample", "chrom", "pos", "ref", "alt", "dp")


CUT_LEVELS = ", ".join(
    f"('{kind}', {t})"
    for kind, levels in (("SNP", variants.SNP_TRANCHES), ("INDEL", variants.INDEL_TRANCHES))
    for t in levels
)
TYPE = f"CASE WHEN {SNP} THEN 'SNP' ELSE 'INDEL' END"
CUTS = f"""levels(var_type, tranche) AS (VALUES {CUT_LEVELS}),
scored AS (SELECT {TYPE} AS var_type, score FROM v_sites WHERE ({SITE}) IN (SELECT ({SITE}) FROM v_truth)),
ranked AS (SELECT var_type, score, row_number() OVER (PARTITION BY var_type ORDER BY score) - 1 AS rn,
                  count(*) OVER (PARTITION BY var_type) AS m FROM scored),
cuts AS (SELECT l.var_type, CAST(l.tranche AS DOUBLE) AS tranche,
       MAX(CASE WHEN rn = floor((1 - l.tranche / 100.0) * (m - 1)) THEN score END)
       + ((1 - MAX(CAST(l.tranche AS DOUBLE)) / 100.0) * (MAX(m) - 1) - floor((1 - MAX(CAST(l.tranche AS DOUBLE)) / 100.0) * (MAX(m) - 1)))
         * (MAX(CASE WHEN rn = ceil((1 - l.tranche / 100.0) * (m - 1)) THEN score END)
            - MAX(CASE WHEN rn = floor((1 - l.tranche / 100.0) * (m - 1)) THEN score END)) AS cutoff
  FROM levels l JOIN ranked r ON l.var_type = r.var_type GROUP BY l.var_type, l.tranche)"""
LABELED = f"""labeled AS (
 SELECT v.chrom, v.pos, v.ref, v.alt, v.var_type,
  CASE WHEN MAX(CASE WHEN v.score < c.cutoff THEN c.tranche END) IS NULL
            OR MIN(CASE WHEN v.score >= c.cutoff THEN c.tranche END) <= MIN(c.tranche) THEN 'PASS'
       ELSE concat('CNN_1D_', v.var_type, '_Tranche_', printf('%.2f', MAX(CASE WHEN v.score < c.cutoff THEN c.tranche END)), '_',
              printf('%.2f', COALESCE(MIN(CASE WHEN v.score >= c.cutoff THEN c.tranche END), 100.0))) END AS tag
 FROM (SELECT *, {TYPE} AS var_type FROM v_sites) v JOIN cuts c ON v.var_type = c.var_type
 GROUP BY v.chrom, v.pos, v.ref, v.alt, v.var_type)"""


def tranche_inputs(spark, d):
    sites = view(spark, d, "v_sites")
    return sites, variants.tranche_cutoffs(sites, view(spark, d, "v_truth"))


@register("A32_tranche_cutoffs", f", {CUTS} SELECT var_type, tranche, round(cutoff, 4) AS cutoff FROM cuts", "v_sites v_truth")
def cutoffs(spark, d):
    return rounded(tranche_inputs(spark, d)[1], 4)


@register("A32_tranche_labels", f", {CUTS}, {LABELED} SELECT {SITE}, var_type, tag FROM labeled", "v_sites v_truth")
def tranche_labels(spark, d):
    labeled = variants.label_tranches(*tranche_inputs(spark, d))
    return labeled.select("chrom", "pos", "ref", "alt", "var_type", F.col("filter")[0].alias("tag"))


FAILED = [variants.tranche_tag("SNP", 99.95, 100), variants.tranche_tag("INDEL", 99.4, 100)]


@register(
    "P20_without_failed",
    f", {CUTS}, {LABELED} SELECT {SITE} FROM labeled WHERE tag NOT IN ('{FAILED[0]}', '{FAILED[1]}')",
    "v_sites v_truth",
)
def without_failed(spark, d):
    labeled = variants.label_tranches(*tranche_inputs(spark, d))
    return variants.without_tags(labeled, FAILED).select("chrom", "pos", "ref", "alt")


@register(
    "U05_rows_not_listed",
    f"SELECT {SITE} FROM v_sites EXCEPT SELECT {SITE} FROM v_truth",
    "v_sites v_truth",
)
def not_listed(spark, d):
    cols = ["chrom", "pos", "ref", "alt"]
    return view(spark, d, "v_sites").select(*cols).join(view(spark, d, "v_truth"), cols, "left_anti")


@register("P23_binary_label", "SELECT sample, chrom, pos, CASE WHEN gt = '0/0' THEN 0 ELSE 1 END AS label FROM v_geno", "v_geno")
def binary_label(spark, d):
    return view(spark, d, "v_geno").select(
        "sample", "chrom", "pos", (dosage() > 0).cast("int").alias("label")
    )


@register(
    "J02_annotate_frequency",
    f"SELECT g.sample, g.chrom, g.pos, g.ref, g.alt, f.af FROM v_geno g LEFT JOIN v_af f ON g.chrom = f.chrom AND g.pos = f.pos AND g.ref = f.ref AND g.alt = f.alt",
    "v_geno v_af",
)
def annotate(spark, d):
    joined = variants.annotate_frequency(view(spark, d, "v_geno"), view(spark, d, "v_af"))
    return joined.select("sample", "chrom", "pos", "ref", "alt", "af")


@register(
    "J03_exclude_known",
    f"SELECT sample, {SITE} FROM v_geno WHERE (chrom, pos) NOT IN (SELECT (chrom, pos) FROM v_truth)",
    "v_geno v_truth",
)
def exclude_known(spark, d):
    kept = variants.exclude_known(view(spark, d, "v_geno"), view(spark, d, "v_truth"))
    return kept.select("sample", "chrom", "pos", "ref", "alt")


@register(
    "J04_in_truth",
    f"SELECT {SITE}, score FROM v_sites WHERE ({SITE}) IN (SELECT ({SITE}) FROM v_truth) OR ({SITE}) IN (SELECT ({SITE}) FROM v_af)",
    "v_sites v_truth v_af",
)
def in_truth(spark, d):
    found = variants.in_truth(view(spark, d, "v_sites"), view(spark, d, "v_truth"), view(spark, d, "v_af"))
    return found.select("chrom", "pos", "ref", "alt", "score")


@register(
    "J07_in_intervals",
    f"SELECT sample, {SITE} FROM v_geno g WHERE EXISTS (SELECT 1 FROM v_intervals i WHERE i.chrom = g.chrom AND i.iv_start < g.pos - 1 + length(g.ref) AND g.pos - 1 < i.iv_end)",
    "v_geno v_intervals",
)
def in_intervals(spark, d):
    kept = variants.in_intervals(view(spark, d, "v_geno"), view(spark, d, "v_intervals"))
    return kept.select("sample", "chrom", "pos", "ref", "alt")


@register(
    "J12_merged_calls",
    f"SELECT {SITE}, COUNT(*) AS n_samples, string_agg(concat(CAST(sample AS STRING), '=', gt), ';' ORDER BY sample, gt) AS calls FROM v_geno GROUP BY {SITE}",
    "v_geno",
)
def merged(spark, d):
    return variants.merge_calls(view(spark, d, "v_geno"))


UNIFIED = """own AS (SELECT sample, chrom, gt, alt, pos % 11 = 0 AND pos % 4 = 2 AS moves, pos FROM v_geno),
placed AS (SELECT sample, chrom, CASE WHEN moves THEN pos - 1 ELSE pos END AS np, CASE WHEN moves THEN 'C' ELSE substr('ACGT', CAST(pos % 4 AS INT) + 1, 1) END AS nr,
  CASE WHEN moves THEN 'CGA' ELSE alt END AS na, length(gt) - length(replace(gt, '1', '')) AS n1, length(gt) - length(replace(gt, '2', '')) AS miss FROM own),
alts AS (SELECT chrom, np, nr, list_sort(list_distinct(list(na))) AS alts FROM placed GROUP BY chrom, np, nr),
per AS (SELECT p.sample, p.chrom, p.np, p.nr, a.alts, MIN(miss) AS miss, CAST(SUM(n1) AS BIGINT) AS n,
  string_agg(repeat(concat(CAST(list_position(a.alts, na) AS VARCHAR), '/'), n1), '' ORDER BY list_position(a.alts, na)) AS own
  FROM placed p JOIN alts a ON p.chrom = a.chrom AND p.np = a.np AND p.nr = a.nr GROUP BY p.sample, p.chrom, p.np, p.nr, a.alts),
named AS (SELECT *, rtrim(concat(repeat('./', least(greatest(2 - n, 0), miss)), repeat('0/', greatest(2 - n, 0) - least(greatest(2 - n, 0), miss)), own), '/') AS gt FROM per)
SELECT chrom, np AS pos, nr AS ref, array_to_string(alts, ',') AS alt, CAST(floor(sample / 4) AS INT) AS block, COUNT(*) AS n_samples,
  string_agg(concat(CAST(sample AS VARCHAR), '=', gt), ';' ORDER BY sample) AS calls FROM named GROUP BY chrom, np, nr, alts, floor(sample / 4)"""


@register("J12_unified_calls", f", {UNIFIED}", "v_geno")
def unified(spark, d):
    """All alleles of a place in one record, written left and short, calls in blocks of four samples."""
    # the genome of the calls repeats ACGT: an AG put in behind a G (4k + 2) moves one base to the left
    window = F.floor(F.col("pos") / 64)
    geno = materialised(view(spark, d, "v_geno"), "geno")
    genome = (
        view_over(geno, "v_sites", "v_geno").select("chrom", F.explode(F.sequence(window - 1, window)).alias("w")).distinct()
        .select("chrom", (F.col("w") * 64).alias("start"), F.repeat(F.lit("CGTA"), F.lit(16)).alias("text"))
    )
    return alleles.unified_calls(geno, genome, together=4)


@register("U01_cohort_union", "SELECT sample, chrom, pos, gt FROM v_geno", "v_geno")
def cohort_union(spark, d):
    geno = view(spark, d, "v_geno").select("sample", "chrom", "pos", "gt")
    parts = [geno.where(F.col("chrom").isin("X", "Y")), geno.where(~F.col("chrom").isin("X", "Y"))]
    return variants.cohort_union(parts)


@register("S08_stored_query", "SELECT sample, COUNT(*) AS n FROM v_geno WHERE chrom = lower('X') OR lower(chrom) = lower('X') GROUP BY sample", "v_geno")
def stored_query(spark, d):
    from ..sources.metastore import run_stored_query

    view(spark, d, "v_geno").createOrReplaceTempView("calls")
    text = "SELECT sample, COUNT(*) AS n FROM calls WHERE lower(chrom) = :run_id GROUP BY sample"
    return run_stored_query(spark, text, "X")


RUNS = """runs AS (
 SELECT sample, chrom, MIN(pos) AS start, MAX(pos) AS "end", MAX(pos) - MIN(pos) + 1 AS length,
        COUNT(*) AS n_markers, round(AVG(CAST(COALESCE(gq, 0) AS DOUBLE)), 6) AS quality
 FROM (SELECT *, SUM(CASE WHEN gt IN ('0/1', '1/2') THEN 1 ELSE 0 END) OVER (PARTITION BY sample, chrom ORDER BY pos) AS island FROM v_geno) AS g
 WHERE gt NOT IN ('0/1', '1/2') GROUP BY sample, chrom, island)"""


@register("W07_homozygous_runs", f", {RUNS} SELECT * FROM runs", "v_geno")
def homozygous_runs(spark, d):
    return rounded(homozygosity.homozygous_runs(view(spark, d, "v_geno")))


@register("W08_long_regions", f", {RUNS} SELECT * FROM runs WHERE length > 1000", "v_geno")
def long_regions(spark, d):
    runs = homozygosity.homozygous_runs(view(spark, d, "v_geno"))
    return rounded(homozygosity.long_regions(runs, 1000))


@register(
    "K03_bed_rows",
    f""", {RUNS} SELECT concat(chrom, chr(9), CAST(start AS STRING), chr(9), CAST("end" AS STRING), chr(9), 'Length=', CAST(length AS STRING), ';NumberOfMarkers=', CAST(n_markers AS STRING)) AS line
FROM runs WHERE length > 1000 UNION ALL SELECT '#gffTags'""",
    "v_geno",
)
def bed_rows(spark, d):
    from ..sources.text import read_lines
    from ..sources.sinks import write_lines
    from ..shared import new_folder

    runs = homozygosity.long_regions(homozygosity.homozygous_runs(view(spark, d, "v_geno")), 1000)
    rows = homozygosity.bed_rows(runs)
    short = F.regexp_replace("attributes", ";Quality=.*$", "")
    path = new_folder(spark, "bed")
    write_lines(rows.select("chrom", "start", "end", short.alias("attributes")), path, ["#gffTags"])
    return read_lines(spark, path).select(F.col("value").alias("line"))


@register("F10_tag_lookup", f", {RUNS} SELECT sample, chrom, start, CAST(n_markers AS STRING) AS markers, true AS absent FROM runs", "v_geno")
def tag_lookup(spark, d):
    from ..functions.text import pack_tags

    runs = homozygosity.homozygous_runs(view(spark, d, "v_geno"))
    packed = runs.withColumn("tags", pack_tags(Length=F.col("length"), NumberOfMarkers=F.col("n_markers")))
    return packed.select(
        "sample", "chrom", "start",
        tag_value(F.col("tags"), "NumberOfMarkers").alias("markers"),
        tag_value(F.col("tags"), "Missing").isNull().alias("absent"),
    )


@register("W07_autozygous_runs")
def autozygous_runs(spark, d):
    geno = view(spark, d, "v_geno")
    af = view(spark, d, "v_af")
    joined = variants.annotate_frequency(geno, af).select(
        "sample", "chrom", "pos", dosage().alias("dosage"), F.coalesce("af", F.lit(0.5)).alias("af")
    )
    return homozygosity.autozygous_runs(joined)


@register(
    "S13_map_positions",
    """, s AS (SELECT DISTINCT chrom, pos FROM v_geno),
j AS (SELECT s.chrom, s.pos, (SELECT MAX(m.pos) FROM v_map m WHERE m.chrom = s.chrom AND m.pos <= s.pos) AS p0,
 (SELECT MIN(m.pos) FROM v_map m WHERE m.chrom = s.chrom AND m.pos >= s.pos) AS p1 FROM s)
SELECT j.chrom, j.pos, round(CASE WHEN p0 IS NULL THEN b.cm WHEN p1 IS NULL OR p0 = p1 THEN a.cm
 ELSE a.cm + (b.cm - a.cm) * (CAST(j.pos - p0 AS DOUBLE) / (p1 - p0)) END, 6) + 0.0 AS cm
FROM j LEFT JOIN v_map a ON a.chrom = j.chrom AND a.pos = j.p0 LEFT JOIN v_map b ON b.chrom = j.chrom AND b.pos = j.p1""",
    "v_geno v_map",
)
def map_positions(spark, d):
    """Every called site's place on the genetic map."""
    sites = view(spark, d, "v_geno").select("chrom", "pos").distinct()
    return rounded(genetic_map.with_map_position(sites, view(spark, d, "v_map")))


@register("W07_autozygous_runs_by_map")
def autozygous_by_map(spark, d):
    geno = variants.annotate_frequency(view(spark, d, "v_geno"), view(spark, d, "v_af")).select(
        "sample", "chrom", "pos", dosage().alias("dosage"), F.coalesce("af", F.lit(0.5)).alias("af")
    )
    return homozygosity.autozygous_runs(genetic_map.with_map_position(geno, view(spark, d, "v_map")))


HITS = """lifted AS (
 SELECT v.chrom, v.pos, v.ref, v.alt, COUNT(c.chrom) AS hits, MAX(c.tgt_chrom) AS tgt_chrom,
  MAX(CASE WHEN c.strand = '+' THEN c.tgt_start + v.pos - c.src_start ELSE c.tgt_start + c.src_end - v.pos + 1 END) AS np, MAX(c.strand) AS strand
 FROM v_sites v LEFT JOIN v_chain c ON v.chrom = c.chrom AND c.src_start <= v.pos - 1 AND v.pos - 1 < c.src_end
 GROUP BY v.chrom, v.pos, v.ref, v.alt)"""
RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
ACCEPT = f"""SELECT {SITE}, tgt_chrom AS new_chrom, np AS new_pos,
 CASE WHEN strand = '+' THEN ref ELSE {RC.format('ref')} END AS new_ref,
 CASE WHEN strand = '+' THEN alt ELSE {RC.format('alt')} END AS new_alt FROM lifted WHERE hits = 1"""
REJECT = f"SELECT {SITE}, CASE WHEN hits = 0 THEN 'NoTarget' ELSE 'MultipleTargets' END AS reject_reason FROM lifted WHERE hits <> 1"


def _lifted(spark, d):
    return liftover.lift_over(view(spark, d, "v_sites"), view(spark, d, "v_chain").drop("name"))


@register("J09_lifted_sites", f", {HITS} {ACCEPT}", "v_sites v_chain")
def lifted(spark, d):
    return liftover.accepted(_lifted(spark, d)).select(
        "chrom", "pos", "ref", "alt", "new_chrom", "new_pos", "new_ref", "new_alt"
    )


BEST = """ranked AS (
 SELECT v.chrom, v.pos, v.ref, v.alt, c.tgt_chrom, c.strand,
  CASE WHEN c.strand = '+' THEN c.tgt_start + v.pos - c.src_start ELSE c.tgt_start + c.src_end - v.pos + 1 END AS np,
  row_number() OVER (PARTITION BY v.chrom, v.pos, v.ref, v.alt ORDER BY c.src_end - c.src_start DESC, c.src_start) AS place
 FROM v_sites v LEFT JOIN v_chain c ON v.chrom = c.chrom AND c.src_start <= v.pos - 1 AND v.pos - 1 < c.src_end),
lifted AS (SELECT chrom, pos, ref, alt, tgt_chrom, np, CASE WHEN strand = '+' THEN ref ELSE reverse(translate(ref, 'ACGT', 'TGCA')) END AS nr,
  CASE WHEN strand = '+' THEN alt ELSE reverse(translate(alt, 'ACGT', 'TGCA')) END AS na FROM ranked WHERE place = 1),
judged AS (SELECT l.*, CASE WHEN np IS NULL THEN 'NoTarget' WHEN t.text IS NULL THEN 'NoReference'
  WHEN substr(t.text, CAST(np - t.start AS INT), 1) <> nr THEN 'MismatchedRefAllele' END AS reject_reason
 FROM lifted l LEFT JOIN v_reference t ON CAST(t.chrom AS VARCHAR) = l.tgt_chrom AND t.start < np AND np <= t.start + length(t.text))"""


@register(
    "J09_best_chain_sites",
    f", {BEST} SELECT {SITE}, " + ", ".join(
        f"CASE WHEN reject_reason IS NULL THEN {c} END AS {n}"
        for c, n in (("tgt_chrom", "new_chrom"), ("np", "new_pos"), ("nr", "new_ref"), ("na", "new_alt"))
    ) + ", reject_reason FROM judged",
    "v_sites v_chain v_reference",
)
def best_chain_sites(spark, d):
    """Sites through overlapping chains, the longest block first, compared with the new genome's text."""
    blocks = view(spark, d, "v_chain").withColumns(
        {"score": F.col("src_end") - F.col("src_start"), "chain": F.col("src_start")}
    )
    reference = view(spark, d, "v_reference").withColumn("chrom", F.col("chrom").cast("string"))
    lifted = liftover.lift_over(view(spark, d, "v_sites"), liftover.best_chains(blocks))
    judged = liftover.checked_alleles(lifted, reference)
    return judged.select("chrom", "pos", "ref", "alt", "new_chrom", "new_pos", "new_ref", "new_alt", "reject_reason")


@register(
    "K07_split_output",
    f", {HITS} SELECT 'accepted' AS part, COUNT(*) AS n FROM lifted WHERE hits = 1 UNION ALL SELECT CASE WHEN hits = 0 THEN 'NoTarget' ELSE 'MultipleTargets' END, COUNT(*) FROM lifted WHERE hits <> 1 GROUP BY 1",
    "v_sites v_chain",
)
def split_output(spark, d):
    from ..shared import new_folder
    from ..sources.sinks import write_split

    path = new_folder(spark, "liftover")
    write_split(_lifted(spark, d), F.col("reject_reason").isNull(), f"{path}/accepted", f"{path}/rejected")
    kept = spark.read.parquet(f"{path}/accepted").select(F.lit("accepted").alias("part"))
    lost = spark.read.parquet(f"{path}/rejected").select(F.col("reject_reason").alias("part"))
    return kept.unionByName(lost).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@register("J09_rejected_sites", f", {HITS} {REJECT}", "v_sites v_chain")
def rejected(spark, d):
    return liftover.rejected(_lifted(spark, d)).select("chrom", "pos", "ref", "alt", "reject_reason")


@register("F08_reverse_complement", f"SELECT {SITE}, {RC.format('alt')} AS rc FROM v_sites", "v_sites")
def rev_comp(spark, d):
    return view(spark, d, "v_sites").select("chrom", "pos", "ref", "alt", reverse_complement(F.col("alt")).alias("rc"))


@register(
    "F06_log_and_round",
    "SELECT sample, chrom, pos, round(log2(dp), 6) AS l2, round(log10(dp), 6) AS l10, round_even(dp / 20.0, 0) AS rounded FROM v_geno",
    "v_geno",
)
def logs(spark, d):
    return rounded(
        view(spark, d, "v_geno").select(
            "sample", "chrom", "pos",
            F.log2("dp").alias("l2"), F.log10("dp").alias("l10"),
            F.bround(F.col("dp") / F.lit(20.0), 0).alias("rounded"),
        )
    )


@register(
    "F07_text_functions",
    "SELECT sample, chrom, pos, starts_with(fmt, '0/1') AS is_het, contains(alt, 'AG') AS has_ag, lower(alt) AS low, replace(fmt, '/', '|') AS phased, CAST(regexp_extract(fmt, ':([0-9]+)$', 1) AS INT) AS depth FROM v_geno",
    "v_geno",
)
def text_functions(spark, d):
    return view(spark, d, "v_geno").select(
        "sample", "chrom", "pos",
        F.col("fmt").startswith("0/1").alias("is_het"),
        F.col("alt").contains("AG").alias("has_ag"),
        F.lower("alt").alias("low"),
        F.regexp_replace("fmt", "/", "|").alias("phased"),
        F.regexp_extract("fmt", ":([0-9]+)$", 1).cast("int").alias("depth"),
    )


@register(
    "F11_recode_and_default",
    "SELECT sample, chrom, pos, COALESCE(gq, 0) AS gq, CASE gt WHEN '0/0' THEN 'ref' WHEN '1/1' THEN 'alt' ELSE 'het' END AS state FROM v_geno",
    "v_geno",
)
def recode(spark, d):
    return view(spark, d, "v_geno").select(
        "sample", "chrom", "pos", F.coalesce("gq", F.lit(0)).alias("gq"),
        F.when(F.col("gt") == "0/0", "ref").when(F.col("gt") == "1/1", "alt").otherwise("het").alias("state"),
    )


@register("J08_reads_per_gene",
    """, hits AS (SELECT g.sample, g.chrom, g.pos, COUNT(DISTINCT c.name) AS genes, MIN(c.name) AS gene
 FROM v_geno g JOIN v_chain c ON g.chrom = c.chrom AND c.src_start <= g.pos AND g.pos < c.src_end GROUP BY g.sample, g.chrom, g.pos)
SELECT sample, gene, COUNT(*) AS n FROM hits WHERE genes = 1 GROUP BY sample, gene""", "v_geno v_chain")
def reads_per_gene(spark, d):
    from ..operators.reads import gene_counts

    genes = view(spark, d, "v_chain").select(
        "chrom", F.col("src_start").alias("iv_start"), F.col("src_end").alias("iv_end"), F.col("name").alias("gene")
    )
    reads = view(spark, d, "v_geno").select("sample", "chrom", "pos", joined_key(":", "chrom", "pos").alias("name"))
    return gene_counts(reads, genes)
