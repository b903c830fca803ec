"""Queries over reads."""

from pyspark.sql import functions as F

from ..operators import aligned, reads
from ..operators.ordered import global_index
from ..shared import new_folder
from ..sources import fastq, sinks
from .base import register, rounded, table, view

BEST = """marked AS (SELECT *, row_number() OVER (PARTITION BY library, chrom, pos, strand ORDER BY qual_sum DESC, name) > 1 AS duplicate FROM v_reads)"""


@register("W06_marked_duplicates", f", {BEST} SELECT name, library, chrom, pos, strand, duplicate FROM marked", "v_reads")
def marked(spark, d):
    return reads.mark_duplicates(view(spark, d, "v_reads")).select("name", "library", "chrom", "pos", "strand", "duplicate")


PAIRS = "SELECT CAST(floor(name / 2) AS BIGINT) AS name, CAST(name % 2 + 1 AS INT) AS mate, CASE WHEN floor(name / 2) % 3 = 0 THEN 'a' ELSE 'b' END AS library, chrom % 2 AS chrom, pos % 40 AS pos, strand, qual_sum FROM v_reads"


@register(
    "W06_marked_pairs",
    f""", p AS ({PAIRS}), f AS (SELECT library, name, COUNT(*) AS k, MIN(concat(CAST(chrom AS STRING), ':', CAST(pos AS STRING), ':', CAST(strand AS STRING))) AS one,
 MAX(concat(CAST(chrom AS STRING), ':', CAST(pos AS STRING), ':', CAST(strand AS STRING))) AS two, SUM(qual_sum) AS q FROM p GROUP BY library, name),
 r AS (SELECT library, name, row_number() OVER (PARTITION BY library, k, one, two ORDER BY q DESC, name) > 1 AS duplicate FROM f)
SELECT p.library, p.name, p.mate, r.duplicate FROM p JOIN r ON p.library = r.library AND p.name = r.name""",
    "v_reads",
)
def marked_pairs(spark, d):
    view(spark, d, "v_reads").createOrReplaceTempView("v_reads")
    return reads.mark_duplicates(spark.sql(PAIRS)).select("library", "name", "mate", "duplicate")


@register(
    "A24_duplicate_metrics",
    f", {BEST} SELECT library, COUNT(*) AS examined, CAST(SUM(CASE WHEN duplicate THEN 1 ELSE 0 END) AS BIGINT) AS duplicates, round(100.0 * SUM(CASE WHEN duplicate THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE), 6) AS percent FROM marked GROUP BY library",
    "v_reads",
)
def metrics(spark, d):
    return rounded(reads.duplicate_metrics(reads.mark_duplicates(view(spark, d, "v_reads"))))


@register("W05_last_per_key", "SELECT chrom, name, library, pos FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY name DESC) AS rn FROM v_reads) AS r WHERE rn = 1", "v_reads")
def last_row(spark, d):
    rows = view(spark, d, "v_reads").select("chrom", "name", "library", "pos")
    return reads.last_per_key(rows, "chrom", "name")


@register("P03_read_groups", "SELECT name, concat('illumina_', CAST(chrom AS STRING)) AS rg_library, 'illumina' AS rg_platform, 'unit1' AS rg_unit, CAST(chrom AS STRING) AS rg_sample FROM v_reads", "v_reads")
def read_groups(spark, d):
    stamped = reads.with_read_group(view(spark, d, "v_reads"), F.col("chrom"))
    return stamped.select("name", "rg_library", "rg_platform", "rg_unit", "rg_sample")


@register("P21_well_mapped", "SELECT name, mapq FROM v_reads WHERE mapq >= 20", "v_reads")
def well_mapped(spark, d):
    return reads.well_mapped(view(spark, d, "v_reads")).select("name", "mapq")


@register("P21_splice_limits", "SELECT name FROM v_reads WHERE name % 5 <= 3 AND mapq >= 6 AND pos * 1000 <= 299999", "v_reads")
def splice_limits(spark, d):
    spliced = view(spark, d, "v_reads").select(
        "name", (F.col("name") % 5).alias("mismatches"), F.col("mapq").alias("overhang"), (F.col("pos") * 1000).alias("intron")
    )
    return reads.spliced_ok(spliced).select("name")


@register("T02_coordinate_sorted", "SELECT name, chrom, pos FROM v_reads", "v_reads")
def coordinate(spark, d):
    return reads.coordinate_sorted(view(spark, d, "v_reads")).select("name", "chrom", "pos")


@register("T03_grouped_by_name", "SELECT CAST(floor(name / 2) AS BIGINT) AS name, CAST(name % 2 + 1 AS INT) AS mate, pos FROM v_reads", "v_reads")
def by_name(spark, d):
    mates = view(spark, d, "v_reads").select(
        F.floor(F.col("name") / 2).alias("name"), (F.col("name") % 2 + 1).cast("int").alias("mate"), "pos"
    )
    return reads.grouped_by_name(mates)


@register("P28_reads_by_barcode", "SELECT doc_id AS name, substr(text, 1, 2) AS barcode FROM documents WHERE substr(text, 1, 2) IN (SELECT substr(text, 1, 2) FROM benchmark)")
def by_barcode(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq"))
    listed = table(spark, d, "benchmark").select(F.substring("text", 1, 2).alias("barcode"))
    kept = reads.with_barcode(docs, listed, 2).select("name", "barcode")
    path = new_folder(spark, "barcodes")
    sinks.write_by_barcode(kept, path)
    return spark.read.parquet(path).select("name", "barcode")


BASES = "SELECT library AS read_group, mapq AS quality, strand AS cycle, pos % 16 AS context, chrom, pos, qual_sum % 10 = 0 AS mismatch, name FROM v_reads"
TABLE = f"""cov AS (SELECT read_group, quality, cycle, context, COUNT(*) AS observations, CAST(SUM(CASE WHEN mismatch THEN 1 ELSE 0 END) AS BIGINT) AS mismatches
 FROM ({BASES}) AS b WHERE pos % 7 <> 0 GROUP BY read_group, quality, cycle, context)"""
EMPIRICAL = "-10 * log10((mismatches + 1.0) / (observations + 2.0))"


def _bases(spark, d):
    bases = view(spark, d, "v_reads").select(
        "name", F.col("library").alias("read_group"), F.col("mapq").alias("quality"), F.col("strand").alias("cycle"),
        (F.col("pos") % 16).alias("context"), "chrom", "pos", (F.col("qual_sum") % 10 == 0).alias("mismatch"),
    )
    return bases, bases.where(F.col("pos") % 7 == 0).select("chrom", "pos")


@register("A25_covariate_table", f", {TABLE} SELECT *, round({EMPIRICAL}, 6) AS empirical FROM cov", "v_reads")
def covariates(spark, d):
    return rounded(reads.covariate_table(*_bases(spark, d)))


@register(
    "A25_recalibrated",
    f", {TABLE}, emp AS (SELECT *, CAST(round_even({EMPIRICAL}, 0) AS INT) AS e FROM cov) SELECT name, COALESCE(e, b.quality) AS quality FROM ({BASES}) AS b LEFT JOIN emp ON b.read_group = emp.read_group AND b.quality = emp.quality AND b.cycle = emp.cycle AND b.context = emp.context",
    "v_reads",
)
def recalibrated(spark, d):
    bases, known = _bases(spark, d)
    return reads.recalibrated(bases, reads.covariate_table(bases, known)).select("name", "quality")


@register(
    "A31_base_counts",
    """SELECT library AS sample, chrom, pos, CAST(SUM(CASE WHEN base = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS a, CAST(SUM(CASE WHEN base = 'C' THEN 1 ELSE 0 END) AS BIGINT) AS c,
 CAST(SUM(CASE WHEN base = 'G' THEN 1 ELSE 0 END) AS BIGINT) AS g, CAST(SUM(CASE WHEN base = 'T' THEN 1 ELSE 0 END) AS BIGINT) AS t
 FROM (SELECT library, chrom, pos + i AS pos, substr(seq, CAST(i AS INT) + 1, 1) AS base FROM v_reads, (SELECT unnest([0, 1, 2, 3]) AS i) AS s WHERE mapq >= 20) AS b GROUP BY library, chrom, pos""",
    "v_reads",
)
def base_counts(spark, d):
    return reads.base_counts(view(spark, d, "v_reads").withColumnRenamed("library", "sample"))


TAGS = "SELECT l_suppkey AS barcode, l_partkey % 50 AS gene, l_orderkey % 16 AS umi FROM lineitem"


def _tags(spark, d):
    items = table(spark, d, "lineitem")
    return items.select(
        F.col("l_suppkey").alias("barcode"), (F.col("l_partkey") % 50).alias("gene"), (F.col("l_orderkey") % 16).alias("umi")
    )


@register("A26_molecule_counts", f"SELECT barcode, gene, COUNT(DISTINCT umi) AS n FROM ({TAGS}) AS t GROUP BY barcode, gene")
def molecules(spark, d):
    return reads.molecule_counts(_tags(spark, d))


@register(
    "A26_called_cells",
    f"""WITH c AS (SELECT barcode, COUNT(DISTINCT concat(CAST(gene AS STRING), ':', CAST(umi AS STRING))) AS total FROM ({TAGS}) AS t GROUP BY barcode),
top AS (SELECT total FROM c ORDER BY total DESC, barcode LIMIT 50)
SELECT barcode, CAST(total AS BIGINT) AS total FROM c WHERE total >= (SELECT quantile_cont(total, 0.99) FROM top) / 10.0""",
)
def cells(spark, d):
    return reads.called_cells(reads.molecule_counts(_tags(spark, d)), 50)


def _mates(spark, d):
    return view(spark, d, "v_reads").select(
        F.col("library").alias("sample"), F.floor(F.col("name") / 2).alias("name"),
        (F.col("name") % 2 + 1).cast("int").alias("mate"), "seq",
        F.concat(F.lit("@"), F.substring("seq", 2, 3)).alias("qual"),
    )


MATES = "SELECT library AS sample, CAST(floor(name / 2) AS BIGINT) AS name, CAST(name % 2 + 1 AS INT) AS mate, seq, concat('@', substr(seq, 2, 3)) AS qual FROM v_reads"


@register("K08_paired_fastq", f"SELECT sample, mate, COUNT(*) AS n FROM ({MATES}) AS m GROUP BY sample, mate", "v_reads")
def paired_fastq(spark, d):
    path = new_folder(spark, "fastq")
    sinks.write_fastq(_mates(spark, d), path)
    lines = spark.read.text(path)
    return lines.groupBy("sample", "mate").agg(F.floor(F.count(F.lit(1)) / 4).alias("n"))


@register("S09_fastq_records", f"SELECT CAST(name AS STRING) AS name, mate, seq, qual FROM ({MATES}) AS m", "v_reads")
def fastq_records(spark, d):
    path = new_folder(spark, "fastq")
    sinks.write_fastq(_mates(spark, d), path, "none")
    return fastq.read_fastq(spark, path).select("name", "mate", "seq", "qual")


@register("P24_row_index", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents WHERE NOT contains(text, 'N')")
def row_index(spark, d):
    kept = table(spark, d, "documents").where(~F.col("text").contains("N")).select("doc_id")
    return global_index(kept, "doc_id")


# Alignment operations walked one after the other, as rows: lengths before an operation give its place.
WALK = """ops AS (
 SELECT a.*, k, CAST(list_extract(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1), k) AS BIGINT) AS n,
  list_extract(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2), k) AS op
 FROM v_alns a, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS k) AS i WHERE cigar <> '*' AND k <= len(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]'))),
walk AS (
 SELECT *, CAST(pos + COALESCE(SUM(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN n ELSE 0 END) OVER w, 0) AS BIGINT) AS seg_start,
  CAST(COALESCE(SUM(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN n ELSE 0 END) OVER w, 0) AS BIGINT) AS off
 FROM ops WINDOW w AS (PARTITION BY name ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
base AS (
 SELECT name, sample, chrom, strand, mapq, seq, qual, seg_start + j AS pos, off + j + 1 AS nth, substr(seq, CAST(off + j + 1 AS INT), 1) AS base,
  CASE WHEN strand = 1 THEN 12 - off - j ELSE off + j + 1 END AS cycle, ascii(substr(qual, CAST(off + j + 1 AS INT), 1)) - 33 AS quality
 FROM walk, (SELECT unnest(range(0, 12)) AS j) AS s WHERE op IN ('M', '=', 'X') AND j < n)"""


@register(
    "A31_segments",
    f""", {WALK} SELECT name, op, CAST(seg_start AS BIGINT) AS start, CAST(seg_start + CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN n ELSE 0 END AS BIGINT) AS "end", CAST(off AS INT) AS "at" FROM walk""",
    "v_alns",
)
def aligned_segments(spark, d):
    return aligned.segments(view(spark, d, "v_alns").select("name", "pos", "cigar"))


@register(
    "A31_pileup",
    f""", {WALK}, every AS (
 SELECT sample, chrom, pos, base FROM base WHERE mapq >= 20 AND quality >= 21
 UNION ALL SELECT sample, chrom, seg_start + j, '-' FROM walk, (SELECT unnest(range(0, 12)) AS j) AS s WHERE op = 'D' AND j < n AND mapq >= 20
 UNION ALL SELECT sample, chrom, seg_start - 1, '+' FROM walk WHERE op = 'I' AND seg_start > pos AND mapq >= 20)
SELECT sample, chrom, pos, COUNT(*) FILTER (base = 'A') AS a, COUNT(*) FILTER (base = 'C') AS c, COUNT(*) FILTER (base = 'G') AS g,
 COUNT(*) FILTER (base = 'T') AS t, COUNT(*) FILTER (base = '-') AS deleted, COUNT(*) FILTER (base = '+') AS inserted FROM every GROUP BY sample, chrom, pos""",
    "v_alns",
)
def pileup(spark, d):
    return aligned.pileup(view(spark, d, "v_alns"), min_quality=21)


REV = "reverse(translate(seq, 'ACGT', 'TGCA'))"
COVARIATES = f"""{WALK}, cov_bases AS (
 SELECT b.name, b.sample AS read_group, b.quality, CAST(b.cycle AS INT) AS cycle, b.chrom, b.pos,
  concat(CASE WHEN b.cycle = 1 THEN 'N' ELSE substr(CASE WHEN b.strand = 1 THEN {REV} ELSE seq END, CAST(b.cycle - 1 AS INT), 1) END,
   substr(CASE WHEN b.strand = 1 THEN {REV} ELSE seq END, CAST(b.cycle AS INT), 1)) AS context,
  b.base <> substr(r.text, CAST(b.pos - r.start + 1 AS INT), 1) AS mismatch
 FROM base b JOIN v_reference r ON b.chrom = r.chrom AND r.start <= b.pos AND b.pos < r.start + 16)"""


def _covariate_bases(spark, d):
    named = view(spark, d, "v_alns").withColumn("read_group", F.col("sample"))
    return aligned.covariate_bases(named, view(spark, d, "v_reference"), 16)


@register(
    "A25_read_covariates",
    f""", {COVARIATES} SELECT read_group, quality, cycle, context, COUNT(*) AS observations, COUNT(*) FILTER (mismatch) AS mismatches,
 round(-10 * log10((COUNT(*) FILTER (mismatch) + 1.0) / (COUNT(*) + 2.0)), 6) AS empirical
 FROM cov_bases c WHERE NOT EXISTS (SELECT 1 FROM v_alns k WHERE k.chrom = c.chrom AND k.pos = c.pos AND k.mapq >= 50)
 GROUP BY read_group, quality, cycle, context""",
    "v_alns v_reference",
)
def read_covariates(spark, d):
    known = view(spark, d, "v_alns").where("mapq >= 50").select("chrom", "pos")
    return rounded(reads.covariate_table(_covariate_bases(spark, d), known))


GENE_HITS = """hits AS (
 SELECT w.sample, w.name, COUNT(DISTINCT e.gene) AS genes, MIN(e.gene) AS gene FROM walk w JOIN v_exons e
 ON w.chrom = e.chrom AND w.op IN ('M', '=', 'X') AND e.iv_start < w.seg_start + w.n AND w.seg_start < e.iv_end {0} GROUP BY w.sample, w.name)
SELECT sample, gene, COUNT(*) AS n FROM hits WHERE genes = 1 GROUP BY sample, gene"""
OPPOSITE = "AND (w.strand = 0) <> (e.strand = '+')"


@register("J08_exon_counts", f", {WALK}, {GENE_HITS.format('')}", "v_alns v_exons")
def exon_counts(spark, d):
    return aligned.exon_counts(view(spark, d, "v_alns"), view(spark, d, "v_exons"))


@register("J08_stranded_exon_counts", f", {WALK}, {GENE_HITS.format(OPPOSITE)}", "v_alns v_exons")
def stranded_exon_counts(spark, d):
    return aligned.exon_counts(view(spark, d, "v_alns"), view(spark, d, "v_exons"), "opposite")
