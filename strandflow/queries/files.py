"""Queries that write a view as files and read it back through the sources."""

from pyspark.sql import functions as F

from ..functions.genotype import CONTIG_ORDER
from ..operators.reads import contig_ordinal
from ..shared import new_folder
from ..sources import annotation, chain, matrix, sinks, text, vcf
from .base import register, rounded, table, view

PART = "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_size bigint, p_retailprice double"


def _part(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", "p_brand", F.col("p_size").cast("bigint").alias("p_size"), "p_retailprice")


@register("S01_csv_table", PART)
def csv_table(spark, d):
    path = new_folder(spark, "csv")
    sinks.write_csv(_part(spark, d), path)
    return text.read_table(spark, path, PART_SCHEMA)


@register("K01_csv_inferred", "SELECT COUNT(*) AS n, CAST(SUM(p_partkey) AS BIGINT) AS keys, round(SUM(p_retailprice), 2) AS price FROM part")
def csv_inferred(spark, d):
    path = new_folder(spark, "csv")
    sinks.write_csv(_part(spark, d), path)
    rows = text.read_table(spark, path)
    return rounded(
        rows.agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").cast("bigint").alias("keys"), F.sum("p_retailprice").alias("price")), 2
    )


@register("K02_tsv_unquoted", PART)
def tsv(spark, d):
    path = new_folder(spark, "tsv")
    sinks.write_tsv(_part(spark, d), path)
    return text.read_table(spark, path, PART_SCHEMA, "\t")


@register("S02_wide_counts", """SELECT CASE WHEN gene % 9 = 0 THEN concat('g, "', CAST(gene AS STRING), '"') WHEN gene % 9 = 1 THEN concat('g', chr(10), CAST(gene AS STRING)) ELSE CAST(gene AS STRING) END AS gene,
 concat('c', CAST(cell AS STRING), CASE WHEN cell % 3 = 0 THEN ', "x"' ELSE '' END) AS cell, CAST(n AS DOUBLE) AS n FROM v_expr""", "v_expr")
def wide_counts(spark, d):
    """Names with commas, quotes and line breaks, written and read back."""
    gene, cell = F.col("gene").cast("string"), F.col("cell").cast("string")
    expr = view(spark, d, "v_expr").select(
        F.when(F.col("gene") % 9 == 0, F.concat(F.lit('g, "'), gene, F.lit('"')))
        .when(F.col("gene") % 9 == 1, F.concat(F.lit("g\n"), gene)).otherwise(gene).alias("gene"),
        F.concat(F.lit("c"), cell, F.when(F.col("cell") % 3 == 0, ', "x"').otherwise("")).alias("cell"), "n",
    )
    path = new_folder(spark, "wide")
    sinks.write_wide_counts(expr, path)
    return text.read_wide_counts(spark, path)


@register("S03_matrix_market", "SELECT c.barcode, g.symbol, CAST(e.gene AS BIGINT) AS gene, CAST(e.n AS DOUBLE) AS n FROM v_expr e JOIN v_cells c ON e.cell = c.cell JOIN v_genes g ON e.gene = g.gene", "v_expr v_cells v_genes")
def matrix_market(spark, d):
    path = new_folder(spark, "mtx")
    expr, genes, cell = view(spark, d, "v_expr"), view(spark, d, "v_genes"), view(spark, d, "v_cells")
    rows = expr.select((F.col("gene") + 1).alias("i"), (F.col("cell") + 1).alias("j"), "n")
    sinks.write_lines(rows, f"{path}/matrix", ["%%MatrixMarket matrix coordinate integer general", "%", "0 0 0"], " ")
    named = genes.repartitionByRange("gene").sortWithinPartitions("gene")
    sinks.write_lines(named.select(F.col("gene").alias("id"), "symbol"), f"{path}/features", [])
    sinks.write_lines(cell.repartitionByRange("cell").sortWithinPartitions("cell").select("barcode"), f"{path}/barcodes", [])
    read = matrix.read_matrix_market(spark, f"{path}/matrix", f"{path}/barcodes", f"{path}/features")
    return read.select("barcode", "symbol", (F.col("gene") - 1).alias("gene"), "n")


def _per_sample(spark, df, key, path, header=True):
    df.write.partitionBy(key).options(header=header, sep="\t").csv(path)


@register("S05_quantification_files", "SELECT CAST(sample AS STRING) AS sample, tx, n, len FROM v_quant", "v_quant")
def quant_files(spark, d):
    path = new_folder(spark, "quant")
    _per_sample(spark, view(spark, d, "v_quant").select("tx", "n", "len", "sample"), "sample", path)
    return text.read_per_file(spark, path, "tx string, n bigint, len int", r"/sample=([^/]+)/")


@register("S11_junction_files", "SELECT CAST(sample AS STRING) AS sample, chrom, j_start, j_end, n FROM v_junctions", "v_junctions")
def junction_files(spark, d):
    path = new_folder(spark, "junctions")
    _per_sample(spark, view(spark, d, "v_junctions").select("chrom", "j_start", "j_end", "n", "sample"), "sample", path, False)
    return text.read_per_file(spark, path, "chrom string, j_start bigint, j_end bigint, n bigint", r"/sample=([^/]+)/", header=False)


@register("S13_frequencies_per_chromosome", "SELECT chrom, pos, ref, alt, af FROM v_af", "v_af")
def side_tables(spark, d):
    path = new_folder(spark, "frequencies")
    _per_sample(spark, view(spark, d, "v_af").select("pos", "ref", "alt", "af", "chrom"), "chrom", path)
    return text.read_per_file(spark, path, "pos bigint, ref string, alt string, af double", r"/chrom=([^/]+)/", "chrom")


@register("S15_event_counts", "SELECT event, sample, inc, skip, CASE WHEN event % 2 = 0 THEN 'SE' ELSE 'RI' END AS event_type FROM v_events", "v_events")
def event_counts(spark, d):
    path = new_folder(spark, "events")
    typed = view(spark, d, "v_events").drop("condition").withColumn("kind", F.when(F.col("event") % 2 == 0, "SE").otherwise("RI"))
    _per_sample(spark, typed.select("event", "sample", "inc", "skip", "kind"), "kind", path)
    return text.read_per_file(spark, path, "event bigint, sample int, inc bigint, skip bigint", r"/kind=([^/]+)/", "event_type")


SAMPLES = list(range(6))


def _vcf(spark, d):
    path = new_folder(spark, "vcf")
    rows = vcf.to_rows(view(spark, d, "v_geno"), SAMPLES)
    sinks.write_lines(rows, path, vcf.header_lines(SAMPLES))
    return path


@register("S06_vcf_genotypes", "SELECT concat('s', CAST(sample AS STRING)) AS sample, chrom, pos, ref, alt, gt, dp, COALESCE(gq, -1) AS gq FROM v_geno", "v_geno")
def vcf_genotypes(spark, d):
    read = vcf.read_genotypes(spark, _vcf(spark, d)).where("gt <> './.'")
    return read.select("sample", "chrom", "pos", "ref", "alt", "gt", "dp", F.coalesce("gq", F.lit(-1)).alias("gq"))


@register("S06_vcf_sites", "SELECT chrom, pos, ref, alt, MAX(qual) AS qual, CAST(SUM(dp) AS STRING) AS depth, 'PASS' AS filter FROM v_geno GROUP BY chrom, pos, ref, alt", "v_geno")
def vcf_sites(spark, d):
    sites = vcf.read_sites(spark, _vcf(spark, d))
    return sites.select("chrom", "pos", "ref", "alt", "qual", F.try_element_at("info", F.lit("DP")).alias("depth"), F.col("filter")[0].alias("filter"))


@register("K06_sorted_vcf", "SELECT chrom, pos, ref, alt, score AS qual FROM v_sites", "v_sites")
def sorted_vcf(spark, d):
    path = new_folder(spark, "vcf")
    sites = view(spark, d, "v_sites").select(
        "chrom", "pos", F.lit(".").alias("id"), "ref", "alt", F.col("score").alias("qual"), F.lit("PASS").alias("filter"), F.lit(".").alias("info")
    )
    sinks.write_sorted_vcf(sites, path, ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"], contig_ordinal(F.col("chrom"), CONTIG_ORDER))
    return vcf.read_sites(spark, path).select("chrom", "pos", "ref", "alt", "qual")


@register("S07_manifest", "SELECT concat('S', CAST(c_custkey AS STRING)) AS sample_id, concat('R', CAST(c_nationkey AS STRING)) AS run_id, c_mktsegment AS file_name FROM customer")
def manifest(spark, d):
    path = new_folder(spark, "manifest")
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("a"), F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("b"), F.col("c_mktsegment").alias("c")
    )
    sinks.write_lines(rows, path, ["sample run file", "------ --- ----"], "   ", footer=["", "(n rows affected)"])
    return text.read_manifest(spark, path, ["sample_id", "run_id", "file_name"], head=2, tail=2)


EXONS = "SELECT l_orderkey AS o, l_linenumber AS k, CAST(MAX(l_quantity) AS BIGINT) AS w FROM lineitem GROUP BY l_orderkey, l_linenumber"


@register(
    "S10_introns_from_exons",
    f"""WITH x AS ({EXONS}), e AS (SELECT concat('chr', CAST(o % 5 AS STRING)) AS chrom, concat('G', CAST(o % 97 AS STRING)) AS gene, concat('T', CAST(o AS STRING)) AS transcript,
 k * 100 AS s, k * 100 + 2 * w AS t FROM x), l AS (SELECT *, lead(s) OVER (PARTITION BY chrom, transcript ORDER BY s, t) AS nx FROM e)
SELECT chrom, gene, transcript, CAST(t AS BIGINT) AS j_start, CAST(nx AS BIGINT) AS j_end FROM l WHERE nx > t""",
)
def introns(spark, d):
    items = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("k")).agg(F.max("l_quantity").cast("bigint").alias("w"))
    rows = items.select(
        F.concat(F.lit("chr"), (F.col("o") % 5).cast("string")), F.lit("made"), F.lit("exon"),
        (F.col("k") * 100 + 1), (F.col("k") * 100 + 2 * F.col("w")), F.lit("."), F.lit("+"), F.lit("."),
        F.format_string('gene_id "G%d"; transcript_id "T%d";', F.col("o") % 97, F.col("o")),
    ).toDF(*[f"c{i}" for i in range(9)])
    path = new_folder(spark, "gtf")
    sinks.write_lines(rows, path, ["#!genome-build made"])
    return annotation.introns(annotation.read_features(spark, path)).select("chrom", "gene", "transcript", "j_start", "j_end")


@register(
    "S12_chain_blocks",
    """SELECT concat('chr', CAST(c_nationkey AS STRING)) AS chrom, c_custkey * 100 + b.o AS src_start, c_custkey * 100 + b.o + b.w AS src_end, 'chrQ' AS tgt_chrom,
 CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 200 + b.q ELSE 10000000 - (c_custkey * 200 + b.q) - b.w END AS tgt_start, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
 CAST(1000 AS BIGINT) AS score, CAST(c_custkey AS BIGINT) AS chain
 FROM customer, (VALUES (0, 0, 30), (35, 40, 20), (60, 60, 15)) AS b(o, q, w)""",
)
def chain_blocks(spark, d):
    people = table(spark, d, "customer")
    k = F.col("c_custkey")
    record = F.concat_ws(
        "\n",
        F.format_string(
            "chain 1000 chr%d 9999999 + %d %d chrQ 10000000 %s %d %d %d",
            F.col("c_nationkey"), k * 100, k * 100 + 75, F.when(k % 2 == 0, "+").otherwise("-"), k * 200, k * 200 + 75, k,
        ),
        F.lit("30 5 10"), F.lit("20 5 0"), F.lit("15"), F.lit(""),
    )
    path = new_folder(spark, "chain")
    people.select(record.alias("value")).write.text(path)
    return chain.read_chain(spark, path)


@register("K04_published_by_sample", "SELECT CAST(sample AS INT) AS sample, COUNT(*) AS n, CAST(SUM(dp) AS BIGINT) AS depth FROM v_geno GROUP BY sample", "v_geno")
def published(spark, d):
    path = new_folder(spark, "published")
    sinks.write_by(view(spark, d, "v_geno").withColumn("run_id", F.lit("r1")), path, "run_id", "sample")
    return spark.read.parquet(path).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.sum("dp").alias("depth"))


@register("K05_saved_experiment", "SELECT condition, COUNT(*) AS n, CAST(SUM(n) AS BIGINT) AS total FROM v_expr e JOIN v_cells c ON e.cell = c.cell GROUP BY condition", "v_expr v_cells")
def saved(spark, d):
    path = new_folder(spark, "experiment")
    sinks.save_experiment({"expr": view(spark, d, "v_expr"), "cells": view(spark, d, "v_cells")}, path)
    read = sinks.load_experiment(spark, path, ["expr", "cells"])
    return read["expr"].join(read["cells"], "cell").groupBy("condition").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total"))
