"""Per-sample call quality: whole genome and each chromosome, in one scan."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genotype import (
    CHROMOSOMES, is_het, is_het_alt, is_het_ref, is_hom_alt, is_snp, is_transition,
)
from ..functions.missing import number_or_zero, ratio
from .variants import on_x_outside, sex_of


def _one(condition: Column) -> Column:
    return F.sum(condition.cast("bigint"))


def call_totals(geno: DataFrame) -> DataFrame:
    """Additive totals per (sample, chrom): the only pass over the calls."""
    return geno.groupBy("sample", "chrom").agg(
        F.count(F.lit(1)).alias("n"),
        _one(is_snp() & is_transition()).alias("ts"),
        _one(is_snp() & ~is_transition()).alias("tv"),
        _one(is_snp()).alias("snps"),
        _one(~is_snp()).alias("indels"),
        F.count("dp").alias("dp_n"),
        F.sum(F.col("dp").cast("bigint")).alias("dp_sum"),
        F.sum(number_or_zero(F.col("qual"))).alias("qual_sum"),
        F.sum(number_or_zero(F.col("gq"))).alias("gq_sum"),
        _one(is_het_ref()).alias("het_ra"),
        _one(is_het_alt()).alias("het_aa"),
        _one(is_hom_alt()).alias("hom_aa"),
        _one(on_x_outside() & is_het()).alias("x_het"),
        _one(on_x_outside() & is_hom_alt()).alias("x_hom"),
    )


TOTALS = [
    "n", "ts", "tv", "snps", "indels", "dp_n", "dp_sum", "qual_sum", "gq_sum", "het_ra", "het_aa", "hom_aa",
    "x_het", "x_hom",
]


def quality_measures() -> dict[str, Column]:
    """Report columns from the additive totals; a missing value counts as 0 in two means."""
    return {
        "tstv": ratio(F.col("ts"), F.col("tv")),
        "num_snps": F.col("snps"),
        "num_indels": F.col("indels"),
        "avg_depth": ratio(F.col("dp_sum"), F.col("dp_n")),
        "avg_quality": ratio(F.col("qual_sum"), F.col("n")),
        "het_hom_ratio": ratio(F.col("het_ra") + F.col("het_aa"), F.col("hom_aa")),
        "mean_gq": ratio(F.col("gq_sum"), F.col("n")),
    }


def sample_measures(geno: DataFrame) -> DataFrame:
    totals = call_totals(geno).groupBy("sample").agg(*[F.sum(c).alias(c) for c in TOTALS])
    return totals.select("sample", *[c.alias(n) for n, c in quality_measures().items()])


def call_report(geno: DataFrame, chromosomes: Sequence[str] = tuple(CHROMOSOMES)) -> DataFrame:
    """One `Genome` row per sample over all contigs, one row per listed chromosome with calls.

    The calls are read once. Grouping sets and sex run over the per-chromosome
    totals, a few dozen rows per sample.
    """
    totals = call_totals(geno)
    both = totals.groupingSets([["sample"], ["sample", "chrom"]], "sample", "chrom").agg(
        F.grouping("chrom").alias("_all"), *[F.sum(c).alias(c) for c in TOTALS]
    )
    whole = Window.partitionBy("sample")
    on_x = F.max(F.when(F.col("_all") == 1, ratio(F.col("x_het"), F.col("x_hom")))).over(whole)
    listed = both.withColumn("sex", sex_of(on_x)).where(
        (F.col("_all") == 1) | F.col("chrom").isin(*chromosomes)
    )
    return listed.select(
        "sample",
        F.when(F.col("_all") == 1, "Genome").otherwise(F.col("chrom")).alias("chr"),
        *[c.alias(n) for n, c in quality_measures().items()],
        "sex",
    )


# Column names of the written report.
REPORT_HEADER = [
    "fileName", "sampleName", "Chr", "TSTV", "numSNPs", "numINDELs", "avgDepth", "avgQuality",
    "HeterozygousHomozygousRatio", "meanGQ", "Gender",
]


def report_text(report: DataFrame, file_name: str) -> DataFrame:
    """The report as text columns under the written names; a missing value is NA."""
    cols = ["sample", "chr", "tstv", "num_snps", "num_indels", "avg_depth", "avg_quality", "het_hom_ratio", "mean_gq", "sex"]
    return report.select(
        F.lit(file_name).alias("fileName"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(n) for c, n in zip(cols, REPORT_HEADER[1:])],
    )
