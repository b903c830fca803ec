"""Cohort calls from end to end: one table for all samples, no per-sample loop."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import dosage
from ..operators import callreport, homozygosity, variants
from ..shared import materialised

FAILED_TAGS = [variants.tranche_tag("SNP", 99.95, 100), variants.tranche_tag("INDEL", 99.4, 100)]


@dataclass
class CohortResult:
    labelled: DataFrame
    regions: DataFrame
    merged: DataFrame
    report: DataFrame
    dosages: DataFrame


def analyse_cohort(
    geno: DataFrame, truth: DataFrame, af: DataFrame, intervals: DataFrame, min_depth: int = 6, min_region: int = 5000
) -> CohortResult:
    """Depth and interval filters, score tranches, homozygous regions, merged calls, report, dosages.

    geno: sample, chrom, pos, ref, alt, gt, dp, gq, qual (qual is the score).
    """
    called = materialised(variants.in_intervals(geno, intervals), "calls")
    deep = variants.min_genotype_depth(called, min_depth)
    sites = deep.groupBy(*variants.SITE).agg(F.max("qual").alias("score"))
    labelled = materialised(variants.label_tranches(sites, variants.tranche_cutoffs(sites, truth)), "labels")
    passing = variants.without_tags(labelled, FAILED_TAGS).select(*variants.SITE)
    kept = materialised(variants.annotate_frequency(deep.join(passing, variants.SITE, "left_semi"), af), "kept")
    regions = homozygosity.long_regions(homozygosity.homozygous_runs(kept), min_region)
    cohort = materialised(variants.covered_sites(called, min_depth), "cohort")
    return CohortResult(
        labelled=labelled,
        regions=regions,
        merged=variants.merge_calls(cohort),
        report=callreport.call_report(cohort),
        dosages=cohort.select("sample", *variants.SITE, dosage().alias("dosage")),
    )
