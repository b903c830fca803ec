"""Bulk comparison of two groups, from quantification to ranked genes."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bulk, contrast
from ..shared import materialised


@dataclass
class ContrastResult:
    genes: DataFrame
    ranked: DataFrame
    shrunken: DataFrame
    distances: DataFrame
    summary: DataFrame


def compare_groups(quant: DataFrame, tx2gene: DataFrame, sheet: DataFrame, reference: str = "control") -> ContrastResult:
    """quant: sample, tx, n, len, tpm; sheet: sample, condition."""
    counts = bulk.gene_summary(quant, tx2gene).select("sample", "gene", F.round("n").cast("bigint").alias("n"))
    table = materialised(bulk.with_condition(counts, sheet), "counts")
    fitted = materialised(contrast.fit_contrast(table, reference), "contrast")
    normal = bulk.normalised_counts(table, bulk.size_factors(table))
    return ContrastResult(
        genes=bulk.ordered_by_p(fitted),
        ranked=bulk.rank_metric(fitted),
        shrunken=contrast.shrunken_changes(fitted),
        distances=bulk.sample_distances(bulk.log_counts(normal)),
        summary=bulk.significance_summary(fitted),
    )
