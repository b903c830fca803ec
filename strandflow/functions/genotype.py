"""Columns derived from alleles and genotype text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the 24 reported chromosomes, in report order.
CHROMOSOMES = [str(i) for i in range(1, 23)] + ["X", "Y"]
# Contig order for coordinate sorting.
CONTIG_ORDER = CHROMOSOMES + ["MT"]
# The base pairs that are transitions.
TRANSITIONS = ["AG", "GA", "CT", "TC"]


def alleles(gt: str = "gt") -> Column:
    return F.split(gt, r"[/|]")


def is_snp(ref: str = "ref", alt: str = "alt") -> Column:
    """One base in the reference and in every alternative allele."""
    return (F.length(ref) == 1) & ~F.col(alt).rlike("[^,]{2}")


def is_transition(ref: str = "ref", alt: str = "alt") -> Column:
    return F.concat(F.col(ref), F.col(alt)).isin(*TRANSITIONS)


def variant_type(ref: str = "ref", alt: str = "alt") -> Column:
    return F.when(is_snp(ref, alt), F.lit("SNP")).otherwise(F.lit("INDEL"))


def called(gt: str = "gt") -> Column:
    return ~F.col(gt).contains(".")


def is_het(gt: str = "gt") -> Column:
    a = alleles(gt)
    return called(gt) & (F.get(a, F.lit(0)) != F.get(a, F.lit(1)))


def is_hom_alt(gt: str = "gt") -> Column:
    a = alleles(gt)
    return called(gt) & (F.get(a, F.lit(0)) == F.get(a, F.lit(1))) & (F.get(a, F.lit(0)) != "0")


def is_het_ref(gt: str = "gt") -> Column:
    return is_het(gt) & F.array_contains(alleles(gt), "0")


def is_het_alt(gt: str = "gt") -> Column:
    return is_het(gt) & ~F.array_contains(alleles(gt), "0")


def dosage(gt: str = "gt") -> Column:
    """Alternative alleles carried (0, 1, 2); -1 for a missing genotype."""
    alt = F.size(F.filter(alleles(gt), lambda a: a != "0"))
    return F.when(called(gt), alt).otherwise(F.lit(-1)).cast("int")
