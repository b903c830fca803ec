"""Filters, annotation and merging of call sets: one long table for all samples."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import is_het, is_hom_alt, variant_type
from ..functions.missing import drop_missing, ratio, to_number
from ..functions.text import joined_key, pieces
from .joins import overlap_join, spread_join
from .ordered import exact_quantiles

SITE = ["chrom", "pos", "ref", "alt"]
# Sensitivity tranches for the score filter, in percent.
SNP_TRANCHES = [99.95, 99.9, 99.5, 99.0, 98.0, 95.0]
INDEL_TRANCHES = [99.4, 99.2, 99.0, 98.0, 95.0]
# Pseudo-autosomal regions of X, build 37, 1-based inclusive.
PAR_X = [(60001, 2699520), (154931044, 155260560)]


def min_genotype_depth(geno: DataFrame, depth: int = 6) -> DataFrame:
    return geno.where(F.col("dp") >= depth)


def covered_sites(geno: DataFrame, depth: int = 6) -> DataFrame:
    """Genotypes of sites where at least one sample reaches the depth."""
    deep = geno.groupBy(*SITE).agg(F.max("dp").alias("_max")).where(F.col("_max") >= depth)
    return geno.join(deep.select(*SITE), SITE, "left_semi")


def without_tags(variants: DataFrame, tags: Sequence[str], col: str = "filter") -> DataFrame:
    """Drop variants that carry one of the failed-filter tags."""
    return variants.where(~F.arrays_overlap(F.col(col), F.array(*[F.lit(t) for t in tags])))


def annotate_frequency(variants: DataFrame, af: DataFrame, value: str = "af") -> DataFrame:
    """Left join of a frequency table by chrom, pos, ref, alt."""
    rest = [c for c, t in variants.dtypes if c not in SITE and not t.startswith("map")]
    return spread_join(variants, af.select(*SITE, value), SITE, rest or SITE, "left")


def exclude_known(variants: DataFrame, known: DataFrame) -> DataFrame:
    return variants.join(known.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_anti")


def in_truth(variants: DataFrame, *resources: DataFrame) -> DataFrame:
    """Variants found in any truth resource."""
    pool = resources[0].select(*SITE)
    for r in resources[1:]:
        pool = pool.unionByName(r.select(*SITE))
    return variants.join(pool.distinct(), SITE, "left_semi")


def in_intervals(variants: DataFrame, intervals: DataFrame, first: int = 1) -> DataFrame:
    """Variants whose reference allele touches any interval; each row is kept once.

    Intervals are half-open and count from 0; `first` is the number of the first base
    in `pos` (1 in call files).
    """
    bounds = intervals.select("chrom", "iv_start", "iv_end")
    placed = variants.withColumns(
        {"_start": F.col("pos") - first, "_end": F.col("pos") - first + F.length("ref")}
    )
    kept = overlap_join(placed, bounds, start="_start", end="_end", how="left_semi", spread_by=["pos", "alt"])
    return kept.drop("_start", "_end")


def merge_calls(geno: DataFrame) -> DataFrame:
    """One row per site over all samples; a site of a single sample stays.

    The list holds one entry per sample of the cohort that has the site, so
    its length is bounded by the cohort manifest.
    """
    return geno.groupBy(*SITE).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("sample", "gt"))),
                lambda s: F.concat(s["sample"].cast("string"), F.lit("="), s["gt"]),
            ),
            ";",
        ).alias("calls"),
    )


def tranche_tag(kind: str, low: float, high: float, key: str = "CNN_1D") -> str:
    return f"{key}_{kind}_Tranche_{low:.2f}_{high:.2f}"


def tranche_cutoffs(
    variants: DataFrame,
    truth: DataFrame,
    snp: Sequence[float] = tuple(SNP_TRANCHES),
    indel: Sequence[float] = tuple(INDEL_TRANCHES),
) -> DataFrame:
    """Per variant type and tranche t: the score that t percent of truth variants reach."""
    scored = in_truth(variants, truth).withColumn("var_type", variant_type())
    levels = {f"t{i}": 1 - t / 100 for i, t in enumerate(sorted({*snp, *indel}))}
    wanted = sorted({*snp, *indel})
    cuts = exact_quantiles(scored, ["var_type"], "score", levels)
    long = cuts.select(
        "var_type",
        F.explode(
            F.array(
                *[F.struct(F.lit(t).alias("tranche"), F.col(f"t{i}").alias("cutoff")) for i, t in enumerate(wanted)]
            )
        ).alias("c"),
    ).select("var_type", "c.tranche", "c.cutoff")
    of_snp = (F.col("var_type") == "SNP") & F.col("tranche").isin(*snp)
    of_indel = (F.col("var_type") == "INDEL") & F.col("tranche").isin(*indel)
    return long.where(of_snp | of_indel)


def label_tranches(variants: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Add the filter list: PASS, or the tranche the score falls into."""
    tables = cutoffs.groupBy("var_type").agg(
        F.array_sort(F.collect_list(F.struct("tranche", "cutoff"))).alias("_cuts")
    )  # two rows, at most one entry per tranche
    typed = variants.withColumn("var_type", variant_type()).join(F.broadcast(tables), "var_type", "left")
    passed = F.filter("_cuts", lambda c: F.col("score") >= c["cutoff"])
    above = F.get(passed, F.lit(0))["tranche"]
    below = F.element_at(F.filter("_cuts", lambda c: F.col("score") < c["cutoff"]), -1)["tranche"]
    lowest = F.get(F.col("_cuts"), F.lit(0))["tranche"]
    upper = F.coalesce(above, F.lit(100.0))
    tag = F.concat(
        F.lit("CNN_1D_"), F.col("var_type"), F.lit("_Tranche_"),
        F.format_string("%.2f", below), F.lit("_"), F.format_string("%.2f", upper),
    )
    passes = F.col("_cuts").isNull() | F.coalesce(above <= lowest, F.lit(False))
    return typed.withColumn("filter", F.array(F.when(passes, F.lit("PASS")).otherwise(tag))).drop("_cuts")


def on_x_outside(par: Sequence[tuple[int, int]] = tuple(PAR_X)) -> Column:
    """Calls on X outside the regions shared with Y."""
    outside = F.col("chrom") == "X"
    for start, end in par:
        outside = outside & ~F.col("pos").between(start, end)
    return outside


def sex_of(ratio_on_x: Column, male_max: float = 0.2, female_min: float = 0.4) -> Column:
    """M up to the first threshold, F from the second, U between or without data."""
    return F.when(ratio_on_x <= male_max, "M").when(ratio_on_x >= female_min, "F").otherwise("U")


def sex_calls(geno: DataFrame, male_max: float = 0.2, female_min: float = 0.4) -> DataFrame:
    """Sex per sample from heterozygous over homozygous-alternative calls on X."""
    x = on_x_outside()
    share = ratio(F.count_if(x & is_het()), F.count_if(x & is_hom_alt()))
    return geno.groupBy("sample").agg(sex_of(share, male_max, female_min).alias("sex"))


def allele_fraction(ref: Column, var: Column) -> Column:
    return ratio(var, ref + var)


def clonality_input(calls: DataFrame, packed: str = "fmt") -> DataFrame:
    """Mutation table for clonal analysis from packed GT:ref,alt:... text.

    Keeps sites whose allele fraction is none of 0, 0.5, 1; a row without a
    usable fraction is dropped as well.
    """
    _, depths = pieces(F.col(packed), ":", 2)
    ref, var = pieces(depths, ",", 2)
    counted = calls.withColumns({"ref_counts": to_number(ref), "var_counts": to_number(var)})
    af = allele_fraction(F.col("ref_counts"), F.col("var_counts"))
    kept = counted.where(~af.isin(0.0, 0.5, 1.0))
    return drop_missing(
        kept.select(
            joined_key(":", "chrom", "pos").alias("mutation_id"),
            "ref_counts",
            "var_counts",
            F.lit(2).alias("normal_cn"),
            F.lit(0).alias("minor_cn"),
            F.lit(2).alias("major_cn"),
        )
    )


def cohort_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-sample or per-chromosome results as one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
