"""Splicing: junction clusters, intron usage, exon inclusion."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import ratio
from ..functions.tails import chi2_tail
from ..functions.text import joined_key
from ..shared import materialised
from .graph import connected_components
from .joins import spread_join

MAX_INTRON = 500_000


def short_introns(junctions: DataFrame, longest: int = MAX_INTRON) -> DataFrame:
    return junctions.where(F.col("j_end") - F.col("j_start") <= longest)


def junction_clusters(junctions: DataFrame, min_reads: int = 50) -> DataFrame:
    """Introns that share a splice site, directly or through others, with enough reads.

    The graph joins introns to their two sites, so an n-fold shared site adds
    n edges, not n * n pairs. The cluster id is its smallest intron key.
    """
    introns = materialised(
        junctions.groupBy("chrom", "j_start", "j_end").agg(F.sum("n").alias("reads"))
        .withColumn("intron", joined_key(":", "chrom", "j_start", "j_end")),
        "introns",
    )
    sites = [F.concat(F.lit(f"~{side}:"), joined_key(":", "chrom", c)) for side, c in (("s", "j_start"), ("e", "j_end"))]
    edges = introns.select(F.col("intron").alias("src"), F.explode(F.array(*sites)).alias("dst"))
    parts = connected_components(edges)
    named = introns.join(
        parts.select(F.col("node").alias("intron"), F.col("component").alias("cluster")), "intron"
    )
    enough = named.groupBy("cluster").agg(F.sum("reads").alias("_r")).where(F.col("_r") >= min_reads)
    kept = spread_join(named, enough.select("cluster"), ["cluster"], ["intron"])
    return materialised(kept.select("chrom", "j_start", "j_end", "intron", "cluster", "reads"), "clusters")


def intron_usage(junctions: DataFrame, clusters: DataFrame, min_samples: int = 3) -> DataFrame:
    """Share of each intron in its cluster's reads per sample, introns of enough samples only."""
    keys = ["chrom", "j_start", "j_end"]
    rows = junctions.join(clusters.select(*keys, "intron", "cluster"), keys)
    common = rows.groupBy("intron").agg(F.count_distinct("sample").alias("_k")).where(F.col("_k") >= min_samples)
    kept = rows.join(common.select("intron"), "intron", "left_semi")
    totals = kept.groupBy("sample", "cluster").agg(F.sum("n").alias("total"))
    joined = spread_join(kept, totals, ["sample", "cluster"], ["intron"])
    usage = joined.select("sample", "cluster", "intron", "n", ratio(F.col("n"), F.col("total")).alias("usage"))
    return materialised(usage, "usage")


def outlier_introns(usage: DataFrame) -> DataFrame:
    """Usage minus the mean usage of the other samples that have the intron."""
    sums = usage.groupBy("intron").agg(F.sum("usage").alias("_s"), F.count(F.lit(1)).alias("_k"))
    joined = spread_join(usage, sums, ["intron"], ["sample"])
    others = F.try_divide(F.col("_s") - F.col("usage"), F.col("_k") - 1)
    return joined.select("sample", "cluster", "intron", (F.col("usage") - others).alias("effect"))


def cluster_differences(usage: DataFrame, sheet: DataFrame, with_p: bool = True) -> DataFrame:
    """Chi-square of pooled counts, condition by intron, per cluster."""
    pooled = materialised(
        usage.join(sheet, "sample").groupBy("cluster", "intron", "condition").agg(F.sum("n").alias("n")), "pooled"
    )
    cells = pooled.groupBy("cluster", "condition").agg(F.sum("n").alias("_c"))
    introns = pooled.groupBy("cluster", "intron").agg(F.sum("n").alias("_i"))
    total = pooled.groupBy("cluster").agg(F.sum("n").alias("_t"))
    counts = cells.groupBy("cluster").agg(F.count(F.lit(1)).alias("_nc"))
    # sum n^2 / expected - total, so combinations without reads need no row
    squares = (
        spread_join(pooled, cells, ["cluster", "condition"], ["intron"])
        .join(introns, ["cluster", "intron"])
        .groupBy("cluster")
        .agg(F.sum(F.col("n").cast("double") * F.col("n") / (F.col("_c").cast("double") * F.col("_i"))).alias("_q"), F.count_distinct("intron").alias("_ni"))
    )
    stats = squares.join(total, "cluster").join(counts, "cluster").select(
        "cluster",
        (F.col("_t") * (F.col("_q") - 1)).alias("chi2"),
        ((F.col("_ni") - 1) * (F.col("_nc") - 1)).alias("df"),
    )
    return stats.withColumn("p", chi2_tail(F.col("chi2"), F.col("df").cast("double"))) if with_p else stats


def joined_splice_results(significance: DataFrame, effects: DataFrame, genes: DataFrame) -> DataFrame:
    """Cluster tests with intron effects and the gene of each cluster."""
    return effects.join(significance, "cluster").join(genes.select("cluster", "gene"), "cluster", "left")


def inclusion_levels(events: DataFrame, inc_len: float = 2.0, skip_len: float = 1.0) -> DataFrame:
    """Length-normalised inclusion share per event and sample."""
    inc, skip = F.col("inc") / F.lit(inc_len), F.col("skip") / F.lit(skip_len)
    return events.withColumn("psi", ratio(inc, inc + skip))


def _log_likelihood(k: Column, n: Column) -> Column:
    """Binomial log likelihood at its maximum, 0 ln 0 = 0."""
    p = F.try_divide(k, n)
    hit = F.when(k > 0, k * F.log(p)).otherwise(F.lit(0.0))
    miss = F.when(n > k, (n - k) * F.log(F.lit(1.0) - p)).otherwise(F.lit(0.0))
    return hit + miss


def inclusion_differences(events: DataFrame, reference: str = "control", cutoff: float = 0.05, with_p: bool = True) -> DataFrame:
    """Mean inclusion of both groups, their difference, the call, and a likelihood-ratio test on pooled counts."""
    other = F.col("condition") != reference
    sums = inclusion_levels(events).groupBy("event").agg(
        F.avg(F.when(~other, F.col("psi"))).alias("psi_ref"),
        F.avg(F.when(other, F.col("psi"))).alias("psi_other"),
        *[
            F.sum(F.when(cond, F.col(c)).otherwise(0)).cast("double").alias(f"_{c}{g}")
            for g, cond in (("0", ~other), ("1", other))
            for c in ("inc", "skip")
        ],
    )
    n0, n1 = F.col("_inc0") + F.col("_skip0"), F.col("_inc1") + F.col("_skip1")
    full = _log_likelihood(F.col("_inc0"), n0) + _log_likelihood(F.col("_inc1"), n1)
    null = _log_likelihood(F.col("_inc0") + F.col("_inc1"), n0 + n1)
    stats = sums.select(
        "event", "psi_ref", "psi_other",
        (F.col("psi_other") - F.col("psi_ref")).alias("delta"),
        F.coalesce(F.abs(F.col("psi_other") - F.col("psi_ref")) > cutoff, F.lit(False)).alias("called"),
        F.greatest(F.lit(2.0) * (full - null), F.lit(0.0)).alias("lr"),
    )
    return stats.withColumn("p", chi2_tail(F.col("lr"), F.lit(1.0))) if with_p else stats


def annotated_events(events: DataFrame, annotation: DataFrame, kind: str) -> DataFrame:
    """Event counts with their annotation and event type."""
    return events.join(annotation, "event").withColumn("event_type", F.lit(kind))
