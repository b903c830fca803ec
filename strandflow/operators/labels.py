"""Cell labels from reference profiles, from a linear model, and by majority."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialised
from .joins import spread_join
from .ordered import average_ranks


def _centred_ranks(values: DataFrame, key: list[str], n_genes) -> tuple[DataFrame, DataFrame]:
    """Per key and gene the rank above the zero block's rank, and per key its sum of squares.

    Ranks run over all genes; absent genes share the lowest average rank.
    """
    sizes = values.groupBy(*key).agg(F.count(F.lit(1)).alias("_nz")).withColumn("_g", n_genes)
    ranks = average_ranks(values, key, "x").join(sizes, key)
    n0 = F.col("_g") - F.col("_nz")
    placed = ranks.select(
        *key, "x", "t", (F.col("rank") + n0).alias("rank"), ((n0 + 1) / F.lit(2.0)).alias("zero"), n0.alias("_n0")
    )
    squares = placed.groupBy(*key).agg(
        F.sum(F.col("t") * F.col("rank") * F.col("rank")).alias("_sq"),
        F.max("zero").alias("zero"),
        F.max("_n0").alias("_n0"),
    ).select(*key, (F.col("_sq") + F.col("_n0") * F.col("zero") * F.col("zero")).alias("sq"), "zero")
    above = placed.select(*key, "x", (F.col("rank") - F.col("zero")).alias("d"))
    return spread_join(values, above, [*key, "x"], ["gene"]).select(*key, "gene", "d"), squares


def profile_correlations(cells: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rank correlation of every cell with every reference profile over the reference's genes.

    cells: cell, gene, x > 0; profiles: label, profile, gene, x > 0. With ranks
    taken relative to the zero block, only genes present on both sides meet.
    """
    profiles = materialised(profiles.select("label", "profile", "gene", "x"), "profiles")
    genes = profiles.select("gene").distinct()
    n_genes = genes.agg(F.count(F.lit(1)).alias("_n")).scalar()
    known = materialised(cells.join(genes, "gene", "left_semi").select("cell", "gene", "x"), "cells")
    mine, my_sq = _centred_ranks(known, ["cell"], n_genes)
    theirs, their_sq = _centred_ranks(profiles, ["label", "profile"], n_genes)
    met = spread_join(mine, theirs.withColumnRenamed("d", "e"), ["gene"], ["cell"])
    dots = met.groupBy("cell", "label", "profile").agg(F.sum(F.col("d") * F.col("e")).alias("dot"))
    # one value per reference profile; the reference is a bounded list
    listed = their_sq.agg(
        F.collect_list(F.struct("label", "profile", F.col("sq").alias("sq2"), F.col("zero").alias("zero2"))).alias("p")
    ).scalar()
    pairs = my_sq.withColumn("_p", listed).select("cell", "sq", "zero", F.explode("_p").alias("_r")).select(
        "cell", "sq", "zero", "_r.*"
    )
    g = n_genes.cast("double")
    full = pairs.join(dots, ["cell", "label", "profile"], "left").withColumn("_g", g)
    g = F.col("_g")
    total = g * (g + 1) / F.lit(2.0)
    product = (
        F.coalesce("dot", F.lit(0.0)) + (F.col("zero") + F.col("zero2")) * total - g * F.col("zero") * F.col("zero2")
    )
    mean2 = total * total / g
    return full.select(
        "cell", "label", "profile",
        F.try_divide(product - mean2, F.sqrt((F.col("sq") - mean2) * (F.col("sq2") - mean2))).alias("corr"),
    )


def reference_labels(cells: DataFrame, profiles: DataFrame, quantile: float = 0.8) -> DataFrame:
    """Best label per cell: the largest quantile of its profiles' correlations."""
    scores = profile_correlations(cells, profiles).groupBy("cell", "label").agg(
        F.percentile("corr", quantile).alias("score")
    )
    return best_label(scores)


def best_label(scores: DataFrame) -> DataFrame:
    """Label with the highest score per cell; the smaller label wins a tie."""
    best = scores.groupBy("cell").agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("label"))).alias("_b")
    )
    return best.select("cell", F.col("_b.label").alias("label"), (-F.col("_b.s")).alias("score"))


def model_scores(x: DataFrame, weights: DataFrame, intercept: float = 0.0) -> DataFrame:
    """Logistic score per cell and label of a given linear model (label, gene, w)."""
    sums = x.join(weights, "gene").groupBy("cell", "label").agg(
        F.sum(F.col("x") * F.col("w")).alias("_s")
    )
    return sums.select(
        "cell", "label", (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_s") + F.lit(intercept))))).alias("score")
    )


def majority_labels(cells: DataFrame, group: str, label: str) -> DataFrame:
    """Most frequent label per group; the smaller label wins a tie."""
    counted = cells.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(group).agg(
        F.min(F.struct((-F.col("n")).alias("a"), F.col(label).alias("l"))).alias("_b")
    )
    return best.select(group, F.col("_b.l").alias("majority"), (-F.col("_b.a")).alias("n"))
