"""Bulk expression: gene summaries, size factors, transforms, adjusted p values."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import drop_missing, float_division
from ..functions.text import without_version
from ..shared import materialised
from .joins import spread_join
from .ordered import BUCKET, average_ranks, exact_quantiles, global_index, scan, value_counts


def nonzero_length(df: DataFrame, col: str = "len") -> DataFrame:
    """A length of zero becomes 1."""
    return df.withColumn(col, F.when(F.col(col) == 0, F.lit(1)).otherwise(F.col(col)))


def to_genes(quant: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Transcript rows with their gene; version suffixes are ignored on both sides."""
    mapping = tx2gene.select(without_version(F.col("tx")).alias("tx_base"), "gene").distinct()
    versioned = quant.withColumn("tx_base", without_version(F.col("tx")))
    return versioned.join(mapping, "tx_base")


def gene_summary(quant: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Counts and abundance summed per (sample, gene), length weighted by abundance."""
    rows = nonzero_length(to_genes(quant, tx2gene))
    return rows.groupBy("sample", "gene").agg(
        F.sum("n").alias("n"),
        F.sum("tpm").alias("tpm"),
        F.coalesce(
            F.try_divide(F.sum(F.col("tpm") * F.col("len")), F.sum("tpm")), F.avg(F.col("len").cast("double"))
        ).alias("len"),
    )


def size_factors(bulk: DataFrame) -> DataFrame:
    """Median-of-ratios factor per sample over genes counted in every sample."""
    n_samples = bulk.select("sample").distinct().agg(F.count(F.lit(1)).alias("_n")).scalar()
    positive = bulk.where(F.col("n") > 0)
    everywhere = positive.groupBy("gene").agg(
        F.avg(F.log("n")).alias("_ref"), F.count(F.lit(1)).alias("_k")
    ).where(F.col("_k") == n_samples)
    logs = positive.join(everywhere.select("gene", "_ref"), "gene").select(
        "sample", (F.log("n") - F.col("_ref")).alias("_r")
    )
    medians = exact_quantiles(logs, ["sample"], "_r", {"_m": 0.5})
    return materialised(medians.select("sample", F.exp("_m").alias("size_factor")), "factors")


def normalised_counts(bulk: DataFrame, factors: DataFrame) -> DataFrame:
    return bulk.join(factors, "sample").withColumn("q", F.col("n") / F.col("size_factor"))


def sample_count(bulk: DataFrame) -> Column:
    return bulk.select("sample").distinct().agg(F.count(F.lit(1)).cast("double").alias("_n")).scalar()


def top_by_mean(normal: DataFrame, n: int = 20) -> DataFrame:
    """Genes with the largest mean over all samples."""
    sums = normal.groupBy("gene").agg(F.sum("q").alias("_s"))
    means = sums.select("gene", (F.col("_s") / sample_count(normal)).alias("mean"))
    return means.orderBy(F.desc(F.round("mean", 6)), "gene").limit(n)


def log_counts(normal: DataFrame) -> DataFrame:
    return normal.select("sample", "gene", F.log2(F.col("q") + 1).alias("x"))


def stabilised_counts(normal: DataFrame, a0: Column, a1: Column) -> DataFrame:
    """Variance-stabilised values for the dispersion trend a0 + a1 / mean."""
    q = F.col("q")
    inner = F.lit(1.0) + a1 + F.lit(2.0) * a0 * q + F.lit(2.0) * F.sqrt(a0 * q * (F.lit(1.0) + a1 + a0 * q))
    return normal.select("sample", "gene", F.log2(inner / (F.lit(4.0) * a0)).alias("x"))


def mean_sd(x: DataFrame) -> DataFrame:
    """Mean and deviation per gene over all samples (absent = 0) with the rank of the mean."""
    sums = x.groupBy("gene").agg(F.sum("x").alias("_s"), F.sum(F.col("x") * F.col("x")).alias("_q"))
    n = sums.withColumn("_n", sample_count(x))
    mean = F.col("_s") / F.col("_n")
    moments = n.select(
        "gene",
        mean.alias("mean"),
        F.sqrt(F.greatest(F.try_divide(F.col("_q") - F.col("_n") * mean * mean, F.col("_n") - 1), F.lit(0.0))).alias("sd"),
        F.round(mean, 9).alias("_key"),
    )
    moments = materialised(moments, "moments")
    ranks = average_ranks(moments, [], "_key").select("_key", "rank")
    return spread_join(moments, ranks, ["_key"], ["gene"]).select("gene", "mean", "sd", "rank")


#: Samples per side of a product matrix (8 MiB of doubles), genes multiplied at a time.
SAMPLE_BLOCK = 1024
GENES_AT_ONCE = 512


def sample_products(x: DataFrame, block: int = SAMPLE_BLOCK, slices: int | None = None) -> DataFrame:
    """Columns a, b, dot: sum over genes of x(a) * x(b) for every two samples a <= b; a missing value is zero.

    Samples are numbered and cut into blocks. A task holds one pair of blocks and one slice of
    the genes, so it adds up one block x block matrix whatever the number of samples, streaming
    its genes; every value is copied once per block of samples. Genes are sliced just as far as
    the block pairs alone do not occupy the shuffle's tasks (a single block: one slice per task).
    Rows without sample, gene or value count as missing; repeated (sample, gene) rows add up.
    """
    spark = x.sparkSession
    kind = x.schema["sample"].dataType.simpleString()
    rows = x.dropna(subset=["sample", "gene", "x"]).groupBy("sample", "gene").agg(F.sum("x").cast("double").alias("x"))
    names = materialised(global_index(rows.select("sample").distinct(), "sample", "at"), "samples")
    n = names.count()
    n_blocks = -(-n // block)
    pairs = n_blocks * (n_blocks + 1) // 2
    if slices is None:
        slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(pairs, 1)))

    numbered = rows.join(names, "sample").withColumn("_own", F.floor(F.col("at") / block).cast("int"))
    met = numbered.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks - 1, 0)))))
    placed = met.select(
        F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
        F.pmod(F.xxhash64("gene"), F.lit(slices)).cast("int").alias("slice"),
        F.xxhash64("gene").alias("gene_hash"), F.col("gene"),
        F.col("_own").alias("own"), F.pmod("at", F.lit(block)).cast("int").alias("place"), "x",
    )

    def products(batches):
        total, key, held = None, None, None
        for pdf in batches:
            keys = pdf[["i", "j", "slice"]].to_numpy()
            bounds = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *bounds], [*bounds, len(keys)]):
                if lo == hi:
                    continue
                if key != tuple(keys[lo]):
                    if key is not None:
                        total += _product(held, key, block)
                        yield from _pairs_of(total, key, block, n)
                    key, total, held = tuple(keys[lo]), np.zeros((block, block)), None
                part = pdf.iloc[lo:hi] if held is None else pd.concat([held, pdf.iloc[lo:hi]], ignore_index=True)
                # the last gene may go on in the next batch
                going_on = (part["gene"] == part["gene"].iloc[-1]).to_numpy()
                total += _product(part[~going_on], key, block)
                held = part[going_on]
        if key is not None:
            total += _product(held, key, block)
            yield from _pairs_of(total, key, block, n)

    spread = placed.repartition("i", "j", "slice").sortWithinPartitions("i", "j", "slice", "gene_hash", "gene")
    dots = spread.mapInPandas(products, "a_at bigint, b_at bigint, dot double").groupBy("a_at", "b_at").agg(F.sum("dot").alias("dot"))
    first = names.select(F.col("at").alias("a_at"), F.col("sample").cast(kind).alias("a"))
    second = names.select(F.col("at").alias("b_at"), F.col("sample").cast(kind).alias("b"))
    return dots.join(first, "a_at").join(second, "b_at").select("a", "b", "dot")


def _product(rows: pd.DataFrame, key: tuple, block: int) -> np.ndarray | float:
    """One task's whole genes as a block x block product, some genes at a time."""
    i, j, _ = key
    total = 0.0
    if not len(rows):
        return total
    genes, own = rows["gene"].to_numpy(), rows["own"].to_numpy()
    place, values = rows["place"].to_numpy(), rows["x"].to_numpy()
    number = np.concatenate([[0], np.cumsum(genes[1:] != genes[:-1])])
    for start in range(0, number[-1] + 1, GENES_AT_ONCE):
        lo, hi = np.searchsorted(number, [start, start + GENES_AT_ONCE])
        height = number[hi - 1] - start + 1
        sides = []
        for side in (i, j):
            here = np.flatnonzero(own[lo:hi] == side) + lo
            dense = np.zeros((height, block))
            dense[number[here] - start, place[here]] = values[here]
            sides.append(dense)
        total = total + sides[0].T @ sides[1]
    return total


def _pairs_of(total: np.ndarray, key: tuple, block: int, n: int):
    """Products of a block pair, row by row of its matrix; samples a <= b, numbered below n."""
    i, j, _ = key
    for row in range(min(block, n - i * block)):
        here = np.arange(row if i == j else 0, min(block, n - j * block))
        yield pd.DataFrame({"a_at": np.full(len(here), i * block + row), "b_at": j * block + here, "dot": total[row, here]})


def sample_distances(x: DataFrame, block: int = SAMPLE_BLOCK) -> DataFrame:
    """Euclidean distance between every two samples a < b that have a value (see `sample_products`)."""
    dots = materialised(sample_products(x, block), "products")
    norms = dots.where(F.col("a") == F.col("b"))
    return (
        dots.where(F.col("a") != F.col("b"))
        .join(norms.select("a", F.col("dot").alias("_aa")), "a")
        .join(norms.select("b", F.col("dot").alias("_bb")), "b")
        .select("a", "b", F.sqrt(F.greatest(F.col("_aa") + F.col("_bb") - 2 * F.col("dot"), F.lit(0.0))).alias("distance"))
    )


def adjusted_p(results: DataFrame, group: list[str] = [], p: str = "p", key: str = "gene") -> DataFrame:
    """Add Benjamini-Hochberg `padj`; rows without p keep none and do not count.

    Works on distinct p values with their counts: rank = running count upward,
    then the running minimum of p * n / rank downward, both over value ranges.
    """
    tested = results.where(F.col(p).isNotNull() & ~F.isnan(p))
    counted = value_counts(tested, group, p)
    ranked = scan(counted, group, [p], {"_rank": ("sum", "t")})
    sizes = counted.groupBy(*group).agg(F.sum("t").alias("_n"))
    sized = ranked.join(sizes, group) if group else ranked.withColumn("_n", sizes.scalar())
    scores = materialised(
        sized.select(*group, p, BUCKET, (F.col(p) * F.col("_n") / F.col("_rank")).alias("_score")), "scores"
    )
    lowest = scan(scores, group, [p], {"_low": ("min", "_score")}, descending=True).select(
        *group, F.col(p).alias("_p"), F.least(F.lit(1.0), "_low").alias("padj")
    )
    keyed = results.withColumn("_p", F.col(p))
    return spread_join(keyed, lowest, [*group, "_p"], [key], "left").drop("_p")


def significance_summary(results: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Genes significant up and down at alpha, and genes without adjusted p."""
    hit = F.col("padj") < alpha
    return results.agg(
        F.count_if(hit).alias("significant"),
        F.count_if(hit & (F.col("lfc") > 0)).alias("up"),
        F.count_if(hit & (F.col("lfc") < 0)).alias("down"),
        F.count_if(F.col("padj").isNull()).alias("missing"),
    )


def rank_metric(results: DataFrame, name: str = "gene") -> DataFrame:
    """-log10(p) over the sign of the change; no change gives an infinity, which stays."""
    size = F.when(F.col("p") == 0, F.lit(float("inf"))).otherwise(-F.log10("p"))
    metric = float_division(size, F.signum("lfc"))
    return drop_missing(results.select(name, metric.alias("metric")))


def ordered_by_p(results: DataFrame) -> DataFrame:
    """Smallest p first, missing p last (a range-partitioned sort)."""
    return results.orderBy(F.asc_nulls_last("p"), "gene")


def best_gene_counts(results: DataFrame, normal: DataFrame) -> DataFrame:
    """Normalised counts + 0.5 of the gene with the smallest adjusted p."""
    best = results.where(F.col("padj").isNotNull()).agg(F.min(F.struct("padj", "gene")).alias("_b"))
    chosen = best.select(F.col("_b.gene").alias("gene"))  # one row
    return normal.join(F.broadcast(chosen), "gene", "left_semi").select(
        "gene", "sample", (F.col("q") + F.lit(0.5)).alias("count")
    )


def with_condition(df: DataFrame, sheet: DataFrame) -> DataFrame:
    """Rows with their sample's group from the sample sheet."""
    return df.join(sheet, "sample")


