"""Sparse cell x gene counts: quality control, normalisation, gene selection.

Tables are long, `expr(cell, gene, n)` without zero rows; means, variances and
shares always use the full number of cells. Joins with one row per gene or per
sample are plain joins: Spark broadcasts these tables by their measured size,
and its skew handling splits hot partitions beyond that. Joins with one row per
cell go through `spread_join`.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import ratio
from ..shared import materialised
from .bulk import SAMPLE_BLOCK, sample_products
from .joins import hashed, spread_join
from .ordered import exact_quantiles


def count_of(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("_rows")).scalar()


def cell_totals(expr: DataFrame) -> DataFrame:
    return expr.groupBy("cell").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_genes"))


def floor_cells_and_genes(expr: DataFrame, min_genes: int = 200, min_cells: int = 3) -> DataFrame:
    """Cells with enough genes, then genes seen in enough of the kept cells."""
    rich = expr.groupBy("cell").count().where(F.col("count") >= min_genes).select("cell")
    kept = expr.join(hashed(rich, counted=False), "cell", "left_semi")
    common = kept.groupBy("gene").count().where(F.col("count") >= min_cells).select("gene")
    return kept.join(hashed(common, counted=False), "gene", "left_semi")


def flag_genes(genes: DataFrame, prefix: str = "MT-", name: str = "mt") -> DataFrame:
    return genes.withColumn(name, F.col("symbol").startswith(prefix))


def cell_qc(expr: DataFrame, cells: DataFrame, flagged: DataFrame) -> DataFrame:
    """Total counts, genes seen and percent in flagged genes; empty cells stay."""
    marked = expr.join(hashed(flagged.select("gene", F.lit(True).alias("_flag"))), "gene", "left")
    per_cell = marked.groupBy("cell").agg(
        F.sum("n").alias("total_counts"),
        F.count(F.lit(1)).alias("n_genes"),
        F.sum(F.when(F.col("_flag"), F.col("n")).otherwise(0)).alias("_flagged"),
    )
    return cells.select("cell").join(per_cell, "cell", "left").select(
        "cell",
        F.coalesce("total_counts", F.lit(0)).alias("total_counts"),
        F.coalesce("n_genes", F.lit(0)).alias("n_genes"),
        (F.lit(100.0) * ratio(F.col("_flagged"), F.col("total_counts"))).alias("pct_flagged"),
    )


def gene_qc(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells with the gene, total, mean over all cells, percent of cells without it."""
    n_cells = count_of(cells)
    seen = expr.groupBy("gene").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("n").alias("total"))
    return seen.withColumns(
        {
            "mean": ratio(F.col("total"), n_cells),
            "pct_dropout": F.lit(100.0) * (F.lit(1.0) - ratio(F.col("n_cells"), n_cells)),
        }
    )


def top_shares(expr: DataFrame, tops: Sequence[int] = (50, 100, 200, 500)) -> DataFrame:
    """Percent of counts in each cell's largest genes, and the log1p totals.

    `row_number <= k` lets Spark cut each cell to k rows before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("n"), "gene"))
    largest = expr.withColumn("_rank", rank).where(F.col("_rank") <= max(tops))
    sums = largest.groupBy("cell").agg(
        *[F.sum(F.when(F.col("_rank") <= k, F.col("n")).otherwise(0)).alias(f"_top{k}") for k in tops]
    )
    return cell_totals(expr).join(sums, "cell").select(
        "cell",
        *[(F.lit(100.0) * ratio(F.col(f"_top{k}"), F.col("total"))).alias(f"pct_top_{k}") for k in tops],
        F.log1p("total").alias("log1p_total_counts"),
        F.log1p("n_genes").alias("log1p_n_genes"),
    )


def with_totals(expr: DataFrame) -> DataFrame:
    """Counts with their cell's total; a cell with very many rows is sliced by gene."""
    return spread_join(expr, cell_totals(expr).select("cell", "total"), ["cell"], ["gene"])


def highest_expressed(expr: DataFrame, cells: DataFrame, top: int = 20) -> DataFrame:
    """Genes with the largest mean percent of a cell's counts over all cells."""
    share = with_totals(expr).groupBy("gene").agg(
        F.sum(F.lit(100.0) * ratio(F.col("n"), F.col("total"))).alias("_sum")
    )
    mean = share.select("gene", ratio(F.col("_sum"), count_of(cells)).alias("mean_percent"))
    return mean.orderBy(F.desc(F.round("mean_percent", 9)), "gene").limit(top)


def within_qc(qc: DataFrame, min_genes: int = 0, max_genes: int = 6000, max_pct: float = 20.0) -> DataFrame:
    """Strict bounds on genes seen and flagged percent."""
    return qc.where(
        (F.col("n_genes") > min_genes) & (F.col("n_genes") < max_genes) & (F.col("pct_flagged") < max_pct)
    )


def without_outliers(qc: DataFrame, by: str = "sample", width: float = 2.0, max_pct: float = 10.0) -> DataFrame:
    """Spots with a total within mean +/- width sample deviations, and a small flagged percent."""
    bounds = qc.groupBy(by).agg(
        F.avg("total_counts").alias("_mean"), F.stddev_samp("total_counts").alias("_sd")
    )
    near = F.col("total_counts").between(
        F.col("_mean") - F.lit(width) * F.col("_sd"), F.col("_mean") + F.lit(width) * F.col("_sd")
    )
    joined = qc.join(bounds, by)
    return joined.where(near & (F.col("pct_flagged") < max_pct)).drop("_mean", "_sd")


def listed_cells(cells: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Cells of a barcode list; a listed barcode that does not exist fails the job."""
    known = cells.withColumn("_found", F.lit(True))
    joined = barcodes.select("barcode").join(known, "barcode", "left")
    missing = F.raise_error(F.concat(F.lit("barcode not in the data: "), F.col("barcode")))
    checked = joined.withColumn("cell", F.when(F.col("_found"), F.col("cell")).otherwise(missing))
    return checked.select(*cells.columns)


def attach_labels(cells: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """External labels by barcode, never by position."""
    return cells.join(labels.select("barcode", name), "barcode", "left")


def normalised(expr: DataFrame, target: float | None = 1e4) -> DataFrame:
    """ln(1 + n / total * target); without a target, the median total is used."""
    if target is None:
        median = exact_quantiles(cell_totals(expr), [], "total", {"q": 0.5})
        goal = median.scalar()
    else:
        goal = F.lit(float(target))
    return with_totals(expr).select(
        "cell", "gene", F.log1p(ratio(F.col("n"), F.col("total")) * goal).alias("x")
    )


def gene_moments(x: DataFrame, cells: DataFrame, value: str = "x") -> DataFrame:
    """Mean and sample variance per gene over all cells, zeros included."""
    n = count_of(cells).cast("double")
    sums = x.groupBy("gene").agg(
        F.sum(F.col(value).cast("double")).alias("_s1"),
        F.sum(F.col(value).cast("double") * F.col(value)).alias("_s2"),
        F.count(F.lit(1)).alias("n_cells"),
    ).withColumn("_n", n)
    mean = F.col("_s1") / F.col("_n")
    var = F.greatest(F.try_divide(F.col("_s2") - F.col("_n") * mean * mean, F.col("_n") - 1), F.lit(0.0))
    return sums.select("gene", "n_cells", mean.alias("mean"), var.alias("var"))


def scaled(x: DataFrame, cells: DataFrame, max_value: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Clipped z-scores of the stored values, and each gene's z-score of zero.

    Together they are the dense matrix without writing its zero rows.
    """
    moments = gene_moments(x, cells).withColumn(
        "_sd", F.when(F.col("var") > 0, F.sqrt("var")).otherwise(F.lit(1.0))
    )
    z = F.least(F.lit(max_value), (F.col("x") - F.col("mean")) / F.col("_sd"))
    rows = x.join(moments.select("gene", "mean", "_sd"), "gene")
    zero = moments.select("gene", F.least(F.lit(max_value), -F.col("mean") / F.col("_sd")).alias("zero"))
    return rows.select("cell", "gene", z.alias("z")), zero


def dense(x: DataFrame, cells: DataFrame, per_gene: DataFrame, value: str) -> DataFrame:
    """Every cell with every gene of `per_gene`, missing values NULL.

    Only for a selected gene list: its rows travel as one array value.
    """
    listed = per_gene.agg(F.collect_list(F.struct(*per_gene.columns)).alias("_g")).scalar()
    grid = cells.select("cell").withColumn("_g", listed).select("cell", F.explode("_g").alias("_r"))
    return grid.select("cell", "_r.*").join(x.select("cell", "gene", value), ["cell", "gene"], "left")


def regression_fits(x: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Per gene the linear fit on two cell covariates, and the covariates around their means.

    Fits: gene, b0, b1, b2, and `ss`, the residuals' sum of squares over all cells; `_s` holds
    the sums that all genes share. Covariates: cell, _a, _b. One pass gives the cross products:
    zeros add nothing to sums with y. A gene without any value has no fit; its residuals are 0.
    """
    a, b = names
    means = covariates.agg(F.avg(a).alias("ma"), F.avg(b).alias("mb"), F.count(F.lit(1)).alias("n"))
    centred = covariates.withColumn("_m", means.select(F.struct("ma", "mb", "n").alias("s")).scalar()).select(
        "cell", (F.col(a) - F.col("_m.ma")).alias("_a"), (F.col(b) - F.col("_m.mb")).alias("_b"), F.col("_m.n").alias("_n")
    )
    centred = materialised(centred, "covariates")
    shared = centred.agg(
        F.struct(
            F.sum(F.col("_a") * F.col("_a")).alias("aa"),
            F.sum(F.col("_a") * F.col("_b")).alias("ab"),
            F.sum(F.col("_b") * F.col("_b")).alias("bb"),
            F.max("_n").alias("n"),
        ).alias("s")
    )
    chosen = x.join(genes.select("gene"), "gene", "left_semi")
    joined = spread_join(chosen, centred.select("cell", "_a", "_b"), ["cell"], ["gene"])
    sums = joined.groupBy("gene").agg(
        F.sum("x").alias("_y"),
        F.sum(F.col("x") * F.col("_a")).alias("_ya"),
        F.sum(F.col("x") * F.col("_b")).alias("_yb"),
        F.sum(F.col("x") * F.col("x")).alias("_yy"),
    ).withColumn("_s", shared.scalar())
    det = F.col("_s.aa") * F.col("_s.bb") - F.col("_s.ab") * F.col("_s.ab")
    fits = sums.select(
        "gene",
        (F.col("_y") / F.col("_s.n")).alias("b0"),
        (F.coalesce(F.try_divide(F.col("_ya") * F.col("_s.bb") - F.col("_yb") * F.col("_s.ab"), det), F.lit(0.0))).alias("b1"),
        (F.coalesce(F.try_divide(F.col("_yb") * F.col("_s.aa") - F.col("_ya") * F.col("_s.ab"), det), F.lit(0.0))).alias("b2"),
        "_yy", "_s",
    )
    explained = _explained(*([F.col(c) for c in ("b0", "b1", "b2")] * 2))
    fits = fits.withColumn("ss", F.greatest(F.col("_yy") - explained, F.lit(0.0))).drop("_yy")
    return fits, centred.select("cell", "_a", "_b")


def _explained(b0: Column, b1: Column, b2: Column, c0: Column, c1: Column, c2: Column) -> Column:
    """Sum over all cells of the product of two genes' fitted values."""
    s = F.col("_s")
    return s["n"] * b0 * c0 + s["aa"] * b1 * c1 + s["ab"] * (b1 * c2 + b2 * c1) + s["bb"] * b2 * c2


def _fitted() -> Column:
    return F.col("b0") + F.col("b1") * F.col("_a") + F.col("b2") * F.col("_b")


def regressed(x: DataFrame, cells: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Residuals of a short gene list after a linear fit on two cell covariates, zeros written out."""
    fits, centred = regression_fits(x, covariates, genes, names)
    full = dense(x, cells, fits.select("gene", "b0", "b1", "b2"), "x").join(centred, "cell")
    return full.select("cell", "gene", (F.coalesce("x", F.lit(0.0)) - _fitted()).alias("residual"))


def residual_rows(x: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Residuals of any number of genes, one row per stored value: cell, gene, residual, zero.

    The dense matrix is never written: a cell without the gene has minus the fitted value, which
    `regression_fits` gives by gene and cell. `zero` is that residual for this cell and gene.
    """
    fits, centred = regression_fits(x, covariates, genes, names)
    fits = materialised(fits.select("gene", "b0", "b1", "b2"), "fits")
    near = spread_join(x.select("cell", "gene", "x"), fits, ["gene"], ["cell"])
    return spread_join(near, centred, ["cell"], ["gene"]).select(
        "cell", "gene", (F.col("x") - _fitted()).alias("residual"), (-_fitted()).alias("zero")
    )


def residual_covariance(
    x: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str], block: int = SAMPLE_BLOCK
) -> DataFrame:
    """Covariance over all cells of the residuals of every two genes a <= b.

    Products of the stored values, in pairs of gene blocks, less what the fits explain: a
    formula of rank three, so that zeros cost nothing. Genes without any value have no rows.
    """
    fits, centred = regression_fits(x, covariates, genes, names)
    fits = materialised(fits.drop("ss"), "fits")
    stored = x.join(genes.select("gene"), "gene", "left_semi").join(centred.select("cell"), "cell", "left_semi")
    products = sample_products(stored.select(F.col("gene").alias("sample"), F.col("cell").alias("gene"), "x"), block)
    left = fits.select(F.col("gene").alias("a"), *[F.col(f"b{i}").alias(f"_l{i}") for i in range(3)], "_s")
    right = fits.select(F.col("gene").alias("b"), *[F.col(f"b{i}").alias(f"_r{i}") for i in range(3)])
    both = products.join(left, "a").join(right, "b")
    explained = _explained(*[F.col(f"_{side}{i}") for side in "lr" for i in range(3)])
    return both.select("a", "b", F.try_divide(F.col("dot") - explained, F.col("_s.n") - 1.0).alias("covariance"))


def residual_vectors(
    x: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str], max_value: float = 10.0
) -> tuple[DataFrame, list]:
    """(cell, v): per cell the residuals of the selected genes over their deviation, clipped above; and the genes.

    As long as the selected gene list, whose fits (five numbers a gene) reach the driver.
    Every cell of the covariates has a vector. A gene whose residuals are all equal has 0.
    """
    fits, centred = regression_fits(x, covariates, genes, names)
    wide = F.try_divide(F.col("ss"), F.col("_s.n") - 1.0)
    listed = fits.select("gene", "b0", "b1", "b2", F.sqrt(wide).alias("sd")).orderBy("gene").collect()
    order = [r["gene"] for r in listed]
    numbers = np.array([[r["b0"], r["b1"], r["b2"], r["sd"] or 0.0] for r in listed], dtype="float64").reshape(-1, 4)
    size = np.abs(numbers[:, :3]).max(axis=1, initial=0.0)
    scale = np.where(numbers[:, 3] > 1e-9 * size, 1.0 / np.maximum(numbers[:, 3], 1e-300), 0.0)
    places = x.sparkSession.createDataFrame(
        [(g, i) for i, g in enumerate(order)], f"gene {x.schema['gene'].dataType.simpleString()}, _i int"
    )
    lists = x.join(F.broadcast(places), "gene").groupBy("cell").agg(F.collect_list(F.struct("_i", "x")).alias("_l"))

    @F.pandas_udf("array<double>")
    def fill(place: pd.Series, values: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for p, v, one, two in zip(place, values, a, b):
            row = -(numbers[:, 0] + numbers[:, 1] * one + numbers[:, 2] * two)
            if p is not None:
                np.add.at(row, np.asarray(p, dtype="int64"), np.asarray(v, dtype="float64"))
            out.append(np.minimum(row * scale, max_value))
        return pd.Series(out)

    every = centred.join(lists, "cell", "left")
    known = [F.coalesce(c, F.lit(0.0)) for c in ("_a", "_b")]
    return every.select("cell", fill(F.col("_l._i"), F.col("_l.x"), *known).alias("v")), order


def dispersion_scores(x: DataFrame, cells: DataFrame, bins: int = 20) -> DataFrame:
    """Log dispersion per gene as a z-score inside its mean-expression bin.

    x: logged values; moments are taken on the unlogged scale. Bins are equal
    in width, closed on the right; a bin of one gene gives the score 1.
    """
    linear = x.select("cell", "gene", F.expm1("x").alias("x"))
    base = materialised(
        gene_moments(linear, cells).select(
            "gene",
            F.log1p("mean").alias("mean"),
            F.when(F.col("var") > 0, F.log(F.col("var") / F.col("mean"))).alias("dispersion"),
        ),
        "dispersions",
    )
    span = base.agg(F.struct(F.min("mean").alias("lo"), F.max("mean").alias("hi")).alias("s")).scalar()
    width = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(bins))
    place = F.ceil(F.try_divide(F.col("mean") - F.col("_s.lo"), width))
    binned = base.withColumn("_s", span).withColumn(
        "bin", F.coalesce(F.least(F.greatest(place, F.lit(1)), F.lit(bins)), F.lit(1)).cast("int")
    ).drop("_s")
    spread = binned.groupBy("bin").agg(F.avg("dispersion").alias("_m"), F.stddev_samp("dispersion").alias("_sd"))
    joined = binned.join(F.broadcast(spread), "bin")  # at most `bins` rows
    alone = F.col("_sd").isNull()
    score = F.when(alone, F.lit(1.0)).otherwise(
        F.try_divide(F.col("dispersion") - F.col("_m"), F.col("_sd"))
    )
    return joined.select("gene", "mean", "dispersion", "bin", F.when(F.col("dispersion").isNotNull(), score).alias("score"))


def variable_by_cutoff(scores: DataFrame, min_mean=0.0125, max_mean=3.0, min_disp=0.5) -> DataFrame:
    return scores.where(
        (F.col("mean") > min_mean) & (F.col("mean") < max_mean) & (F.col("score") > min_disp)
    )


def top_genes(scores: DataFrame, value: str, n: int = 2000) -> DataFrame:
    """The n largest values overall, ties by gene; one ordered take."""
    return scores.where(F.col(value).isNotNull()).orderBy(F.desc(value), "gene").limit(n)


def stabilised_variance(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Variance of clipped standardised counts per gene.

    The expected variance is a quadratic fit of log10 variance on log10 mean,
    solved from one row of power sums.
    """
    moments = gene_moments(expr, cells, "n").where(F.col("var") > 0)
    logs = materialised(
        moments.select("gene", "mean", "n_cells", F.log10("mean").alias("u"), F.log10("var").alias("v")), "moments"
    )
    centre = logs.agg(F.avg("u").alias("c")).scalar()
    centred = logs.withColumn("u", F.col("u") - centre)
    u, v = F.col("u"), F.col("v")
    sums = centred.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("s0"), F.sum(u).alias("s1"), F.sum(u * u).alias("s2"),
            F.sum(u * u * u).alias("s3"), F.sum(u * u * u * u).alias("s4"),
            F.sum(v).alias("t0"), F.sum(u * v).alias("t1"), F.sum(u * u * v).alias("t2"),
        ).alias("s")
    ).scalar()
    s = {k: F.col(f"_s.{k}") for k in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")}
    rows = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
    solved = solve3([[s[c] for c in r] for r in rows], [s["t0"], s["t1"], s["t2"]])
    fitted = centred.withColumn("_s", sums).withColumns({f"_c{i}": c for i, c in enumerate(solved)})
    n = count_of(cells).cast("double")
    per_gene = fitted.select(
        "gene", "mean", "n_cells", n.alias("_n"),
        F.sqrt(F.pow(F.lit(10.0), F.col("_c0") + F.col("_c1") * u + F.col("_c2") * u * u)).alias("sd"),
    )
    joined = expr.join(per_gene.select("gene", "mean", "sd", "_n"), "gene")
    z = F.least((F.col("n") - F.col("mean")) / F.col("sd"), F.sqrt("_n"))
    squares = joined.groupBy("gene").agg(F.sum(z * z).alias("_z2"))
    zero = F.col("mean") / F.col("sd")
    return per_gene.join(squares, "gene").select(
        "gene",
        "mean",
        F.try_divide(F.col("_z2") + (F.col("_n") - F.col("n_cells")) * zero * zero, F.col("_n") - 1).alias("variance"),
    )


def solve3(m: list[list[Column]], b: list[Column]) -> list[Column]:
    """Solution of a 3x3 system by determinants."""

    def det(a):
        return (
            a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1])
            - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
            + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0])
        )

    out = []
    for i in range(3):
        swapped = [[b[r] if c == i else m[r][c] for c in range(3)] for r in range(3)]
        out.append(F.try_divide(det(swapped), det(m)))
    return out


def display_clip(x: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Values clipped per gene to quantiles of its non-zero cells."""
    cuts = exact_quantiles(x, ["gene"], "x", {"_lo": low, "_hi": high})
    joined = x.join(cuts, "gene")
    return joined.select("cell", "gene", F.least(F.greatest("x", "_lo"), F.col("_hi")).alias("x"))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Number of rows after each stage."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("stage"), F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram between minimum and maximum."""
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s")).scalar()
    width = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col(value) - F.col("_s.lo"), width))
    binned = df.where(F.col(value).isNotNull()).select(value).withColumn("_s", span).select(
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
