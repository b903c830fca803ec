"""Two-group differential expression with a negative-binomial model.

The order of work: size factors, dispersions by profile likelihood, their trend,
dispersions drawn towards the trend, a two-parameter fit per gene, outliers by
Cook's distance (replaced and fitted again, or left without p), Wald test, a cut of
low means that gives most rejections, adjusted p. Genes are fitted many at a time, one
row per gene; the sample table is one array.
"""

import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import incomplete_beta, two_sided_normal
from ..shared import materialised
from .bulk import adjusted_p, normalised_counts, sample_count, size_factors
from .ordered import exact_quantiles

MIN_DISPERSION = 1e-8
LN2 = math.log(2.0)


def gene_moments(normal: DataFrame) -> DataFrame:
    """Mean and variance of normalised counts over all samples, and the moment dispersion."""
    n = sample_count(normal)
    inverse = normal.select("sample", "size_factor").distinct().agg(F.avg(1 / F.col("size_factor")).alias("_x")).scalar()
    sums = normal.groupBy("gene").agg(
        F.sum("q").alias("_s"), F.sum(F.col("q") * F.col("q")).alias("_q")
    ).withColumns({"_n": n, "_x": inverse})
    mean = F.col("_s") / F.col("_n")
    var = F.greatest(F.try_divide(F.col("_q") - F.col("_n") * mean * mean, F.col("_n") - 1), F.lit(0.0))
    moments = sums.select("gene", mean.alias("base_mean"), var.alias("base_var"), "_x")
    raw = (F.col("base_var") - F.col("_x") * F.col("base_mean")) / (F.col("base_mean") * F.col("base_mean"))
    return moments.where(F.col("base_mean") > 0).select(
        "gene", "base_mean", "base_var", F.greatest(raw, F.lit(MIN_DISPERSION)).alias("disp_gene")
    )


def dispersion_trend(moments: DataFrame) -> tuple[float, float]:
    """(a0, a1) of dispersion = a0 + a1 / mean, a gamma regression on genes above the floor."""
    usable = moments.where(F.col("disp_gene") > 100 * MIN_DISPERSION).select(
        "disp_gene", (1 / F.col("base_mean")).alias("inv")
    )
    ready = VectorAssembler(inputCols=["inv"], outputCol="features").transform(usable)
    model = GeneralizedLinearRegression(
        family="gamma", link="identity", labelCol="disp_gene", featuresCol="features", maxIter=50
    ).fit(ready)
    a0, a1 = float(model.intercept), float(model.coefficients[0])
    if a0 <= 0:
        a0 = float(usable.agg(F.avg("disp_gene")).first()[0])
    return max(a0, MIN_DISPERSION), max(a1, 0.0)


def _trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total, x = total + 1 / (x * x), x + 1
    return total + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after small arguments were raised to eight and more."""
    at = np.array(x, float)
    flat = at.reshape(-1)
    small = np.flatnonzero(flat < 8)  # only these are raised
    raised, product = flat[small], np.ones(len(small))
    for _ in range(8):
        below = raised < 8
        product = np.where(below, product * raised, product)
        raised = raised + below
    flat[small] = raised
    inverse = 1 / at
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    out = (at - 0.5) * np.log(at) - at + 0.5 * math.log(2 * math.pi) + series
    out.reshape(-1)[small] -= np.log(product)
    return out


def _profile(counts, mu, patient, log_alpha):
    """Log likelihood of dispersions (genes x grid) at given means, with the adjustment for fitted group means."""
    out = np.zeros(log_alpha.shape)
    for column in range(log_alpha.shape[1]):
        alpha = np.exp(log_alpha[:, column])[:, None]
        r = 1 / alpha
        likely = _log_gamma(counts + r) - _log_gamma(r) - counts * np.log(mu + r) - r * np.log1p(mu * alpha)
        weights = mu / (1 + alpha * mu)
        held = sum(np.log(weights[:, patient == g].sum(axis=1)) for g in (0, 1))
        out[:, column] = likely.sum(axis=1) - held / 2
    return out


def _likeliest(counts, mu, patient, centre=None, spread=None, grid=17, rounds=5):
    """Dispersions of greatest profile likelihood, under a normal prior on their logarithm where one is given.

    All genes share a grid from 1e-8 to the larger of 10 and the number of samples; each
    round puts a finer one around every gene's best point.
    """
    low = np.full(len(counts), math.log(MIN_DISPERSION))
    high = np.full(len(counts), math.log(max(10.0, counts.shape[1])))
    for _ in range(rounds):
        points = low[:, None] + (high - low)[:, None] * np.linspace(0, 1, grid)
        score = _profile(counts, mu, patient, points)
        if centre is not None:
            score = score - (points - centre[:, None]) ** 2 / (2 * spread[:, None])
        best = score.argmax(axis=1)
        rows = np.arange(len(counts))
        low, high = points[rows, np.maximum(best - 1, 0)], points[rows, np.minimum(best + 1, grid - 1)]
    return np.exp(points[rows, best])


def _group_means(counts, factors, patient):
    q = counts / factors
    means = [np.maximum(q[:, patient == g].mean(axis=1), 0.5 / factors.mean()) for g in (0, 1)]
    return np.where(patient[None, :] == 1, means[1][:, None], means[0][:, None]) * factors


def prior_dispersions(genes: DataFrame, a0: float, a1: float, n_samples: int) -> DataFrame:
    """Genes with the trend, and centre, spread and own value of the prior on the log dispersion.

    The spread is the squared median deviation of log residuals less what sampling
    explains, 0.25 at least. `far` marks dispersions two deviations above the trend: those
    are not drawn to it.
    """
    sampling = _trigamma(max(n_samples - 2, 1) / 2.0)
    fitted = genes.withColumn("disp_trend", F.lit(a0) + F.lit(a1) / F.col("base_mean"))
    residual = F.log("disp_gene") - F.log("disp_trend")
    used = materialised(
        fitted.where(F.col("disp_gene") >= 100 * MIN_DISPERSION).select(residual.alias("r")), "residuals"
    )
    middle = exact_quantiles(used, [], "r", {"m": 0.5}).first()
    centre = middle["m"] if middle and middle["m"] is not None else 0.0
    wide = exact_quantiles(used.select(F.abs(F.col("r") - centre).alias("d")), [], "d", {"m": 0.5}).first()
    deviation = 1.4826 * (wide["m"] if wide and wide["m"] is not None else 0.0)
    prior = max(deviation**2 - sampling, 0.25)
    return fitted.withColumns(
        {"_centre": F.log("disp_trend"), "_spread": F.lit(prior), "_far": residual > 2 * deviation}
    )


#: Rounds after which a fit that still moves is reported as not converged.
MOST_ROUNDS = 500


def _fit_genes(counts, factors, patient, alpha):
    """Two-group fit for many genes at once: group logs, effect, error, means, leverages, whether it settled."""
    q = counts / factors
    mean = {g: np.maximum(q[:, patient == g].mean(axis=1), 1e-3) for g in (0, 1)}
    eta = {g: np.log(mean[g]) for g in (0, 1)}
    for _ in range(MOST_ROUNDS):
        mu = np.where(patient[None, :] == 1, np.exp(eta[1])[:, None], np.exp(eta[0])[:, None]) * factors
        weights = mu / (1 + alpha[:, None] * mu)
        moved = np.zeros(len(counts))
        for g in (0, 1):
            cols = patient == g
            move = (weights[:, cols] * (counts[:, cols] - mu[:, cols]) / mu[:, cols]).sum(axis=1)
            move = np.clip(move / weights[:, cols].sum(axis=1), -2, 2)
            after = np.clip(eta[g] + move, -12, 30)
            moved = np.maximum(moved, np.abs(after - eta[g]))
            eta[g] = after
        if moved.max(initial=0.0) < 1e-10:
            break
    mu = np.where(patient[None, :] == 1, np.exp(eta[1])[:, None], np.exp(eta[0])[:, None]) * factors
    weights = mu / (1 + alpha[:, None] * mu)
    total = {g: weights[:, patient == g].sum(axis=1) for g in (0, 1)}
    beta = eta[1] - eta[0]
    se = np.sqrt(1 / total[0] + 1 / total[1])
    leverage = weights / np.where(patient[None, :] == 1, total[1][:, None], total[0][:, None])
    return eta, beta, se, mu, leverage, moved < 1e-8


def f_quantile(p: float, d1: float, d2: float) -> float:
    """The value of the F distribution that a share p lies below, by bracketing its distribution function."""
    below = lambda x: float(incomplete_beta(np.array([d1 / 2]), np.array([d2 / 2]), np.array([d1 * x / (d1 * x + d2)]))[0])
    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


# For groups of up to so many samples, the share cut off at both ends and the factor that
# makes a trimmed mean of squares a variance.
TRIMS = [(3, 1 / 3, 2.04), (23, 1 / 4, 1.86), (math.inf, 1 / 8, 1.51)]


def _trimmed(values, share):
    """Row means without a share at both ends."""
    ordered = np.sort(values, axis=1)
    off = int(share * values.shape[1])
    return ordered[:, off : values.shape[1] - off].mean(axis=1)


def _robust_dispersion(counts, factors, patient):
    """Dispersion from trimmed variances (the larger of the groups'), so that one count cannot raise it; 0.04 at least."""
    q = counts / factors
    spread = np.zeros(len(q))
    for g in (0, 1):
        part = q[:, patient == g]
        share, factor = next((t, f) for most, t, f in TRIMS if part.shape[1] <= most)
        squares = (part - _trimmed(part, share)[:, None]) ** 2
        spread = np.maximum(spread, factor * _trimmed(squares, share))
    mean = np.maximum(q.mean(axis=1), 1e-8)
    return np.maximum((spread - mean) / mean**2, 0.04)


def _cooks(counts, factors, patient, mu, leverage):
    alpha = _robust_dispersion(counts, factors, patient)
    pearson2 = (counts - mu) ** 2 / (mu + alpha[:, None] * mu**2)
    return pearson2 / 2 * leverage / np.maximum(1 - leverage, 1e-9) ** 2


def _replaced(counts, factors, outlying):
    """Outlying counts as the trimmed mean of the gene's normalised counts (a fifth off each end) gives them."""
    usual = _trimmed(counts / factors, 0.2)
    return np.where(outlying, np.round(usual[:, None] * factors), counts)


def _shrink(beta: np.ndarray, se: np.ndarray, scale: float) -> np.ndarray:
    """Mode under a normal likelihood and a Cauchy prior of the given scale.

    The mode is the real root, between 0 and beta, of the cubic that sets the
    derivative to zero; bisection finds it for all genes together.
    """
    low, high = np.zeros_like(beta), np.abs(beta)
    for _ in range(80):
        mid = (low + high) / 2
        slope = (mid - np.abs(beta)) / se**2 + 2 * mid / (scale**2 + mid**2)
        low, high = np.where(slope < 0, mid, low), np.where(slope < 0, high, mid)
    return np.sign(beta) * (low + high) / 2


def fit_contrast(
    bulk: DataFrame, reference: str = "control", alpha: float = 0.1, replace_from: int = 7, flag_from: int = 3
) -> DataFrame:
    """Per gene: fit of the second group against `reference`, Wald test, adjusted p, Cook's distances.

    bulk: sample, condition, gene, n. One row per gene carries its counts (one
    entry per sample of the design); the sample table is one array value. Counts
    whose Cook's distance exceeds the 99 % F quantile are outliers: in groups of
    `replace_from` samples or more they are replaced and the gene is fitted again; otherwise
    a gene with one in a group of `flag_from` or more has no p. `converged` tells
    whether the fit had settled. `padj` counts only genes above the cut of
    `rejection_cut`; others have none. The counts are written once: all steps read them.
    """
    bulk = materialised(bulk.select("sample", "condition", "gene", "n"), "bulk")
    factors = size_factors(bulk)
    normal = normalised_counts(bulk, factors)
    moments = materialised(gene_moments(normal).select("gene", "base_mean"), "moments")
    sheet = bulk.select("sample", (F.col("condition") != reference).cast("int").alias("g")).distinct()
    n_samples = sheet.count()
    design = sheet.join(factors, "sample").agg(
        F.array_sort(F.collect_list(F.struct("sample", "g", "size_factor"))).alias("_d")
    )
    counts = bulk.groupBy("gene").agg(F.collect_list(F.struct("sample", "n")).alias("counts"))
    rows = materialised(moments.join(counts, "gene").withColumn("design", design.scalar()), "genes")
    gene_type = bulk.schema["gene"].dataType.simpleString()
    cut = f_quantile(0.99, 2, max(n_samples - 2, 1))

    def matrices(pdf):
        design = pdf["design"].iloc[0]
        place = {r["sample"]: i for i, r in enumerate(design)}
        matrix = np.zeros((len(pdf), len(place)))
        for row, entries in enumerate(pdf["counts"]):
            for e in entries:
                matrix[row, place[e["sample"]]] = e["n"]
        return matrix, np.array([r["size_factor"] for r in design]), np.array([r["g"] for r in design])

    def disperse(batches):
        for pdf in batches:
            if len(pdf):
                matrix, sizes, patient = matrices(pdf)
                yield pdf[["gene", "base_mean"]].assign(
                    disp_gene=_likeliest(matrix, _group_means(matrix, sizes, patient), patient)
                )

    own = materialised(rows.mapInPandas(disperse, f"gene {gene_type}, base_mean double, disp_gene double"), "dispersions")
    a0, a1 = dispersion_trend(own)
    tested = prior_dispersions(own, a0, a1, n_samples).join(rows.drop("base_mean"), "gene")

    def fit(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            matrix, sizes, patient = matrices(pdf)
            centre, spread = pdf["_centre"].to_numpy(), pdf["_spread"].to_numpy()
            far = pdf["_far"].to_numpy().astype(bool)
            many = np.array([(patient == g).sum() for g in patient])

            def once(values):
                drawn = _likeliest(values, _group_means(values, sizes, patient), patient, centre, spread)
                alpha = np.where(far, pdf["disp_gene"].to_numpy(), drawn)
                return alpha, *_fit_genes(values, sizes, patient, alpha)

            alpha, eta, beta, se, mu, leverage, settled = once(matrix)
            cooks = _cooks(matrix, sizes, patient, mu, leverage)
            outlying = (cooks > cut) & (matrix.sum(axis=1) > 0)[:, None]
            swapped = outlying & (many >= replace_from)
            again = swapped.any(axis=1)
            used = _replaced(matrix, sizes, swapped)
            if again.any():
                alpha, eta, beta, se, mu, leverage, settled = once(used)
            flagged = (outlying & ~swapped & (many >= flag_from)).any(axis=1)
            yield pdf[["gene", "base_mean", "disp_gene", "disp_trend"]].assign(
                dispersion=alpha, log_reference=eta[0], lfc=beta / LN2, lfc_se=se / LN2, stat=beta / se, cooks=list(cooks),
                outlier=flagged, replaced=again, converged=settled, used=list(used),
            )

    schema = (
        f"gene {gene_type}, base_mean double, disp_gene double, disp_trend double, dispersion double, log_reference double,"
        " lfc double, lfc_se double, stat double, cooks array<double>, outlier boolean, replaced boolean, converged boolean,"
        " used array<double>"
    )
    fitted = tested.mapInPandas(fit, schema)
    p = F.when(~F.col("outlier"), two_sided_normal("stat"))
    return filtered_p(materialised(fitted.withColumn("p", p), "fits"), alpha)


def rejection_cut(fitted: DataFrame, alpha: float = 0.1, steps: int = 50) -> DataFrame:
    """cut, rejected: for low-mean cuts at quantiles of base_mean up to 0.95, the genes with adjusted p below alpha.

    Every cut is one group of the step-up rule, all in one pass: a gene is copied to the
    cuts it survives, at most `steps` of them.
    """
    shares = {f"q{k}": 0.95 * k / (steps - 1) for k in range(steps)}
    cuts = exact_quantiles(fitted, [], "base_mean", shares)
    listed = cuts.select(F.array(*[F.struct(F.lit(k).alias("step"), F.col(f"q{k}").alias("cut")) for k in range(steps)]))
    survived = (
        fitted.where("p IS NOT NULL").select("gene", "p", "base_mean", F.explode(listed.scalar()).alias("c"))
        .where(F.col("base_mean") >= F.col("c.cut")).select("gene", "p", "c.step", "c.cut")
    )
    adjusted = adjusted_p(survived, ["step"])
    return adjusted.groupBy("step").agg(F.min("cut").alias("cut"), F.count_if(F.col("padj") < alpha).alias("rejected"))


def filtered_p(fitted: DataFrame, alpha: float = 0.1) -> DataFrame:
    """`padj` over genes whose base_mean reaches the lowest cut that gives the most rejections."""
    best = rejection_cut(fitted, alpha).orderBy(F.desc("rejected"), "step").first()
    cut = best["cut"] if best else 0.0
    shown = fitted.withColumn("_all", F.col("p")).withColumn("p", F.when(F.col("base_mean") >= cut, F.col("p")))
    out = adjusted_p(materialised(shown, "shown"))
    return out.withColumn("p", F.col("_all")).drop("_all")


def score_equations(fitted: DataFrame, bulk: DataFrame, reference: str = "control") -> DataFrame:
    """gene, g, score: the derivative of the log likelihood by each group's log mean, from the fitted values alone.

    Genes with replaced counts are left out: their counts are not those of bulk.
    """
    bulk = materialised(bulk.select("sample", "condition", "gene", "n"), "bulk")
    factors = size_factors(bulk)
    sheet = bulk.select("sample", (F.col("condition") != reference).cast("int").alias("g")).distinct().join(factors, "sample")
    listed = sheet.agg(F.collect_list(F.struct("sample", "g", "size_factor"))).scalar()
    grid = fitted.where("NOT replaced").select("gene", "log_reference", "lfc", "dispersion", F.explode(listed).alias("s"))
    every = grid.select("gene", "log_reference", "lfc", "dispersion", "s.*").join(
        bulk.select("gene", "sample", "n"), ["gene", "sample"], "left"
    )
    mu = F.exp(F.col("log_reference") + F.col("g") * F.col("lfc") * LN2) * F.col("size_factor")
    one = (F.coalesce("n", F.lit(0)) - mu) / (1 + F.col("dispersion") * mu)
    return every.groupBy("gene", "g").agg(F.sum(one).alias("score"))


def shrunken_changes(fitted: DataFrame) -> DataFrame:
    """Fold changes drawn to zero by a heavy-tailed prior whose scale is learnt from all genes."""
    scale2 = fitted.agg(
        F.greatest(F.avg(F.col("lfc") * F.col("lfc") - F.col("lfc_se") * F.col("lfc_se")), F.lit(1e-4)).alias("_s")
    ).scalar()
    sized = fitted.withColumn("_scale", F.sqrt(scale2))

    def shrink(batches):
        for pdf in batches:
            if len(pdf):
                out = _shrink(pdf["lfc"].to_numpy(), pdf["lfc_se"].to_numpy(), float(pdf["_scale"].iloc[0]))
                yield pdf[["gene", "lfc"]].assign(lfc_shrunk=out)

    gene_type = fitted.schema["gene"].dataType.simpleString()
    return sized.select("gene", "lfc", "lfc_se", "_scale").mapInPandas(
        shrink, f"gene {gene_type}, lfc double, lfc_shrunk double"
    )


def outlier_measures(fitted: DataFrame) -> DataFrame:
    """Log10 Cook's distance per gene and sample position."""
    return fitted.select("gene", F.posexplode("cooks").alias("sample_index", "cooks")).withColumn(
        "log10_cooks", F.when(F.col("cooks") > 0, F.log10("cooks"))
    )


def dispersion_table(fitted: DataFrame) -> DataFrame:
    return fitted.select("gene", "base_mean", "disp_gene", "disp_trend", "dispersion")


def trend_of(bulk: DataFrame) -> tuple[Column, Column]:
    """Trend coefficients of an experiment, for the variance-stabilising transform."""
    moments = gene_moments(normalised_counts(bulk, size_factors(bulk)))
    a0, a1 = dispersion_trend(materialised(moments, "moments"))
    return F.lit(a0), F.lit(a1)
