"""Model evaluation: classification reports, loss, batches, paired features."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import paired
from ..functions.missing import ratio
from .ordered import global_index

# Names of the three classes, by label.
CLASS_NAMES = ["Benign", "Dominant", "Recessive"]
BINARY_NAMES = ["Benign", "Pathogenic"]


def classification_report(
    pred: DataFrame, names: Sequence[str] = tuple(CLASS_NAMES), slice_by: str | None = "var_type"
) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy and averages.

    One pass counts (slice, y, yhat); the whole set and the slices come from
    grouping sets over those few counts. A zero denominator gives 0.
    """
    keys = [slice_by] if slice_by else []
    counts = pred.groupBy(*keys, "y", "yhat").agg(F.count(F.lit(1)).alias("n"))
    measures = []
    for i in range(len(names)):
        hit, true, said = (F.col("y") == i) & (F.col("yhat") == i), F.col("y") == i, F.col("yhat") == i
        for m, cond in (("tp", hit), ("true", true), ("said", said)):
            measures.append(F.sum(F.when(cond, F.col("n")).otherwise(0)).alias(f"{m}{i}"))
    measures.append(F.sum("n").alias("total"))
    if slice_by:
        wide = counts.groupingSets([[], [slice_by]], slice_by).agg(F.grouping(slice_by).alias("_all"), *measures)
        wide = wide.withColumn("slice", F.when(F.col("_all") == 1, "all").otherwise(F.col(slice_by)))
    else:
        wide = counts.agg(*measures).withColumn("slice", F.lit("all"))
    rows, parts = [], []
    for i, name in enumerate(names):
        p = F.coalesce(ratio(F.col(f"tp{i}"), F.col(f"said{i}")), F.lit(0.0))
        r = F.coalesce(ratio(F.col(f"tp{i}"), F.col(f"true{i}")), F.lit(0.0))
        f = F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), F.lit(0.0))
        parts.append((p, r, f, F.col(f"true{i}")))
        rows.append(_row(F.lit(name), p, r, f, F.col(f"true{i}")))
    total = F.col("total")
    accuracy = ratio(sum((F.col(f"tp{i}") for i in range(1, len(names))), F.col("tp0")), total)
    rows.append(_row(F.lit("accuracy"), accuracy, accuracy, accuracy, total))
    k = float(len(names))
    macro = [sum((x[j] for x in parts[1:]), parts[0][j]) / F.lit(k) for j in range(3)]
    rows.append(_row(F.lit("macro avg"), *macro, total))
    weighted = [
        F.coalesce(ratio(sum((x[j] * x[3] for x in parts[1:]), parts[0][j] * parts[0][3]), total), F.lit(0.0))
        for j in range(3)
    ]
    rows.append(_row(F.lit("weighted avg"), *weighted, total))
    return wide.select("slice", F.explode(F.array(*rows)).alias("r")).select("slice", "r.*")


def _row(label: Column, p: Column, r: Column, f: Column, support: Column) -> Column:
    return F.struct(
        label.alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
        support.cast("bigint").alias("support"),
    )


def loss_and_accuracy(pred: DataFrame, probs: str = "p") -> DataFrame:
    """Mean cross entropy (probabilities clipped at 1e-7) and share of right classes."""
    chosen = F.least(F.greatest(F.get(F.col(probs), F.col("y")), F.lit(1e-7)), F.lit(1 - 1e-7))
    return pred.agg(
        F.avg(-F.log(chosen)).alias("loss"),
        F.avg((F.col("y") == F.col("yhat")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def batches(ids: DataFrame, key: str = "id", size: int = 64, epoch: int | None = None) -> DataFrame:
    """Batch number of every row; the last batch may be short.

    With an epoch the order is a seeded hash of the key, a new order per epoch.
    """
    if epoch is None:
        indexed = global_index(ids, key, "position")
    else:
        hashed = ids.withColumn("_h", F.xxhash64(F.lit(epoch), F.col(key)))
        indexed = global_index(hashed, "_h", "position").drop("_h")
    return indexed.withColumn("batch", F.floor(F.col("position") / size))


def paired_features(vectors: DataFrame, k: int = 32) -> DataFrame:
    """Wild-type and alternative vectors of a variant side by side, per position.

    vectors: var_id, allele ('WT' or 'Alt'), position, v.
    """
    wt = vectors.where("allele = 'WT'").select("var_id", "position", F.col("v").alias("_wt"))
    alt = vectors.where("allele = 'Alt'").select("var_id", "position", F.col("v").alias("_alt"))
    joined = wt.join(alt, ["var_id", "position"])
    return joined.select("var_id", "position", paired(F.col("_wt"), F.col("_alt"), k).alias("v"))


def pooled_features(features: DataFrame, width: int) -> DataFrame:
    """Maximum over positions of every feature, back as one array per variant.

    One aggregate per feature keeps partial maxima on the map side; nothing is exploded.
    """
    maxima = features.groupBy("var_id").agg(*[F.max(F.get("v", F.lit(i))).alias(f"_m{i}") for i in range(width)])
    return maxima.select("var_id", F.array(*[F.col(f"_m{i}") for i in range(width)]).alias("pooled"))
