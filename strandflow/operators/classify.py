"""Variant classes from pooled sequence features and annotations."""

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax
from ..functions.missing import fill_zero
from ..functions.text import has_unknown_base, joined_key
from .evaluate import loss_and_accuracy

# Weights of classes 0, 1, 2 in training.
CLASS_WEIGHTS = [1.0, 10.0, 5.0]
# The twelve annotation columns used beside the sequence features.
ANNOTATIONS = [
    "pLI", "pNull", "pRec", "oe_mis", "oe_lof", "oe_mis_upper", "oe_lof_upper", "AF", "nhomalt",
    "GERPN", "GERPS", "phyloP",
]


def prepared_variants(variants: DataFrame) -> DataFrame:
    """Missing values become 0, a key is added, variants with unknown bases drop out."""
    filled = fill_zero(variants)
    keyed = filled.withColumn("varID", joined_key("_", "hg19_chr", "hg19_pos(1-based)", "ref", "alt"))
    return keyed.where(~has_unknown_base("WTSeq", "AltSeq"))


def with_vector(df: DataFrame, pooled: str, numeric: Sequence[str]) -> DataFrame:
    ready = df.withColumn("_pooled", array_to_vector(F.transform(pooled, lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=["_pooled", *numeric], outputCol="features").transform(ready).drop("_pooled")


def predictions(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    scored = model.transform(df).withColumn("p", vector_to_array("probability"))
    return scored.withColumn("yhat", argmax(F.col("p"))).drop("rawPrediction", "probability", "prediction")


def best_model(
    train: DataFrame,
    validation: DataFrame,
    strengths: Sequence[float] = (0.0, 0.01, 0.1),
    weights: Sequence[float] = tuple(CLASS_WEIGHTS),
    rounds: int = 50,
) -> LogisticRegressionModel:
    """Weighted multinomial model; of all candidates the one with the lowest validation loss.

    Both tables: features (vector), y (0..2). Training is Spark's distributed
    optimiser; only losses and coefficients reach the driver.
    """
    weighted = train.withColumn(
        "_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("y").cast("int"))
    ).select("features", F.col("y").cast("double").alias("label"), "_w")
    best, lowest = None, float("inf")
    for strength in strengths:
        model = LogisticRegression(
            family="multinomial", weightCol="_w", regParam=strength, maxIter=rounds
        ).fit(weighted)
        loss = loss_and_accuracy(predictions(model, validation)).first()["loss"]
        if loss < lowest:
            best, lowest = model, loss
    return best
