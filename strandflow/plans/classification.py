"""Variant classification: prepare, train, choose, and report on held-out sets."""

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify, evaluate
from ..operators.evaluate import BINARY_NAMES, CLASS_NAMES
from ..shared import materialised


@dataclass
class ClassifierResult:
    model: LogisticRegressionModel
    reports: DataFrame
    losses: DataFrame


def ready_variants(variants: DataFrame, pooled: DataFrame) -> DataFrame:
    """Cleaned variants of one table with their feature vector and label `y`."""
    clean = classify.prepared_variants(variants)
    joined = clean.join(pooled.withColumnRenamed("var_id", "varID"), "varID")
    vectors = classify.with_vector(joined, "pooled", classify.ANNOTATIONS)
    return vectors.select("varID", F.col("classLabel").cast("int").alias("y"), F.col("varType").alias("var_type"), "features")


def classify_variants(
    train: DataFrame, validation: DataFrame, held_out: dict[str, DataFrame], arrays: DataFrame, k: int = 32
) -> ClassifierResult:
    """Train on one table, choose by another, report on all by variant type and in two classes.

    arrays: var_id, allele, position, v for the variants of all tables.
    """
    pooled = materialised(evaluate.pooled_features(evaluate.paired_features(arrays, k), 2 * k), "pooled")
    fit, choose = ready_variants(train, pooled).persist(), ready_variants(validation, pooled).persist()
    try:
        model = classify.best_model(fit, choose)
    finally:
        fit.unpersist()
        choose.unpersist()
    reports, losses = None, None
    tables = {"training": train, "validation": validation, **held_out}
    for name, table in tables.items():
        pred = materialised(classify.predictions(model, ready_variants(table, pooled)).drop("features"), "predictions")
        three = evaluate.classification_report(pred, CLASS_NAMES)
        binary = pred.select(
            (F.col("y") > 0).cast("int").alias("y"),
            F.bround(F.lit(1.0) - F.get("p", F.lit(0)), 0).cast("int").alias("yhat"),
        )
        two = evaluate.classification_report(binary, BINARY_NAMES, None).withColumn("slice", F.lit("binary"))
        both = three.unionByName(two).withColumn("dataset", F.lit(name))
        loss = evaluate.loss_and_accuracy(pred).withColumn("dataset", F.lit(name))
        reports = both if reports is None else reports.unionByName(both)
        losses = loss if losses is None else losses.unionByName(loss)
    return ClassifierResult(model, reports, losses)
