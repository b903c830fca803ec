"""The training-data pipeline: every stage's rows are written as Parquet and read by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.llm import packing, quality, secret_scan, set_join
from strandflow.llm.texts import picked
from strandflow.shared import materialised

MASK = "[SECRET]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Verdicts are written first: a filter on them would be pushed down through all the
    columns they are computed from, each time with copies of what is below.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = materialised(quality.quality(docs, labels).select("row", "kept"), "judged")
    return judged.where("kept").select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id.

    Near copies share 80 % or more of their five-word shingles.
    Rows that repeat an id and its text stay once, the smallest by its columns; rows of one
    id with different texts all stay. Rows without id stay: they are in no class. An empty
    table gives an empty result.
    """
    classes = materialised(set_join.jaccard_classes(docs, n=5, percent=80), "classes")
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct()
    twice = classes.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialised(twice.select(F.col("doc_id").alias("id")), "twice")
    repeated = picked(docs, "doc_id", again).groupBy("doc_id", "text").agg(F.min(F.struct(*docs.columns)).alias("row"))
    once = repeated.select("row.*")
    return picked(docs, "doc_id", gone.unionByName(again), "left_anti").unionByName(once)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced by a mask."""
    found = secret_scan.secret_spans(docs, mask=MASK)
    chars = F.when(F.size("spans") > 0, F.length("clean").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("clean"), "n_chars": chars}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the sequences they are packed in."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("secret_redaction", secret_redaction),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express token ids, secrets' structure or packing; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
