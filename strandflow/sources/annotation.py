"""Gene annotation text: exons, and introns from the gaps between exons."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import BUCKET, scan

WINDOW_BASES = 1 << 20


def _tag(name: str):
    return F.regexp_extract("attributes", rf'{name} "([^"]*)"', 1)


def read_features(spark: SparkSession, path: str, kind: str | None = "exon") -> DataFrame:
    """Half-open 0-based features with their gene and transcript."""
    rows = (
        spark.read.schema(
            "chrom string, source string, feature string, start bigint, end bigint, score string,"
            " strand string, frame string, attributes string"
        )
        .options(sep="\t", comment="#", quote="")
        .csv(path)
    )
    out = rows.select(
        "chrom", "feature", (F.col("start") - 1).alias("iv_start"), F.col("end").alias("iv_end"), "strand",
        _tag("gene_id").alias("gene"), _tag("transcript_id").alias("transcript"),
    )
    return out.where(F.col("feature") == kind).drop("feature") if kind else out


def introns(exons: DataFrame) -> DataFrame:
    """Gaps between consecutive exons of a transcript.

    The next start is a running minimum from the right over genome windows.
    """
    placed = exons.withColumn(BUCKET, F.floor(F.col("iv_start") / WINDOW_BASES))
    ahead = scan(
        placed, ["chrom", "transcript"], ["iv_start", "iv_end"], {"_next": ("min", "iv_start")},
        descending=True, inclusive=False,
    )
    return ahead.where(F.col("_next") > F.col("iv_end")).select(
        "chrom", "gene", "transcript", "strand", F.col("iv_end").alias("j_start"), F.col("_next").alias("j_end")
    )


def gene_bodies(exons: DataFrame) -> DataFrame:
    return exons.groupBy("chrom", "gene").agg(F.min("iv_start").alias("iv_start"), F.max("iv_end").alias("iv_end"))
