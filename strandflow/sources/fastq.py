"""FASTQ text as records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import numbered_lines


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Four-line records by line number, so a quality line may start with '@'."""
    lines = numbered_lines(spark, path)
    place = F.col("line_no") % 4
    records = lines.groupBy("file", F.floor(F.col("line_no") / 4).alias("record")).agg(
        *[F.max(F.when(place == i, F.col("value"))).alias(n) for i, n in ((0, "header"), (1, "seq"), (3, "qual"))]
    )
    head = F.regexp_extract("header", r"^@(\S+?)(?:/([12]))?(?:\s.*)?$", 1)
    mate = F.regexp_extract("header", r"^@(\S+?)(?:/([12]))?(?:\s.*)?$", 2)
    return records.select(
        "file", "record", head.alias("name"), mate.try_cast("int").alias("mate"), "seq", "qual"
    )
