"""Matrix-market directories as long counts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hashed
from .text import numbered_lines


def read_names(spark: SparkSession, path: str, column: int = 0) -> DataFrame:
    """One tab-separated field per line with the 1-based line number over all parts."""
    lines = numbered_lines(spark, path, per_file=False)
    return lines.select(
        (F.col("line_no") + 1).alias("idx"), F.get(F.split("value", "\t"), F.lit(column)).alias("name")
    )


def read_matrix_market(spark: SparkSession, matrix: str, barcodes: str, features: str, symbol_column: int = 1) -> DataFrame:
    """Counts as (barcode, gene index, symbol, n); comment lines and the size line drop out."""
    lines = numbered_lines(spark, matrix, per_file=False).where(~F.col("value").startswith("%"))
    size_line = lines.agg(F.min("line_no").alias("_s")).scalar()
    parts = F.split(F.trim("value"), r"\s+")
    entries = lines.where(F.col("line_no") > size_line).select(
        F.get(parts, F.lit(0)).cast("bigint").alias("gene"),
        F.get(parts, F.lit(1)).cast("bigint").alias("cell"),
        F.get(parts, F.lit(2)).cast("double").alias("n"),
    ).where(F.col("n") != 0)
    genes = read_names(spark, features, symbol_column).select(F.col("idx").alias("gene"), F.col("name").alias("symbol"))
    cells = read_names(spark, barcodes).select(F.col("idx").alias("cell"), F.col("name").alias("barcode"))
    return entries.join(hashed(genes), "gene").join(hashed(cells), "cell").select("cell", "barcode", "gene", "symbol", "n")
