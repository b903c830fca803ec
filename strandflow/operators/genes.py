"""Gene names: unique labels and mappings between identifiers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import BUCKET, ranged, scan


def unique_names(genes: DataFrame, name: str = "symbol", order: str = "gene") -> DataFrame:
    """Repeated names get -1, -2, ... in feature order, the first one stays."""
    ones = ranged(genes.withColumn("_one", F.lit(1).cast("bigint")), [name], [order])
    counted = scan(ones, [name], [order], {"_k": ("sum", "_one")}, inclusive=False)
    suffix = F.concat(F.col(name), F.lit("-"), F.col("_k").cast("string"))
    return counted.withColumn(
        "unique_name", F.when(F.col("_k") == 0, F.col(name)).otherwise(suffix)
    ).drop("_one", "_k", BUCKET)


def map_genes(ids: DataFrame, to_symbol: DataFrame, to_other: DataFrame) -> DataFrame:
    """Gene id to symbol to the other species' symbol, unique pairs; one-to-many is kept.

    Pairs are made distinct before the second join, so repeated symbols do not multiply.
    """
    symbols = ids.select("gene").distinct().join(to_symbol, "gene").select("symbol").distinct()
    return symbols.join(to_other.distinct(), "symbol").select("symbol", "other").distinct()
