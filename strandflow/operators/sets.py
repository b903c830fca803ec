"""Presence tables: intersections, set sizes, set algebra."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-missing becomes 1, missing 0."""
    return df.withColumns({c: F.col(c).isNotNull().cast("int") for c in cols})


def exclusive_intersections(flags: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per exact combination of sets, most frequent first."""
    counted = flags.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), *cols)


def set_sizes(flags: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Members per set, plain and on log scales; all sets in one pass."""
    sums = flags.agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
    long = sums.unpivot([], list(cols), "set_name", "size")
    return long.withColumns({"log2_size": F.log2("size"), "log10_size": F.log10("size")})


def common_members(flags: DataFrame, a: str, b: str, key: str = "id") -> DataFrame:
    return flags.where(F.col(a) == 1).select(key).intersect(flags.where(F.col(b) == 1).select(key))


def only_members(flags: DataFrame, a: str, b: str, key: str = "id") -> DataFrame:
    return flags.where(F.col(a) == 1).select(key).exceptAll(flags.where(F.col(b) == 1).select(key)).distinct()
