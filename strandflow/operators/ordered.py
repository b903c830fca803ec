"""Running totals, ranks and quantiles that never sort one group in one task.

A plain window over a whole group puts the group in one task. Here the rows are
range-partitioned by (group, order) first and remember their range: a window
runs inside each (group, range), the ranges' totals (a few rows per group) are
added up, and every row gets its range's offset. A group with a third of all
rows is spread over a third of the ranges; small groups stay in one.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialised

BUCKET = "_bucket"


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df as a table in (group, order) ranges, with each row's range number.

    Spark's range partitioner picks the bounds and the adaptive planner the
    number of ranges. Writing the table fixes the numbers for all readers, on
    re-run tasks too. Rows should be unique by (group, order): callers merge
    equal values first, so that one frequent value is one row.
    """
    keys = [*group, *order]
    numbered = df.repartitionByRange(*keys).withColumn(BUCKET, F.spark_partition_id())
    return materialised(numbered, "ranges")


def scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    descending: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Running sum, min or max of columns per group in order.

    `measures` maps an output name to (kind, column). df carries `_bucket`, a
    number that never decreases along the order. The row itself is left out
    where `inclusive` is off.
    """
    kinds = {"sum": F.sum, "min": F.min, "max": F.max}
    direct = F.desc if descending else F.asc
    keys = [*group, BUCKET]
    inside = (
        Window.partitionBy(*keys)
        .orderBy(*[direct(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    before = (
        Window.partitionBy(*group).orderBy(direct(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = df.groupBy(*keys).agg(
        *[kinds[kind](col).alias(f"_t_{name}") for name, (kind, col) in measures.items()]
    )
    offsets = totals.select(
        *keys,
        *[kinds[kind](f"_t_{name}").over(before).alias(f"_o_{name}") for name, (kind, _) in measures.items()],
    )
    out = df.join(offsets, keys)
    for name, (kind, col) in measures.items():
        here = kinds[kind](col).over(inside)
        offset = F.col(f"_o_{name}")
        if kind == "sum":
            total = F.coalesce(offset, F.lit(0)) + F.coalesce(here, F.lit(0))
        elif kind == "min":
            total = F.least(offset, here)
        else:
            total = F.greatest(offset, here)
        out = out.withColumn(name, total)
    return out.drop(*[f"_o_{name}" for name in measures])


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their number of rows `t`, in ranges."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("t"))
    return ranged(counted, group, [value])


def average_ranks(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with count `t` and average rank `rank` (ties share it)."""
    ranked = scan(value_counts(df, group, value), group, [value], {"upto": ("sum", "t")})
    return ranked.withColumn("rank", F.col("upto") - (F.col("t") - 1) / F.lit(2.0)).drop("upto", BUCKET)


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of `probs`."""
    counted = value_counts(df, group, value)
    placed = scan(counted, group, [value], {"upto": ("sum", "t")})
    sizes = counted.groupBy(*group).agg(F.sum("t").alias("_n"))
    if group:
        placed = placed.join(sizes, list(group))
    else:
        placed = placed.withColumn("_n", sizes.scalar())
    first, last = F.col("upto") - F.col("t"), F.col("upto") - 1
    parts = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            parts.append(
                F.max(F.when(index.between(first, last), F.col(value))).alias(f"_{side}_{name}")
            )
    found = placed.groupBy(*group).agg(F.max("_n").alias("_n"), *parts)
    out = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (at - F.floor(at)) * (high - low)).cast("double").alias(name))
    return found.select(*group, *out)


def global_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """0-based position of every row by a unique key."""
    ones = ranged(df.withColumn("_one", F.lit(1).cast("bigint")), [], [key])
    return scan(ones, [], [key], {name: ("sum", "_one")}, inclusive=False).drop("_one", BUCKET)
