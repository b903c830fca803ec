"""Joins that survive one key with a third of all rows, and coordinate joins."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_WIDTH = 1 << 14


SHARE = 0.01
SALTS = 64

#: More copies of intervals than this are never broadcast: with 64 slices for hot bins, some 640,000 rows at most are.
BROADCAST_COPIES = 10_000


def _hot_sketch(fact: DataFrame, on: Sequence[str], share: float) -> DataFrame:
    """One row: hashes of the keys that hold more than `share` of the rows (at most 1/share)."""
    limit = int(1 / share)
    return fact.agg(
        F.struct(
            F.call_function("approx_top_k", F.xxhash64(*on), F.lit(limit), F.lit(100 * limit)).alias("top"),
            F.count(F.lit(1)).alias("n"),
        ).alias("s")
    ).select(
        F.transform(
            F.filter("s.top", lambda t: t["count"] > F.col("s.n") * share), lambda t: t["item"]
        ).alias("hot")
    )


def hot_keys(fact: DataFrame, on: Sequence[str], share: float = SHARE) -> list[int]:
    """Hashes of the hot keys, for a fact table that is joined many times."""
    return list(_hot_sketch(fact, list(on), share).first()["hot"] or [])


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    extra: Callable[[], Column] | None = None,
    hot: list[int] | None = None,
    large: bool = False,
) -> DataFrame:
    """Join fact to dim, cutting the fact rows of hot keys into slices.

    A key is hot when it holds more than a hundredth of the fact rows; one pass
    with a mergeable frequency sketch finds the hot keys (at most a hundred, one
    scalar array), so nothing is shuffled or broadcast for it. Only the dim
    rows of hot keys are copied. The slice comes from a hash of `spread_by`,
    columns that tell rows of one key apart, so a re-run task gives the same
    slices. All other keys join as they are. The sketch decides only how rows
    are spread; the result is that of the plain join. Callers that join the
    same fact table in a loop pass `hot` from one call of `hot_keys`. A `large` dim
    is shuffled whatever size the planner expects of it.
    """
    on = list(on)
    if hot is None:
        known = _hot_sketch(fact, on, SHARE).scalar()
    else:
        known = F.array(*[F.lit(h) for h in hot]).cast("array<bigint>")
    is_hot = F.coalesce(F.array_contains(known, F.xxhash64(*on)), F.lit(False))
    zero, last = F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")
    copied = dim.withColumnsRenamed({c: f"_d_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & (F.col(c) == F.col(f"_d_{c}"))
    marked = fact
    if hot is None or hot:
        marked = fact.withColumn(
            "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(SALTS).cast("bigint"))).otherwise(zero)
        )
        copied = dim.withColumn(
            "_salt_d", F.explode(F.when(is_hot, F.sequence(zero, last)).otherwise(F.array(zero)))
        ).withColumnsRenamed({c: f"_d_{c}" for c in on})
        match = match & (F.col("_salt") == F.col("_salt_d"))
    if extra is not None:
        match = match & extra()
    if large:
        copied = copied.hint("merge")
    return marked.join(copied, match, how).drop("_salt", "_salt_d", *[f"_d_{c}" for c in on])


def _many(copies: DataFrame) -> bool:
    """More copies than may be broadcast. The planner takes an exploded table for as small as the one before, so they are counted."""
    return copies.limit(BROADCAST_COPIES + 1).count() > BROADCAST_COPIES


def hashed(dim: DataFrame, counted: bool = True) -> DataFrame:
    """The smaller side of a join, so that tasks hold their part of it in memory and rows of the other side stream past.

    A sort-merge join sorts both sides, so a task holds all its rows of the larger one. Few rows
    are left to the planner, which may broadcast them; without `counted` they are not counted, for a
    side that is itself computed from the larger one. Skew handling works on hash joins as well.
    """
    return dim.hint("shuffle_hash") if not counted or _many(dim) else dim


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    chrom: str = "chrom",
    pos: str = "pos",
    start: str = "iv_start",
    end: str = "iv_end",
    how: str = "inner",
    spread_by: Sequence[str] = (),
    bin_width: int = BIN_WIDTH,
) -> DataFrame:
    """Points inside half-open intervals, as an equi join on (chrom, bin).

    Only the interval side is copied, once per bin it touches; Spark may broadcast
    it where the copies are few and shuffles it otherwise. A pile-up of
    points in one bin is sliced by `spread_join`.
    """
    binned = intervals.withColumn(
        "_bin",
        F.explode(
            F.sequence(
                F.floor(F.col(start) / bin_width), F.floor((F.col(end) - 1) / bin_width)
            )
        ),
    )
    placed = points.withColumn("_bin", F.floor(F.col(pos) / bin_width))
    joined = spread_join(
        placed,
        binned,
        [chrom, "_bin"],
        list(spread_by) or [pos],
        how,
        extra=lambda: (F.col(start) <= F.col(pos)) & (F.col(pos) < F.col(end)),
        large=_many(binned),
    )
    return joined.drop("_bin")


#: Bits of the finest bins of an overlap join: 16 kb, as BIN_WIDTH.
FINEST = 14


#: So few intervals may share wide bins: a left one then meets that many at most.
FEW_INTERVALS = 1_000


def _finest(intervals: DataFrame, start: str, end: str) -> int:
    """Bits of the finest bins: wider ones for a few long intervals, which are then copied some three times each and not shuffled."""
    few = intervals.where(F.col(end) > F.col(start)).select((F.col(end) - F.col(start)).alias("n")).limit(FEW_INTERVALS + 1)
    rows, mean = few.agg(F.count(F.lit(1)), F.avg("n")).first()
    return max(FINEST, int(mean).bit_length()) if 0 < rows <= FEW_INTERVALS else FINEST


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    chrom: str = "chrom",
    start: str = "start",
    end: str = "end",
    right_start: str = "iv_start",
    right_end: str = "iv_end",
    how: str = "inner",
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of half-open intervals that share a place, as an equi join on (chrom, level, bin).

    A left interval stands in one bin: that of its start, among bins no narrower than
    itself (its level). A right interval is copied to all bins, of every level
    that occurs, where a left one that touches it can start. So each pair meets in exactly
    one bin, no left row is copied, and `left_semi` and `left` keep rows as they are.
    Empty intervals touch nothing. Levels are few: one for all intervals up to 16 kb,
    one more per doubling; they are read from the lengths in one pass before the join.
    A pile-up in one bin is sliced by `spread_join`.
    """
    length = F.col(end) - F.col(start)
    finest = _finest(right, right_start, right_end)
    level = F.greatest(F.lit(finest), F.ceil(F.log2(F.greatest(length, F.lit(1)).cast("double")))).cast("int")
    found = left.where(F.col(start).isNotNull() & F.col(end).isNotNull()).agg(F.collect_set(level)).first()[0] or [finest]
    width = lambda k: F.pow(F.lit(2), k).cast("bigint")
    first = lambda place, k: F.floor(place / width(k))
    copies = (
        right.where(F.col(right_end) > F.col(right_start))
        .withColumn("_level", F.explode(F.array(*[F.lit(k) for k in sorted(found)])))
        .withColumn("_bin", F.explode(F.sequence(
            first(F.col(right_start) - width(F.col("_level")) + 1, F.col("_level")), first(F.col(right_end) - 1, F.col("_level"))
        )))
    )
    placed = left.withColumn("_level", level).withColumn("_bin", first(F.col(start), F.col("_level")))
    return spread_join(
        placed, copies, [chrom, "_level", "_bin"], list(spread_by) or [start], how,
        extra=lambda: (F.col(start) < F.col(right_end)) & (F.col(right_start) < F.col(end)) & (F.col(start) < F.col(end)),
        large=_many(copies),
    ).drop("_level", "_bin")
