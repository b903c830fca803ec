"""Moving variants to another genome build through chain blocks."""

from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import reverse_complement
from .joins import BIN_WIDTH, overlap_join, range_join

SLICES = 64


def lift_over(variants: DataFrame, blocks: DataFrame, first: int = 1) -> DataFrame:
    """Every variant once, with its new place or the reason it has none.

    Blocks: chrom, src_start, src_end, tgt_chrom, tgt_start (half-open, from 0), strand.
    `first` is the number of the first base in `pos` (1 in call files), old and new.
    On the minus strand the place is mirrored inside the block and the alleles
    are reverse-complemented. A variant whose reference allele leaves a block has
    no target in it. Hits are counted per variant with partial
    aggregation; variants are unique by (chrom, pos, ref, alt).
    """
    site = ["chrom", "pos", "ref", "alt"]
    rest = [c for c in variants.columns if c not in site]
    bounds = blocks.select("chrom", "src_start", "src_end", "tgt_chrom", "tgt_start", "strand")
    hits = range_join(
        variants.withColumn("_at", F.col("pos") - first), bounds, pos="_at", start="src_start", end="src_end", how="left", spread_by=["pos", "alt"]
    )
    minus = F.col("strand") == "-"
    whole = F.col("_at") + F.length("ref") <= F.col("src_end")
    place = F.struct(
        F.col("tgt_chrom").alias("new_chrom"),
        F.when(minus, F.col("tgt_start") + (F.col("src_end") - F.length("ref") - F.col("_at")) + first)
        .otherwise(F.col("tgt_start") + (F.col("_at") - F.col("src_start")) + first)
        .alias("new_pos"),
        F.when(minus, reverse_complement(F.col("ref"))).otherwise(F.col("ref")).alias("new_ref"),
        F.when(minus, reverse_complement(F.col("alt"))).otherwise(F.col("alt")).alias("new_alt"),
    )
    counted = hits.groupBy(*site).agg(
        *[F.any_value(c).alias(c) for c in rest],
        F.count_if(whole).alias("n_targets"),
        F.min(F.when(whole, place)).alias("place"),
    )
    single = F.col("n_targets") == 1
    return counted.select(
        *variants.columns,
        *[F.when(single, F.col(f"place.{c}")).alias(c) for c in ("new_chrom", "new_pos", "new_ref", "new_alt")],
        F.when(F.col("n_targets") == 0, "NoTarget")
        .when(F.col("n_targets") > 1, "MultipleTargets")
        .alias("reject_reason"),
    )


def best_chains(blocks: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Disjoint blocks: every source base belongs to the best chain over it.

    Blocks as for `lift_over`, with score and chain. The highest score wins, then the
    smallest chain, then the block that starts first. A block loses the stretches that
    better ones cover; what stays is cut to its own places in source and target.

    Blocks are cut at bins and each bin is swept once in order of starts. The sweep holds
    only blocks that can still win: each one worse than the one before and longer lasting, so
    never more than a bin has bases. A bin under many chains is swept in slices first, each of
    which leaves at most one winner per base, and the winners meet in a second sweep.
    Empty blocks and those without a place or a chromosome give no rows; without a score a
    block has 0, without a chain it comes last among equal scores.
    """
    own = ["src_start", "src_end", "tgt_chrom", "tgt_start", "strand", "score", "chain"]
    width = F.lit(bin_width).cast("bigint")
    sound = (
        blocks.select("chrom", *own).where("src_end > src_start").dropna(subset=["chrom", *own[:5]])
        .fillna({"score": 0, "chain": (1 << 63) - 1})
    )
    cut = sound.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("src_start") / width), F.floor((F.col("src_end") - 1) / width)))
    ).withColumns({
        "from": F.greatest(F.col("src_start"), F.col("bin") * width),
        "upto": F.least(F.col("src_end"), (F.col("bin") + 1) * width),
        "slice": F.pmod(F.xxhash64(*own), F.lit(SLICES)).cast("int"),
    })
    layout = cut.schema

    def swept(batches):
        group, sweep = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False, name=None):
                key = row[:3]
                if key != group:
                    if sweep:
                        out.extend(sweep.finish())
                    group, sweep = key, _Sweep()
                out.extend(sweep.add(row))
            yield pd.DataFrame(out, columns=order)
        if sweep:
            yield pd.DataFrame(sweep.finish(), columns=order)

    order = ["chrom", "bin", "slice", "from", "upto", *own]
    kinds = ", ".join(f"`{c}` {layout[c].dataType.simpleString()}" for c in order)
    # equal blocks of one chain differ in the remaining columns, which fix the order of the sweep
    ties = ["from", *own]
    sliced = cut.select(*order).repartition("chrom", "bin", "slice").sortWithinPartitions("chrom", "bin", "slice", *ties)
    winners = sliced.mapInPandas(swept, kinds).withColumn("slice", F.lit(0))
    whole = winners.select(*order).repartition("chrom", "bin").sortWithinPartitions("chrom", "bin", "slice", *ties)
    pieces = whole.mapInPandas(swept, kinds)

    along = Window.partitionBy("chrom", *own).orderBy("from")
    islands = pieces.withColumn(
        "_new", F.when(F.lag("upto").over(along) == F.col("from"), 0).otherwise(1)
    ).withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    kept = islands.groupBy("chrom", *own, "_island").agg(F.min("from").alias("from"), F.max("upto").alias("upto"))
    target = F.when(F.col("strand") == "-", F.col("tgt_start") + F.col("src_end") - F.col("upto")).otherwise(
        F.col("tgt_start") + F.col("from") - F.col("src_start")
    )
    return kept.select(
        "chrom", F.col("from").alias("src_start"), F.col("upto").alias("src_end"), "tgt_chrom",
        target.alias("tgt_start"), "strand", "score", "chain",
    )


class _Sweep:
    """The best block along one bin; rows (chrom, bin, slice, from, upto, own...) come in order of `from`."""

    def __init__(self):
        self.ranks, self.rows = [], []  # best first; each later one ends later
        self.at = 0

    def add(self, row):
        out = self._until(row[3])
        rank = (-row[10], row[11], row[5:10])
        place = bisect_left(self.ranks, rank)
        if place and self.rows[place - 1][4] >= row[4]:
            return out
        if place == 0:
            if self.rows and self.at < row[3]:
                out.append(self._piece(self.rows[0], row[3]))
            self.at = row[3]
        last = place
        while last < len(self.rows) and self.rows[last][4] <= row[4]:
            last += 1
        self.ranks[place:last], self.rows[place:last] = [rank], [row]
        return out

    def finish(self):
        return self._until(float("inf"))

    def _until(self, place):
        """Pieces of blocks that end by this place."""
        out = []
        while self.rows and self.rows[0][4] <= place:
            out.append(self._piece(self.rows[0], self.rows[0][4]))
            self.at = self.rows[0][4]
            del self.ranks[0], self.rows[0]
        return out

    def _piece(self, row, upto):
        return (*row[:3], self.at, upto, *row[5:])


def checked_alleles(lifted: DataFrame, reference: DataFrame, first: int = 1) -> DataFrame:
    """Lifted variants compared with the text of the new genome.

    Reference: chrom, start (from 0), text; pieces do not overlap. A variant whose lifted
    reference allele differs from the text is rejected as MismatchedRefAllele, one that
    no text covers whole as NoReference; rejected ones keep no new place. Case is no difference.
    """
    site = ["chrom", "pos", "ref", "alt"]
    new = ["new_chrom", "new_pos", "new_ref", "new_alt"]
    at = F.col("new_pos") - first
    placed = lifted.where(F.col("reject_reason").isNull()).select(*site, *new).withColumns(
        {"_from": at, "_upto": at + F.length("new_ref")}
    )
    pieces = reference.select(
        F.col("chrom").alias("new_chrom"), F.col("start").alias("iv_start"), (F.col("start") + F.length("text")).alias("iv_end"), "text"
    )
    met = overlap_join(placed, pieces, chrom="new_chrom", start="_from", end="_upto", spread_by=["new_pos", "alt"])
    low, high = F.greatest("_from", "iv_start"), F.least("_upto", "iv_end")
    length = (high - low).cast("int")
    same = F.upper(F.substr("text", (low - F.col("iv_start") + 1).cast("int"), length)) == F.upper(
        F.substr("new_ref", (low - F.col("_from") + 1).cast("int"), length)
    )
    seen = met.groupBy(*site).agg(F.sum(length).alias("_seen"), F.every(same).alias("_same"))
    found = lifted.join(seen, site, "left")
    reason = F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason")).when(
        ~F.coalesce(F.col("_same"), F.lit(True)), "MismatchedRefAllele"
    ).when(F.coalesce(F.col("_seen"), F.lit(0)) < F.length("new_ref"), "NoReference")
    judged = found.withColumn("reject_reason", reason).drop("_seen", "_same")
    return judged.withColumns({c: F.when(F.col("reject_reason").isNull(), F.col(c)) for c in new}).select(*lifted.columns)


def accepted(lifted: DataFrame) -> DataFrame:
    return lifted.where(F.col("reject_reason").isNull())


def rejected(lifted: DataFrame) -> DataFrame:
    return lifted.where(F.col("reject_reason").isNotNull())
