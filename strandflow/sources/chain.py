"""Chain text: aligned blocks between two genome builds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..operators.ordered import BUCKET, scan
from ..shared import materialised
from .text import numbered_lines

LINES_PER_RANGE = 4096


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Blocks: chrom, src_start, src_end, tgt_chrom, tgt_start, strand (forward coordinates),
    and the score and id of their chain.

    The chain a line belongs to is a running count of header lines, a block's
    place a running sum of sizes and gaps, both taken over ranges of lines.
    """
    lines = numbered_lines(spark, path, per_file=False).where(F.trim("value") != "")
    fields = F.split(F.trim("value"), r"\s+")
    tagged = lines.select(
        "line_no", fields.alias("f"),
        F.floor(F.col("line_no") / LINES_PER_RANGE).alias(BUCKET),
        F.when(F.col("value").startswith("chain"), 1).otherwise(0).cast("bigint").alias("_head"),
    )
    numbered = materialised(scan(tagged, [], ["line_no"], {"chain": ("sum", "_head")}), "chains")

    def number(i: int):
        return F.coalesce(F.get("f", F.lit(i)).cast("bigint"), F.lit(0).cast("bigint"))

    heads = numbered.where(F.col("_head") == 1).select(
        "chain",
        F.get("f", F.lit(2)).alias("chrom"), number(5).alias("t_start"),
        F.get("f", F.lit(7)).alias("tgt_chrom"), number(8).alias("q_size"), F.get("f", F.lit(9)).alias("strand"),
        number(10).alias("q_start"), number(1).alias("score"), number(12).alias("id"),
    )
    blocks = numbered.where(F.col("_head") == 0).select(
        "chain", "line_no", BUCKET,
        number(0).alias("size"), (number(0) + number(1)).alias("_t"), (number(0) + number(2)).alias("_q"),
    )
    summed = scan(
        blocks, ["chain"], ["line_no"], {"_ts": ("sum", "_t"), "_qs": ("sum", "_q")}, inclusive=False
    )
    joined = spread_join(summed, heads, ["chain"], ["line_no"])
    src = F.col("t_start") + F.col("_ts")
    tgt = F.col("q_start") + F.col("_qs")
    return joined.select(
        "chrom", src.alias("src_start"), (src + F.col("size")).alias("src_end"), "tgt_chrom",
        F.when(F.col("strand") == "-", F.col("q_size") - tgt - F.col("size")).otherwise(tgt).alias("tgt_start"),
        "strand", "score", F.col("id").alias("chain"),
    )
