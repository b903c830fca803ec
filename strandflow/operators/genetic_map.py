"""Places on a genetic map, by the map points before and behind each site."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialised
from .ordered import BUCKET, ranged, scan


def with_map_position(sites: DataFrame, points: DataFrame) -> DataFrame:
    """sites (chrom, pos and other columns) with `cm`, interpolated between map points.

    points: chrom, pos, cm, where cm never falls along a chromosome; of points at one place the
    last value counts. Before the first and behind the last point the map is flat; a
    chromosome without points gives null. Sites and points are put in (chromosome, place)
    ranges together, and the nearest point on either side is carried along them, so no
    chromosome is one task and no point is searched for.
    """
    known = points.groupBy("chrom", "pos").agg(F.max("cm").cast("double").alias("_cm")).withColumns(
        {"_at": F.col("pos"), "_site": F.lit(0)}
    )
    asked = sites.where("chrom IS NOT NULL AND pos IS NOT NULL").select("chrom", "pos").distinct().select(
        "chrom", "pos", F.lit(None).cast("double").alias("_cm"), F.lit(None).cast("bigint").alias("_at"), F.lit(1).alias("_site")
    )
    order = ["pos", "_site"]
    both = ranged(known.select(asked.columns).unionByName(asked), ["chrom"], order)
    before = materialised(scan(both, ["chrom"], order, {"_p0": ("max", "_at"), "_c0": ("max", "_cm")}), "before")
    around = scan(
        before, ["chrom"], order, {"_p1": ("min", "_at"), "_c1": ("min", "_cm")}, descending=True
    ).where("_site = 1").drop(BUCKET)
    share = (F.col("pos") - F.col("_p0")) / (F.col("_p1") - F.col("_p0"))
    inside = F.col("_p0").isNotNull() & F.col("_p1").isNotNull() & (F.col("_p1") > F.col("_p0"))
    cm = F.when(inside, F.col("_c0") + (F.col("_c1") - F.col("_c0")) * share).otherwise(F.coalesce("_c0", "_c1"))
    return sites.join(around.select("chrom", "pos", cm.alias("cm")), ["chrom", "pos"], "left")
