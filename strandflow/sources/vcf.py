"""Variant call text as a site table and a long genotype table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The leading columns of the format.
SITE_COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _fields(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        "file", F.split("value", "\t").alias("f")
    )


def _site(i: int):
    return F.get("f", F.lit(i))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, id, ref, alt, qual, filter (list), info (key=value map)."""
    return _fields(_lines(spark, path)).select(
        _site(0).alias("chrom"),
        _site(1).cast("bigint").alias("pos"),
        _site(2).alias("id"),
        _site(3).alias("ref"),
        _site(4).alias("alt"),
        _site(5).try_cast("double").alias("qual"),
        F.split(_site(6), ";").alias("filter"),
        F.str_to_map(_site(7), F.lit(";"), F.lit("=")).alias("info"),
    )


def read_genotypes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per site and sample: gt, ad (list), dp, gq by the keys of the format column.

    Every file has the sample names of its own header; names never pass the
    driver. Files without one, as parts of a text written by Spark, have the names
    on which all headers agree. A line with another number of values than names,
    or a file without names, fails the read.
    """
    lines = _lines(spark, path)
    heads = lines.where(F.col("value").startswith("#CHROM")).groupBy("file").agg(
        F.slice(F.split(F.first("value"), "\t"), 10, 1 << 30).alias("names")
    )
    agreed = heads.agg(F.when(F.count_distinct("names") == 1, F.first("names")).alias("n")).scalar()
    rows = _fields(lines).join(heads, "file", "left").withColumn("names", F.coalesce("names", agreed))
    values = F.slice("f", 10, 1 << 30)
    fits = F.coalesce(F.size("names") == F.size(values), F.lit(False))
    samples = F.when(fits, F.col("names")).otherwise(
        F.raise_error(F.concat(F.lit("values do not fit the header of "), F.col("file")))
    )
    long = rows.select(
        _site(0).alias("chrom"), _site(1).cast("bigint").alias("pos"), _site(3).alias("ref"), _site(4).alias("alt"),
        F.split(_site(8), ":").alias("_k"),
        F.explode(F.arrays_zip(samples.alias("sample"), values.alias("packed"))).alias("_s"),
    ).withColumn("_v", F.split("_s.packed", ":"))

    def field(key: str):
        place = F.array_position("_k", key)
        return F.when(place > 0, F.get("_v", (place - 1).cast("int")))

    return long.select(
        "chrom", "pos", "ref", "alt",
        F.col("_s.sample").alias("sample"),
        field("GT").alias("gt"),
        F.transform(F.split(field("AD"), ","), lambda x: x.try_cast("int")).alias("ad"),
        field("DP").try_cast("int").alias("dp"),
        field("GQ").try_cast("int").alias("gq"),
    )


def to_rows(geno: DataFrame, samples: list) -> DataFrame:
    """Wide text rows (one column per sample of the cohort) from the long table."""
    packed = F.concat_ws(
        ":", "gt", F.coalesce(F.col("dp").cast("string"), F.lit(".")), F.coalesce(F.col("gq").cast("string"), F.lit("."))
    )
    per_sample = [
        F.coalesce(F.max(F.when(F.col("sample") == s, packed)), F.lit("./.:.:.")).alias(f"s{s}") for s in samples
    ]
    sites = geno.groupBy("chrom", "pos", "ref", "alt").agg(F.max("qual").alias("qual"), F.sum("dp").alias("depth"), *per_sample)
    return sites.select(
        "chrom", "pos", F.lit(".").alias("id"), "ref", "alt", "qual", F.lit("PASS").alias("filter"),
        F.concat(F.lit("DP="), F.col("depth").cast("string")).alias("info"), F.lit("GT:DP:GQ").alias("format"),
        *[f"s{s}" for s in samples],
    )


def header_lines(samples: list) -> list[str]:
    return ["##fileformat=VCFv4.2", "#" + "\t".join(c.upper() for c in SITE_COLUMNS) + "".join(f"\ts{s}" for s in samples)]
