"""Read-level jobs: thresholds, duplicates, sorting, recalibration, pileup."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import CONTIG_ORDER
from ..functions.missing import ratio
from .joins import range_join

COVARIATES = ["read_group", "quality", "cycle", "context"]


def contig_ordinal(c: Column, order: Sequence[str] = tuple(CONTIG_ORDER)) -> Column:
    """Place of a contig in the order table; unknown contigs come last."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), c.cast("string"))
    return F.when(place > 0, place).otherwise(F.lit(len(order) + 1)).cast("int")


def well_mapped(reads: DataFrame, min_quality: int = 20) -> DataFrame:
    return reads.where(F.col("mapq") >= min_quality)


def spliced_ok(reads: DataFrame, mismatches: int = 3, overhang: int = 6, intron: int = 299_999) -> DataFrame:
    """Alignment limits for spliced reads."""
    return reads.where(
        (F.col("mismatches") <= mismatches) & (F.col("overhang") >= overhang) & (F.col("intron") <= intron)
    )


def with_read_group(reads: DataFrame, sample: Column, platform: str = "illumina", unit: str = "unit1") -> DataFrame:
    return reads.withColumns(
        {
            "rg_library": F.concat(F.lit(f"{platform}_"), sample.cast("string")),
            "rg_platform": F.lit(platform),
            "rg_unit": F.lit(unit),
            "rg_sample": sample.cast("string"),
        }
    )


def mark_duplicates(reads: DataFrame, place: Sequence[str] = ("chrom", "pos", "strand")) -> DataFrame:
    """Flag all reads but those of the best fragment of each key; rows are kept.

    A fragment is a read or the mates of one name in a library; its key is the
    places of all its reads, so mates share their fate and a pair is no copy of a
    single read. The survivor per key is a partial aggregate (greatest sum of the
    fragment's qualities, then smallest name). It is joined back on (library,
    name), where it is unique, so a key with a third of all reads is no hot join
    key and no row is doubled.
    """
    fragments = reads.groupBy("library", "name").agg(
        F.array_sort(F.collect_list(F.struct(*place))).alias("_places"), F.sum("qual_sum").alias("_q")
    )
    best = fragments.groupBy("library", "_places").agg(
        F.min_by("name", F.struct((-F.col("_q")).alias("q"), F.col("name"))).alias("name")
    )
    survivors = best.select("library", "name", F.lit(True).alias("_kept"))
    marked = reads.join(survivors, ["library", "name"], "left").withColumn("duplicate", F.col("_kept").isNull())
    return marked.select(*reads.columns, "duplicate")


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    return marked.groupBy("library").agg(
        F.count(F.lit(1)).alias("examined"),
        F.count_if("duplicate").alias("duplicates"),
        (F.lit(100.0) * ratio(F.count_if("duplicate"), F.count(F.lit(1)))).alias("percent"),
    )


def coordinate_sorted(reads: DataFrame) -> DataFrame:
    """Range-partitioned genome order; ties by name."""
    return (
        reads.withColumn("_contig", contig_ordinal(F.col("chrom")))
        .repartitionByRange("_contig", "pos", "name")
        .sortWithinPartitions("_contig", "pos", "name")
        .drop("_contig")
    )


def grouped_by_name(reads: DataFrame) -> DataFrame:
    """Mates side by side: hash-partitioned by name, sorted inside partitions."""
    return reads.repartition("name").sortWithinPartitions("name", "mate")


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in input order, by partial aggregation."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def gene_counts(reads: DataFrame, genes: DataFrame) -> DataFrame:
    """Reads per gene, without reads that hit no gene or several.

    reads: sample, name (unique per sample), chrom, pos; genes: gene, chrom,
    iv_start, iv_end.
    """
    hits = range_join(reads.select("sample", "name", "chrom", "pos"), genes, spread_by=["sample", "name"])
    single = hits.groupBy("sample", "name").agg(
        F.min("gene").alias("gene"), F.max("gene").alias("_other")
    ).where(F.col("gene") == F.col("_other"))
    return single.groupBy("sample", "gene").agg(F.count(F.lit(1)).alias("n"))


def covariate_table(bases: DataFrame, known: DataFrame) -> DataFrame:
    """Observations and mismatches per covariate set, known sites excluded.

    bases: read_group, quality, cycle, context, chrom, pos, mismatch (boolean).
    """
    fresh = bases.join(known.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_anti")
    counted = fresh.groupBy(*COVARIATES).agg(
        F.count(F.lit(1)).alias("observations"), F.count_if("mismatch").alias("mismatches")
    )
    return counted.withColumn(
        "empirical",
        F.lit(-10.0) * F.log10((F.col("mismatches") + F.lit(1.0)) / (F.col("observations") + F.lit(2.0))),
    )


def recalibrated(bases: DataFrame, table: DataFrame) -> DataFrame:
    """Bases with the empirical quality of their covariates; unseen ones keep theirs.

    The table has one row per covariate set, bounded by groups x qualities x
    cycles x contexts; Spark broadcasts it where its size allows.
    """
    joined = bases.join(table.select(*COVARIATES, "empirical"), COVARIATES, "left")
    return joined.withColumn(
        "quality", F.coalesce(F.bround("empirical").cast("int"), F.col("quality"))
    ).drop("empirical")


def aligned_bases(reads: DataFrame) -> DataFrame:
    """One row per base of gap-free alignments."""
    return reads.select(
        *[c for c in reads.columns if c not in ("seq", "pos")],
        "pos",
        F.posexplode(F.split("seq", "")).alias("_i", "base"),
    ).where(F.col("base") != "").select(
        *[c for c in reads.columns if c not in ("seq", "pos")],
        (F.col("pos") + F.col("_i")).alias("pos"),
        "base",
    )


def base_counts(reads: DataFrame, sample: str = "sample", min_quality: int = 20) -> DataFrame:
    """A, C, G, T counts per covered position."""
    bases = aligned_bases(well_mapped(reads, min_quality).select(sample, "chrom", "pos", "seq"))
    return bases.groupBy(sample, "chrom", "pos").agg(
        *[F.count_if(F.col("base") == b).alias(b.lower()) for b in "ACGT"]
    )


def with_barcode(reads: DataFrame, whitelist: DataFrame, length: int = 16) -> DataFrame:
    """Reads whose leading bases are a listed cell barcode."""
    tagged = reads.withColumn("barcode", F.substring("seq", 1, length))
    return tagged.join(whitelist.select("barcode").distinct(), "barcode", "left_semi")


def molecule_counts(tags: DataFrame) -> DataFrame:
    """Distinct molecule tags per (barcode, gene): rows are deduplicated before counting."""
    return tags.select("barcode", "gene", "umi").distinct().groupBy("barcode", "gene").agg(
        F.count(F.lit(1)).alias("n")
    )


def called_cells(counts: DataFrame, expected: int = 3000) -> DataFrame:
    """Barcodes with at least a tenth of the 99th percentile of the top `expected` totals."""
    from .ordered import exact_quantiles

    totals = counts.groupBy("barcode").agg(F.sum("n").alias("total"))
    top = totals.orderBy(F.desc("total"), "barcode").limit(expected)
    robust = exact_quantiles(top, [], "total", {"q": 0.99})
    return totals.where(F.col("total") >= robust.scalar() / F.lit(10.0))
