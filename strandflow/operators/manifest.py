"""Sample manifests: expected files, retention tags, listings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Files expected per sample, where they lie, and whether they are archived.
EXPECTED_FILES = [
    (".vcfLevel.byChr.qc", "cohort", True),
    (".AncestryClustering.tiff", "cohort", True),
    (".hg19.g.vcf.gz", "run", True),
    (".hg19.g.vcf.idx", "run", True),
    (".hg19.bamLevel.qc", "run", True),
    (".fastqLevel.qc", "run", True),
    (".sorted.bam", "run", False),
    (".hg19.sorted.dedup.bam", "run", False),
    (".hg19.sorted.dedup.bam.bai", "run", False),
    (".RegionsOfHomozygosity.txt", "run", True),
]


def expected_files(manifest: DataFrame, patterns: Sequence[tuple[str, bool]]) -> DataFrame:
    """Every sample with every (suffix, archive) pattern; the patterns are a literal list."""
    listed = F.array(*[F.struct(F.lit(s).alias("suffix"), F.lit(a).alias("archive")) for s, a in patterns])
    return manifest.withColumn("_p", F.explode(listed)).select(*manifest.columns, "_p.suffix", "_p.archive")


def retention_tags(manifest: DataFrame, listing: DataFrame, patterns: Sequence[tuple[str, bool]]) -> DataFrame:
    """Archive tag of every expected file that exists in the listing."""
    return expected_files(manifest, patterns).join(listing, ["id", "suffix"], "left_semi")


def included(listing: DataFrame, prefix: str, col: str = "path") -> DataFrame:
    """Everything excluded, then names that start with the prefix taken back."""
    return listing.where(F.col(col).like(prefix.replace("%", r"\%") + "%"))


def per_sample_files(manifest: DataFrame, cohort: str, run: str, sample: str) -> DataFrame:
    """Full paths of the files expected for each sample of a cohort run."""
    listed = F.array(
        *[F.struct(F.lit(s).alias("s"), F.lit(w).alias("w"), F.lit(a).alias("a")) for s, w, a in EXPECTED_FILES]
    )
    rows = manifest.withColumn("_f", F.explode(listed))
    folder = F.when(F.col("_f.w") == "cohort", F.lower(F.col(cohort))).otherwise(F.lower(F.col(run)))
    return rows.select(
        *manifest.columns,
        F.concat(folder, F.lit("/"), F.col(sample), F.col("_f.s")).alias("path"),
        F.col("_f.a").alias("archive"),
    )
