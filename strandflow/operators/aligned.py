"""Aligned reads as genome segments: operations decoded, bases, covariates, genes.

A read has chrom, pos (place of its first aligned base), cigar and seq, and may
have qual (one character per base, 33 above its quality) and strand (0 forward,
1 reverse). Segments are half-open and count as pos does. Reads without
operations (null or `*`) have no place in the genome and give no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reverse_complement
from .joins import overlap_join, spread_join

# The operations of an alignment, those that use bases of the reference, those that
# use bases of the read, and those that do both.
OPERATION = "([0-9]+)([MIDNSHP=X])"
ON_REFERENCE, ON_READ, MATCHED = "MDN=X", "MIS=X", "M=X"
SEGMENTS = "array<struct<op:string,start:bigint,end:bigint,at:int>>"


def decoded(cigar: Column, pos: Column) -> Column:
    """Operations in order, each with its half-open stretch of the genome and its first base in the read.

    Lengths are added up inside one aggregate: those of operations that use the
    reference move the place, those that use the read move `at`. An insertion, a clip
    or a pad has an empty stretch where it stands.
    """
    lengths = F.regexp_extract_all(cigar, F.lit(OPERATION), 1)
    kinds = F.regexp_extract_all(cigar, F.lit(OPERATION), 2)
    steps = F.zip_with(lengths, kinds, lambda n, op: F.struct(n.cast("bigint").alias("n"), op.alias("op")))
    moves = lambda x, ops: F.when(F.contains(F.lit(ops), x["op"]), x["n"]).otherwise(F.lit(0).cast("bigint"))
    empty = F.struct(
        pos.cast("bigint").alias("place"), F.lit(0).cast("int").alias("at"), F.array().cast(SEGMENTS).alias("out")
    )

    def step(s: Column, x: Column) -> Column:
        end = s["place"] + moves(x, ON_REFERENCE)
        one = F.struct(x["op"].alias("op"), s["place"].alias("start"), end.alias("end"), s["at"].alias("at"))
        return F.struct(
            end.alias("place"), (s["at"] + moves(x, ON_READ)).cast("int").alias("at"), F.concat(s["out"], F.array(one)).alias("out")
        )

    return F.aggregate(F.coalesce(steps, F.array()), empty, step, lambda s: s["out"])


def with_operations(reads: DataFrame) -> DataFrame:
    """Reads with `ops` (see `decoded`) and `end` of the alignment. A text that is no list of operations raises."""
    known = F.col("cigar").isNotNull() & (F.col("cigar") != "*")
    sound = F.col("cigar").rlike("^(?:[0-9]+[MIDNSHP=X])+$")
    checked = F.when(known & sound, F.col("cigar")).when(
        known, F.raise_error(F.concat(F.lit("no alignment operations: "), F.col("cigar"))).cast("string")
    )
    placed = reads.withColumn("ops", F.when(known, decoded(checked, F.col("pos"))))
    return placed.withColumn("end", F.element_at("ops", -1)["end"])


def segments(reads: DataFrame) -> DataFrame:
    """One row per operation: the reads' columns with op, start, end and at in place of cigar and pos."""
    kept = [c for c in reads.columns if c not in ("cigar", "pos")]
    return with_operations(reads).select(*kept, F.explode("ops").alias("o")).select(*kept, "o.*")


def aligned_bases(reads: DataFrame) -> DataFrame:
    """One row per base that stands on a base of the reference.

    Columns of the reads but cigar, pos, seq and qual, then pos, base, cycle (1 for the
    base that was sequenced first) and, where the reads have qual, quality.
    """
    return _bases(segments(reads.withColumn("_length", F.length("seq"))).where(_matched()))


def _matched() -> Column:
    return F.contains(F.lit(MATCHED), F.col("op"))


def _bases(parts: DataFrame) -> DataFrame:
    """Bases of matched segments (start, end, at, seq, _length)."""
    gone = ("op", "start", "end", "at", "seq", "qual", "_length")
    kept = [c for c in parts.columns if c not in gone]
    each = parts.where(F.col("end") > F.col("start")).withColumn(
        "_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("end") - F.col("start") - 1))
    )
    at = (F.col("at") + F.col("_k") + 1).cast("int")
    cycle = at if "strand" not in kept else F.when(F.col("strand") == 1, F.col("_length") + 1 - at).otherwise(at)
    out = [(F.col("start") + F.col("_k")).alias("pos"), F.substr("seq", at, F.lit(1)).alias("base"), cycle.cast("int").alias("cycle")]
    if "qual" in parts.columns:
        out.append((F.ascii(F.substr("qual", at, F.lit(1))) - 33).alias("quality"))
    return each.select(*kept, *out)


def pileup(reads: DataFrame, sample: str = "sample", min_mapq: int = 20, min_quality: int = 0) -> DataFrame:
    """Per covered position A, C, G, T counts, reads that lack the base, and reads with more bases behind it.

    Introns (N) cover nothing. An insertion belongs to the base before it; one before
    the first aligned base belongs to none.
    """
    good = reads.where(F.col("mapq") >= min_mapq)
    names = [sample, "chrom", "mapq", "cigar", "pos", "seq"] + ["qual"] * ("qual" in reads.columns)
    parts = segments(good.select(*names).withColumn("_length", F.length("seq")).withColumn("_first", F.col("pos")))
    bases = _bases(parts.where(_matched()))
    if "quality" in bases.columns:
        bases = bases.where(F.col("quality") >= min_quality)
    lost = parts.where("op = 'D'").select(
        sample, "chrom", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"), F.lit("-").alias("base")
    )
    more = parts.where((F.col("op") == "I") & (F.col("start") > F.col("_first"))).select(
        sample, "chrom", (F.col("start") - 1).alias("pos"), F.lit("+").alias("base")
    )
    every = bases.select(sample, "chrom", "pos", "base").unionByName(lost).unionByName(more)
    names = {"A": "a", "C": "c", "G": "g", "T": "t", "-": "deleted", "+": "inserted"}
    return every.groupBy(sample, "chrom", "pos").agg(*[F.count_if(F.col("base") == b).alias(n) for b, n in names.items()])


def covariate_bases(reads: DataFrame, reference: DataFrame, width: int) -> DataFrame:
    """Aligned bases with read_group, quality, cycle, context and mismatch.

    reads: read_group, name, strand, chrom, pos, cigar, seq, qual. reference: chrom,
    start, text in lines of `width` bases (the last one may be shorter), counted as pos
    is and starting at a multiple of the width. Segments meet the reference by (chrom,
    line), one row per line they touch, before they are cut to bases; a line under
    a pile-up of reads is sliced. Context is the base sequenced before and the base
    itself; the first one has N. Bases beyond the reference are left out.
    """
    parts = segments(reads.withColumn("_length", F.length("seq"))).where(_matched() & (F.col("end") > F.col("start")))
    touched = parts.withColumn(
        "line", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)))
    )
    lines = reference.select("chrom", F.floor(F.col("start") / width).alias("line"), F.col("start").alias("_from"), "text")
    met = spread_join(touched, lines, ["chrom", "line"], ["name"])
    begin = F.greatest("start", "_from")
    cut = (
        met.withColumn("_begin", begin).withColumn("end", F.least(F.col("end"), F.col("_from") + F.length("text")))
        .withColumn("at", (F.col("at") + F.col("_begin") - F.col("start")).cast("int"))
        .withColumn("start", F.col("_begin"))
        .withColumn("_read", F.when(F.col("strand") == 1, reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    )
    bases = _bases(cut.select(
        "read_group", "name", "strand", "chrom", "op", "start", "end", "at", "seq", "qual", "_length", "_read", "_from", "text"
    ))
    expected = F.substr("text", (F.col("pos") - F.col("_from") + 1).cast("int"), F.lit(1))
    before = F.when(F.col("cycle") == 1, F.lit("N")).otherwise(F.substr("_read", F.col("cycle") - 1, F.lit(1)))
    return bases.select(
        "read_group", "name", "quality", "cycle", F.concat(before, F.substr("_read", F.col("cycle"), F.lit(1))).alias("context"),
        "chrom", "pos", (F.col("base") != expected).alias("mismatch"),
    )


def exon_counts(reads: DataFrame, exons: DataFrame, stranded: str = "no") -> DataFrame:
    """Reads per gene: those whose aligned segments touch exons of one gene alone.

    reads: sample, name (unique per sample), strand, chrom, pos, cigar, seq; exons: gene,
    chrom, strand (+ or -), iv_start, iv_end, counted as pos is; a gene's exons may
    overlap and repeat. `stranded` is "no", "same" or "opposite". Skipped
    introns and clipped ends touch nothing. Mates or split rows of one name count once.
    """
    parts = segments(reads.select("sample", "name", "strand", "chrom", "pos", "cigar")).where(_matched()).select(
        "sample", "name", "strand", "chrom", F.col("start").alias("seg_start"), F.col("end").alias("seg_end")
    )
    genes = exons.select("gene", "chrom", F.col("strand").alias("gene_strand"), "iv_start", "iv_end")
    hits = overlap_join(parts, genes, start="seg_start", end="seg_end", spread_by=["sample", "name"])
    if stranded != "no":
        forward = F.when(F.col("strand") == 0, "+").otherwise("-")
        wanted = {"same": forward == F.col("gene_strand"), "opposite": forward != F.col("gene_strand")}
        hits = hits.where(wanted[stranded])
    single = hits.groupBy("sample", "name").agg(F.min("gene").alias("gene"), F.max("gene").alias("_other"))
    return single.where(F.col("gene") == F.col("_other")).groupBy("sample", "gene").agg(F.count(F.lit(1)).alias("n"))
