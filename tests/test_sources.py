"""Sources and sinks on small hand-written files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.operators import homozygosity, liftover, reads
from strandflow.operators.genes import unique_names
from strandflow.queries import load
from strandflow.sources import annotation, chain, fastq, matrix, sinks, text, vcf
from strandflow.functions.text import tag_value


def put(tmp_path, name, content):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb
1\t100\trs1\tA\tG\t50.5\tPASS\tDP=10;AF=0.5\tGT:AD:DP:GQ\t0/1:5,5:10:99\t./.:.:.:.
1\t200\t.\tC\tT,G\t.\tq10;s50\tDP=3\tGT:DP\t1/2:3\t0/0:4
2\t5\t.\tGA\tG\t7\tPASS\tDP=2\tGT:AD:DP:GQ\t1|1:0,2:2:9\t0|1:1,1:2:8
"""


def test_vcf(spark, tmp_path):
    path = put(tmp_path, "a.vcf", VCF)
    sites = {r["pos"]: r for r in vcf.read_sites(spark, path).collect()}
    assert sites[100]["info"] == {"DP": "10", "AF": "0.5"} and sites[100]["qual"] == 50.5
    assert sites[200]["qual"] is None and sites[200]["filter"] == ["q10", "s50"]
    geno = {(r["pos"], r["sample"]): r for r in vcf.read_genotypes(spark, path).collect()}
    assert geno[(100, "a")]["ad"] == [5, 5] and geno[(100, "a")]["gq"] == 99
    assert geno[(100, "b")]["gt"] == "./." and geno[(100, "b")]["dp"] is None
    assert geno[(200, "a")]["dp"] == 3 and geno[(200, "a")]["gq"] is None
    assert len(geno) == 6


def test_files_keep_their_own_samples(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    call = "\n1\t100\t.\tA\tG\t9\tPASS\t.\tGT\t"
    for name, samples, values in (("x", "A", "0/1"), ("y", "B\tC", "1/1\t0/0")):
        put(tmp_path, f"calls/{name}.vcf", head + samples + call + values + "\n")
    got = vcf.read_genotypes(spark, str(tmp_path / "calls"))
    assert rows(got.select("sample", "gt"), "sample") == [("A", "0/1"), ("B", "1/1"), ("C", "0/0")]
    put(tmp_path, "calls/z.vcf", head + "D" + call + "0/1\t0/1\n")
    with pytest.raises(Exception, match="do not fit the header"):
        vcf.read_genotypes(spark, str(tmp_path / "calls")).collect()


def test_genotype_columns(spark, tmp_path):
    from strandflow.functions.genotype import dosage, is_het, is_snp

    geno = vcf.read_genotypes(spark, put(tmp_path, "a.vcf", VCF))
    got = rows(geno.select("pos", "sample", dosage(), is_snp(), is_het()), "pos", "sample")
    assert got == [
        (5, "a", 2, False, False), (5, "b", 1, False, True), (100, "a", 1, True, True),
        (100, "b", -1, True, False), (200, "a", 2, True, True), (200, "b", 0, True, False),
    ]


def test_matrix_market(spark, tmp_path):
    m = put(tmp_path, "m/matrix.mtx", "%%MatrixMarket matrix\n% note\n3 3 4\n1 1 5\n2 1 1\n3 3 2\n1 3 0\n")
    b = put(tmp_path, "m/barcodes.tsv", "AAA-1\nBBB-1\nCCC-1\n")
    f = put(tmp_path, "m/features.tsv", "E1\tDUP\tGene\nE2\tDUP\tGene\nE3\tX\tGene\n")
    got = matrix.read_matrix_market(spark, m, b, f)
    assert rows(got.select("barcode", "gene", "symbol", "n"), "barcode", "gene") == [
        ("AAA-1", 1, "DUP", 5.0), ("AAA-1", 2, "DUP", 1.0), ("CCC-1", 3, "X", 2.0)
    ]
    names = matrix.read_names(spark, f, 1).select(F.col("idx").alias("gene"), F.col("name").alias("symbol"))
    assert rows(unique_names(names).select("gene", "unique_name"), "gene") == [(1, "DUP"), (2, "DUP-1"), (3, "X")]


def test_wide_counts(spark, tmp_path):
    path = put(tmp_path, "w.csv", "gene,c1,c2,c3\ng1,0,2,0\ng2,1,0,3\n")
    assert rows(text.read_wide_counts(spark, path), "gene", "cell") == [("g1", "c2", 2.0), ("g2", "c1", 1.0), ("g2", "c3", 3.0)]


def test_wide_counts_with_quotes_and_several_headers(spark, tmp_path):
    one = put(tmp_path, "w/1.csv", '"","c,1","c ""2""","c\n3"\n"g,1",0,2,0\n"g\n\n""2""",1,NA,3\n\ng3,0,0,4.5\n')
    two = put(tmp_path, "w/2.csv", '"d1","d2"\n"h1",7,0\n"gene, with\na break",0,8\n')
    want = [
        ("g\n\n\"2\"", "c\n3", 3.0), ("g\n\n\"2\"", "c,1", 1.0), ("g,1", 'c "2"', 2.0), ("g3", "c\n3", 4.5),
        ("gene, with\na break", "d2", 8.0), ("h1", "d1", 7.0),
    ]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "7"):  # splits that end anywhere, also inside quotes
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert sorted(map(tuple, text.read_wide_counts(spark, [one, two]).collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bad = put(tmp_path, "bad.csv", "gene,a,b\ng,1,2,3,4,5\n")
    with pytest.raises(Exception, match="another width"):
        text.read_wide_counts(spark, bad).collect()
    with pytest.raises(Exception, match="no quoted record"):
        text.read_wide_counts(spark, put(tmp_path, "worse.csv", 'gene,a\ng"x"y,1\n')).collect()
    assert text.read_wide_counts(spark, put(tmp_path, "none.csv", "gene,a\n")).count() == 0


def test_fastq_quality_line_may_look_like_a_header(spark, tmp_path):
    path = put(tmp_path, "a.fq", "@r1/1\nACGT\n+\n@r9/1\n@r1/2\nTTTT\n+\nIIII\n@r2/1 extra\nGG\n+\nII\n")
    got = rows(fastq.read_fastq(spark, path).select("name", "mate", "seq", "qual"), "name", "mate")
    assert got == [("r1", 1, "ACGT", "@r9/1"), ("r1", 2, "TTTT", "IIII"), ("r2", 1, "GG", "II")]


def test_line_numbers_survive_file_splits(spark, tmp_path):
    n = 5000
    path = put(tmp_path, "big.txt", "".join(f"line {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = text.numbered_lines(spark, path)
        assert lines.rdd.getNumPartitions() >= 1
        wrong = lines.where(F.concat(F.lit("line "), F.col("line_no").cast("string")) != F.col("value")).count()
        assert wrong == 0 and lines.count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


CHAIN = """chain 100 chr1 1000 + 10 75 chrA 500 + 100 165 1
30 5 10
20 5 0
5

chain 90 chr2 1000 + 0 50 chrB 500 - 0 50 2
50

"""


def test_chain_and_liftover(spark, tmp_path):
    blocks = chain.read_chain(spark, put(tmp_path, "c.chain", CHAIN))
    assert rows(blocks, "chrom", "src_start") == [
        ("chr1", 10, 40, "chrA", 100, "+", 100, 1), ("chr1", 45, 65, "chrA", 140, "+", 100, 1), ("chr1", 70, 75, "chrA", 160, "+", 100, 1),
        ("chr2", 0, 50, "chrB", 450, "-", 90, 2),
    ]
    sites = spark.createDataFrame(
        [("chr1", 13, "A", "G"), ("chr1", 43, "A", "G"), ("chr2", 1, "AC", "A"), ("chr3", 2, "A", "G"),
         ("chr1", 40, "A", "G"), ("chr1", 39, "ACG", "A"), ("chr1", 10, "A", "G")],
        "chrom string, pos bigint, ref string, alt string",
    )
    lifted = liftover.lift_over(sites, blocks)
    good = rows(liftover.accepted(lifted).select("pos", "new_chrom", "new_pos", "new_ref", "new_alt"), "pos")
    assert good == [(1, "chrB", 499, "GT", "T"), (13, "chrA", 103, "A", "G"), (40, "chrA", 130, "A", "G")]
    assert rows(liftover.rejected(lifted).select("pos", "reject_reason"), "pos") == [(2, "NoTarget"), (10, "NoTarget"), (39, "NoTarget"), (43, "NoTarget")]
    assert lifted.count() == sites.count()


def test_annotation(spark, tmp_path):
    def line(start, end, gene, transcript, strand="+", kind="exon"):
        return f'1\tx\t{kind}\t{start}\t{end}\t.\t{strand}\t.\tgene_id "{gene}"; transcript_id "{transcript}";\n'

    path = put(tmp_path, "a.gtf", "#!v\n" + line(1, 10, "G", "T1") + line(21, 30, "G", "T1") + line(1, 10, "G", "T2")
               + line(15, 18, "G", "T2") + line(5, 50, "H", "T3", "-") + line(1, 30, "G", "T1", kind="gene"))
    exons = annotation.read_features(spark, path)
    assert exons.count() == 5
    got = rows(annotation.introns(exons).select("transcript", "j_start", "j_end"), "transcript")
    assert got == [("T1", 10, 20), ("T2", 10, 14)]
    hits = spark.createDataFrame([("s", "r1", "1", 2), ("s", "r2", "1", 40), ("s", "r3", "1", 99)], "sample string, name string, chrom string, pos bigint")
    counts = reads.gene_counts(hits, annotation.gene_bodies(exons).select("gene", "chrom", "iv_start", "iv_end"))
    assert rows(counts, "gene") == [("G", "s", 1)] or rows(counts.select("sample", "gene", "n"), "gene") == [("s", "G", 1), ("s", "H", 1)]


def test_manifest(spark, tmp_path):
    path = put(tmp_path, "m.txt", "sampleID runID\n------- -----\nS1  R1 A.GZ\nS2\tR2 b\n S3 R3 c\n\n(3 rows affected)\n")
    got = text.read_manifest(spark, path, ["sample_id", "run_id", "file_name"], 2, 2)
    assert rows(got, "sample_id") == [("S1", "R1", "A.GZ"), ("S2", "R2", "b"), ("S3", "R3", "c")]


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception):
        text.read_per_file(spark, str(tmp_path / "none"), "a string", "x").count()


def test_region_threshold_is_strict(spark):
    regions = spark.createDataFrame([(4999,), (5000,), (5001,)], "length bigint")
    assert rows(homozygosity.long_regions(regions), "length") == [(5001,)]


def test_repeat_ids(spark):
    df = spark.createDataFrame([("END=1;REF=2;RL=3;RU=C;VARID=HTT",), ("VARID=A_B;END=1",), ("END=1",)], "info string")
    got = [r[0] for r in df.select(tag_value(F.col("info"), "VARID")).collect()]
    assert got == ["HTT", "A_B", None]


def test_fastq_pairs_are_balanced(spark, tmp_path):
    df = spark.createDataFrame(
        [("s", f"r{i}", m, "ACGT", "IIII") for i in range(20) for m in (1, 2)],
        "sample string, name string, mate int, seq string, qual string",
    )
    sinks.write_fastq(df, str(tmp_path / "fq"), "none")
    back = fastq.read_fastq(spark, str(tmp_path / "fq")).groupBy("mate").count()
    assert rows(back, "mate") == [(1, 20), (2, 20)]


def test_split_output(spark, tmp_path):
    sinks.write_split(spark.range(10), F.col("id") < 3, str(tmp_path / "a"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3
    assert spark.read.parquet(str(tmp_path / "b")).count() == 7


def test_listed_files_match_a_pattern(spark, tmp_path):
    for name in ("a.vcf", "a.bam", "b.vcf"):
        put(tmp_path, f"in/{name}", "x")
    found = text.listed_files(spark, str(tmp_path / "in"), "a*")
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["a.bam", "a.vcf"]


def test_written_report_uses_na(spark):
    from strandflow.operators import callreport

    geno = spark.createDataFrame(
        [("s", "1", 10, "A", "G", "0/1", 8, None, 30.0), ("s", "GL1", 10, "A", "C", "0/1", 4, 50, None)],
        "sample string, chrom string, pos bigint, ref string, alt string, gt string, dp int, gq int, qual double",
    )
    got = {r["Chr"]: r for r in callreport.report_text(callreport.call_report(geno), "c.vcf").collect()}
    assert set(got) == {"Genome", "1"}
    assert got["Genome"]["avgQuality"] == "15.0" and got["Genome"]["meanGQ"] == "25.0" and got["Genome"]["avgDepth"] == "6.0"
    assert got["1"]["TSTV"] == "NA" and got["1"]["HeterozygousHomozygousRatio"] == "NA" and got["1"]["Gender"] == "U"


def test_genetic_map_and_places_on_it(spark, tmp_path):
    from strandflow.operators import genetic_map

    put(tmp_path, "m/genetic_map_chr1_combined_b37.txt", "position COMBINED_rate(cM/Mb) Genetic_Map(cM)\n100 1.0 0.5\n200 2.0 1.5\n400 0 1.5\n")
    put(tmp_path, "m/genetic_map_chrX_combined_b37.txt", "position COMBINED_rate(cM/Mb) Genetic_Map(cM)\n10 0.5 0\n")
    points = text.read_genetic_map(spark, str(tmp_path / "m"))
    assert rows(points, "chrom", "pos") == [("1", 100, 1.0, 0.5), ("1", 200, 2.0, 1.5), ("1", 400, 0.0, 1.5), ("X", 10, 0.5, 0.0)]
    places = [("1", 50), ("1", 100), ("1", 150), ("1", 200), ("1", 300), ("1", 999), ("X", 5), ("X", 50), ("2", 7), (None, 7), ("1", None), ("1", 150)]
    sites = spark.createDataFrame([(c, p, k) for k, (c, p) in enumerate(places)], "chrom string, pos bigint, k int")
    got = [(r.k, r.cm) for r in genetic_map.with_map_position(sites, points).orderBy("k").collect()]
    assert got == list(enumerate([0.5, 0.5, 1.0, 1.5, 1.5, 1.5, 0.0, 0.0, None, None, None, 1.0]))
    none = genetic_map.with_map_position(sites, points.limit(0))
    assert none.where("cm IS NULL").count() == len(places)


def test_runs_break_where_the_map_is_long(spark):
    """The same calls: a hot spot between two stretches changes the best path's cost, a flat map does not."""
    calls = [("s", "1", 1000 * k, 2 if k % 2 else 0, 0.5) for k in range(400)]
    geno = spark.createDataFrame(calls, "sample string, chrom string, pos bigint, dosage int, af double")
    even = geno.withColumn("cm", F.col("pos") * (100 * homozygosity.REC_RATE))
    plain = rows(homozygosity.autozygous_runs(geno), "start")
    assert plain and rows(homozygosity.autozygous_runs(even), "start") == plain
    moves = homozygosity._log_moves(np.array([1000.0, 1000.0]), np.array([0.0, 5.0]))
    assert moves[1, 1, 0] > moves[0, 1, 0] and np.allclose(np.exp(moves).sum(axis=2), 1)


def test_wide_counts_of_more_cells_than_a_pivot_names(spark, tmp_path):
    """Cells in blocks, a file and header each; before, one pivot named all cells and failed beyond its limit."""
    counts = [(f"g{i % 7}", f'c{i % 23}, "x"' if i % 2 else f"c{i % 23}", i) for i in range(1, 200)] + [(None, "c1", 5), ("g\n1", None, 4), ("g0", "c2", 0)]
    long = spark.createDataFrame(counts, "gene string, cell string, n bigint")
    want = {}
    for g, c, n in counts:
        want[g or "", c or "null"] = want.get((g or "", c or "null"), 0) + n
    was = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "10")
    try:
        for width in (1, 10, 64):
            path = str(tmp_path / f"wide{width}")
            sinks.write_wide_counts(long, path, width)
            cells = len({c for _, c in want})
            assert len(list((tmp_path / f"wide{width}").glob("block=*/*.csv"))) == -(-cells // width)
            got = {(r.gene, r.cell): r.n for r in text.read_wide_counts(spark, path).collect()}
            assert got == {k: n for k, n in want.items() if n}
        assert load()[0]["S02_wide_counts"](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", was)
