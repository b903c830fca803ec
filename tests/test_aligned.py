"""Alignment operations and interval overlaps against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandflow.operators import aligned, reads, variants
from strandflow.operators.joins import overlap_join

SCHEMA = "sample string, name long, strand int, chrom string, pos long, mapq int, cigar string, seq string, qual string"


def walk(cigar, pos):
    """(op, start, end, at) of every operation."""
    out, at = [], 0
    for n, op in re.findall(r"([0-9]+)([MIDNSHP=X])", cigar):
        end = pos + (int(n) if op in "MDN=X" else 0)
        out.append((op, pos, end, at))
        pos, at = end, at + (int(n) if op in "MIS=X" else 0)
    return out


def made(seed, count=300, places=3000):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        ops = "".join(f"{rng.randrange(1, 9)}{rng.choice('MIDNSHP=XMMM')}" for _ in range(rng.randrange(1, 7)))
        size = sum(int(n) for n, op in re.findall("([0-9]+)(.)", ops) if op in "MIS=X")
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        qual = "".join(chr(33 + rng.randrange(42)) for _ in range(size))
        rows.append((f"s{k % 2}", k, k % 2, rng.choice("aaaab"), rng.randrange(places), rng.choice([10, 30, 60]), ops, seq, qual))
    return rows


def test_operations_and_bases(spark):
    rows = made(1) + [("s0", 900, 0, "a", 5, 60, "*", "ACGT", "IIII"), ("s0", 901, 0, "a", None, 60, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in aligned.segments(df).select("name", "op", "start", "end", "at").collect())
    assert got == sorted((r[1], *x) for r in rows if r[6] not in (None, "*") for x in walk(r[6], r[4]))
    bases = sorted(tuple(r) for r in aligned.aligned_bases(df).select("name", "pos", "base", "cycle", "quality").collect())
    want = []
    for _, name, strand, _, pos, _, cigar, seq, qual in rows:
        for op, start, end, at in walk(cigar or "", pos or 0):
            if op in "M=X":
                for k in range(end - start):
                    nth = at + k
                    want.append((name, start + k, seq[nth], len(seq) - nth if strand else nth + 1, ord(qual[nth]) - 33))
    assert bases == sorted(want)
    assert aligned.segments(df.limit(0)).count() == 0 and aligned.pileup(df.limit(0)).count() == 0


def test_damaged_operations_raise(spark):
    df = spark.createDataFrame([("s", 1, 0, "a", 1, 60, "3M2Q", "ACGTA", "IIIII")], SCHEMA)
    with pytest.raises(Exception, match="no alignment operations"):
        aligned.segments(df).collect()


def test_pileup_counts(spark):
    rows = made(2, places=60)
    got = {(r.sample, r.chrom, r.pos): (r.a, r.c, r.g, r.t, r.deleted, r.inserted) for r in aligned.pileup(spark.createDataFrame(rows, SCHEMA), min_quality=13).collect()}
    want = {}
    add = lambda key, k: want.setdefault(key, [0] * 6).__setitem__(k, want.setdefault(key, [0] * 6)[k] + 1)
    for sample, _, _, chrom, pos, mapq, cigar, seq, qual in rows:
        for op, start, end, at in walk(cigar, pos) if mapq >= 20 else ():
            for k in range(end - start):
                if op in "M=X" and ord(qual[at + k]) - 33 >= 13:
                    want.setdefault((sample, chrom, start + k), [0] * 6)
                    if seq[at + k] in "ACGT":
                        add((sample, chrom, start + k), "ACGT".index(seq[at + k]))
                elif op == "D":
                    add((sample, chrom, start + k), 4)
            if op == "I" and start > pos:
                add((sample, chrom, start - 1), 5)
    assert got == {k: tuple(v) for k, v in want.items()}


def test_recalibration_from_reads(spark):
    """Covariates of whole reads feed the table and the new qualities; bases beyond the reference are left out."""
    rng = random.Random(4)
    text = "".join(rng.choice("ACGT") for _ in range(100))
    rows = [(f"s{k % 2}", k, k % 2, "a", rng.randrange(95), 60, "2S6M", "AC" + "".join(rng.choice("ACGT") for _ in range(6)), "I" * 8) for k in range(200)]
    lines = spark.createDataFrame([("a", s, text[s : s + 8]) for s in range(0, 100, 8)], "chrom string, start long, text string")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("read_group", F.col("sample"))
    bases = aligned.covariate_bases(df, lines, 8)
    got = sorted(tuple(r) for r in bases.select("name", "pos", "cycle", "context", "mismatch").collect())
    flip = str.maketrans("ACGT", "TGCA")
    want = []
    for _, name, strand, _, pos, _, _, seq, _ in rows:
        own = seq.translate(flip)[::-1] if strand else seq
        for k in range(6):
            if pos + k < 100:
                c = 8 - (k + 2) if strand else k + 3
                want.append((name, pos + k, c, ("N" if c == 1 else own[c - 2]) + own[c - 1], seq[k + 2] != text[pos + k]))
    assert got == sorted(want)
    table = reads.covariate_table(bases, spark.createDataFrame([("a", 3)], "chrom string, pos long"))
    assert table.agg(F.sum("observations")).first()[0] == sum(w[1] != 3 for w in want)
    assert reads.recalibrated(bases, table).count() == len(want)


def intervals(rng, count, longest, places=200_000):
    out = []
    for k in range(count):
        start = rng.randrange(places)
        out.append((k, rng.choice("aaaab"), start, start + rng.choice([0, 1, 2, rng.randrange(longest), rng.randrange(longest)])))
    return out


@pytest.mark.parametrize("longest", [20, 40_000, 150_000])
def test_overlaps_against_all_pairs(spark, longest):
    rng = random.Random(longest)
    one, two = intervals(rng, 300, longest), intervals(rng, 200, 60_000)
    one += [(1000, "a", 100, 200), (1001, "a", 200, 300), (1002, None, 1, 9), (1003, "a", None, 5), (1004, "a", 120, 130)]
    two += [(2000, "a", 100, 200), (2001, "a", 16384, 32768), (2002, "a", 150, 200), (2003, "a", 9, 9)]
    left = spark.createDataFrame(one, "id long, chrom string, start long, end long")
    right = spark.createDataFrame(two, "other long, chrom string, iv_start long, iv_end long")
    want = sorted(
        (i, j) for i, c, s, e in one for j, d, x, y in two
        if c == d and None not in (c, s) and s < e and x < y and s < y and x < e
    )
    assert sorted((r.id, r.other) for r in overlap_join(left, right).select("id", "other").collect()) == want
    assert sorted(r.id for r in overlap_join(left, right, how="left_semi").collect()) == sorted({i for i, _ in want})
    assert overlap_join(left, right, how="left").count() == len(want) + len(one) - len({i for i, _ in want})
    assert overlap_join(left.limit(0), right).count() == 0 and overlap_join(left, right.limit(0)).count() == 0


def test_restriction_keeps_variants_that_reach_an_interval(spark):
    calls = spark.createDataFrame(
        [("a", 99, "AC", "A"), ("a", 100, "A", "G"), ("a", 101, "A", "G"), ("a", 150, "A", "G"), ("a", 151, "A", "G"), ("b", 120, "A", "G")],
        "chrom string, pos long, ref string, alt string",
    )
    bed = spark.createDataFrame([("a", 100, 150), ("a", 120, 130)], "chrom string, iv_start long, iv_end long")
    assert sorted(r.pos for r in variants.in_intervals(calls.where("chrom = 'a'"), bed).collect()) == [101, 150]
    assert variants.in_intervals(spark.createDataFrame([("a", 99, "ACG", "A")], calls.schema), bed).count() == 1


def test_genes_of_spliced_reads(spark):
    rows = [
        ("s", 1, 0, "a", 100, 60, "10M500N10M", "A" * 20, "I" * 20), ("s", 2, 0, "a", 300, 60, "10M", "A" * 10, "I" * 10),
        ("s", 3, 1, "a", 95, 60, "10S5M", "A" * 15, "I" * 15), ("s", 4, 0, "a", 104, 60, "4M3I4M", "A" * 11, "I" * 11), ("s", 5, 0, "a", 640, 60, "10M", "A" * 10, "I" * 10),
    ]
    exons = spark.createDataFrame(
        [("g1", "a", "+", 100, 120), ("g1", "a", "+", 105, 125), ("g1", "a", "+", 610, 630), ("inside", "a", "-", 300, 310), ("g2", "a", "-", 640, 650), ("g3", "a", "+", 645, 700)],
        "gene string, chrom string, strand string, iv_start long, iv_end long",
    )
    df = spark.createDataFrame(rows, SCHEMA)
    count = lambda **k: {r.gene: r.n for r in aligned.exon_counts(df, exons, **k).collect()}
    assert count() == {"g1": 2, "inside": 1}  # the intron touches nothing, read 3 ends before the exon, 5 has two genes
    assert count(stranded="same") == {"g1": 2, "g3": 1} and count(stranded="opposite") == {"inside": 1, "g2": 1}
