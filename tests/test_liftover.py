"""Choice among overlapping chains and the check of lifted alleles."""

import random

import pytest
from pyspark.sql import functions as F

from strandflow.operators import joins, liftover
from strandflow.sources import chain, vcf

BLOCK = "chrom string, src_start bigint, src_end bigint, tgt_chrom string, tgt_start bigint, strand string, score bigint, chain bigint"


def by_base(blocks):
    """Every source base with its target place, the best chain's."""
    found = {}
    for c, s, e, tc, ts, strand, score, number in blocks:
        if None in (c, s, e, tc, ts, strand):
            continue
        score, number = score or 0, (1 << 63) - 1 if number is None else number
        for at in range(s, e):
            to = ts + at - s if strand == "+" else ts + e - 1 - at
            rank = (-score, number, s, e, tc, ts, strand)
            if (c, at) not in found or rank < found[c, at][0]:
                found[c, at] = (rank, (tc, to, strand))
    return {k: v[1] for k, v in found.items()}


def stretches(blocks):
    out = {}
    for r in blocks.collect():
        for at in range(r.src_start, r.src_end):
            assert (r.chrom, at) not in out, "blocks overlap"
            to = r.tgt_start + at - r.src_start if r.strand == "+" else r.tgt_start + r.src_end - 1 - at
            out[r.chrom, at] = (r.tgt_chrom, to, r.strand)
    return out


@pytest.mark.parametrize("width", [16, 64, 1 << 14])
def test_every_base_has_its_best_chain(spark, width):
    rng = random.Random(width)
    blocks = []
    for i in range(500):
        c = "hot" if rng.random() < 0.6 else rng.choice("ab")
        s = rng.randrange(600)
        blocks.append((c, s, s + rng.choice([0, 1, 2, rng.randrange(200)]), rng.choice("xy"), rng.randrange(10**6),
                       rng.choice("+-"), rng.choice([None, 1, 5, rng.randrange(100)]), rng.choice([None, i, 7])))
    blocks += blocks[:20] + [(None, 1, 5, "x", 1, "+", 9, 1), ("a", None, 5, "x", 1, "+", 999, 1), ("a", 5, 2, "x", 1, "+", 999, 1),
                             ("a", 1, 500, None, 1, "+", 999, 1)]
    got = liftover.best_chains(spark.createDataFrame(blocks, BLOCK), width)
    assert stretches(got) == by_base(blocks)
    # one block over many bins comes back in one piece
    long = spark.createDataFrame([("a", 3, 100_003, "x", 50, "-", 1, 1), ("a", 40, 41, "y", 9, "+", 2, 2)], BLOCK)
    assert sorted(tuple(r)[1:6] for r in liftover.best_chains(long, width).collect()) == [
        (3, 40, "x", 50 + 100_003 - 40, "-"), (40, 41, "y", 9, "+"), (41, 100_003, "x", 50, "-")]


def test_no_chains(spark):
    assert liftover.best_chains(spark.createDataFrame([], BLOCK)).count() == 0


CHAINS = """chain 100 1 1000 + 0 40 A 500 + 100 140 1
40

chain 300 1 1000 + 20 60 B 500 - 400 440 2
40

"""
CALLS = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO
1\t1\t.\tA\tG\t.\t.\t.
1\t20\t.\tA\tG\t.\t.\t.
1\t20\t.\tAC\tA\t.\t.\t.
1\t21\t.\tC\tG\t.\t.\t.
1\t59\t.\tAC\tA\t.\t.\t.
1\t61\t.\tA\tG\t.\t.\t.
"""


def test_calls_through_overlapping_chains(spark, tmp_path):
    """From call and chain files: one-base, two-base and minus-strand sites, and those across two chains."""
    (tmp_path / "c.chain").write_text(CHAINS)
    (tmp_path / "c.vcf").write_text(CALLS)
    sites = vcf.read_sites(spark, str(tmp_path / "c.vcf")).select("chrom", "pos", "ref", "alt")
    blocks = chain.read_chain(spark, str(tmp_path / "c.chain"))
    lifted = liftover.lift_over(sites, liftover.best_chains(blocks))
    new = ["pos", "ref", "new_chrom", "new_pos", "new_ref", "new_alt", "reject_reason"]
    got = sorted((tuple(r) for r in lifted.select(*new).collect()), key=str)
    assert got == sorted([
        (1, "A", "A", 101, "A", "G", None), (20, "A", "A", 120, "A", "G", None), (20, "AC", None, None, None, None, "NoTarget"),
        (21, "C", "B", 100, "G", "C", None), (59, "AC", "B", 61, "GT", "T", None), (61, "A", None, None, None, None, "NoTarget")], key=str)
    # text in pieces of five; A holds As only, B is all Gs but for one T, and its place 60 lies in another piece than 61
    text = [("A", s, "aaaaa") for s in range(100, 115, 5)] + [("B", s, "GGGGG") for s in range(50, 100, 5) if s != 60] + [("B", 60, "GTGGG")]
    reference = spark.createDataFrame(text, "chrom string, start bigint, text string")
    judged = liftover.checked_alleles(lifted, reference)
    assert judged.columns == lifted.columns
    got = sorted((tuple(r) for r in judged.select("pos", "ref", "new_pos", "reject_reason").collect()), key=str)
    assert got == sorted([
        (1, "A", 101, None), (20, "A", None, "NoReference"), (20, "AC", None, "NoTarget"), (21, "C", 100, None),
        (59, "AC", 61, None), (61, "A", None, "NoTarget")], key=str)
    wrong = spark.createDataFrame([("A", 100, "C" * 30), ("B", 50, "G" * 11), ("B", 61, "A" * 50)], "chrom string, start bigint, text string")
    got = {(r.pos, r.ref): r.reject_reason for r in liftover.checked_alleles(lifted, wrong).collect()}
    assert got[1, "A"] == got[20, "A"] == got[21, "C"] == got[59, "AC"] == "MismatchedRefAllele"


@pytest.mark.parametrize("ends", [True, False])
def test_many_copied_intervals_are_not_broadcast(spark, ends):
    """The planner expects a few bytes of an exploded table; a join with many copies is shuffled, one with few may be broadcast."""
    def met(n):
        pieces = spark.range(n).select(F.lit("1").alias("chrom"), (F.col("id") * 10).alias("iv_start"), (F.col("id") * 10 + 10).alias("iv_end"))
        points = spark.range(n // 100).select(F.lit("1").alias("chrom"), (F.col("id") * 1000 + 5).alias("pos"), (F.col("id") * 1000 + 6).alias("end"))
        if ends:
            return joins.overlap_join(points, pieces, start="pos")
        return joins.range_join(points, pieces)

    few, many = met(300), met(12_000)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    assert few.count() == 3 and many.count() == 120
    assert many.where("iv_start > pos OR pos >= iv_end").count() == 0
