"""Alleles written in one way, and records of a cohort, against plain loops."""

import random

import pytest

from strandflow.operators import alleles

REFERENCE = "chrom string, start bigint, text string"
CALLS = "sample int, chrom string, pos bigint, ref string, alt string, gt string"


def normal(pos, ref, alt, text):
    """Step by step, places from 1: drop equal last bases, take the base before where nothing is left."""
    while ref[-1] == alt[-1] and ((len(ref) > 1 and len(alt) > 1) or pos > 1):
        ref, alt = ref[:-1], alt[:-1]
        if not ref or not alt:
            pos -= 1
            ref, alt = text[pos - 1] + ref, text[pos - 1] + alt
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def pieces(chrom, text, rng):
    out, at = [], 0
    while at < len(text):
        n = rng.choice([1, 3, 16, 200])
        out.append((chrom, at, text[at:at + n]))
        at += n
    return out


@pytest.fixture(scope="module")
def genome():
    rng = random.Random(11)
    return {
        "1": "".join(rng.choice("ACGT") for _ in range(400)),
        "2": "".join(rng.choice(["A", "CA", "CACA", "G"]) for _ in range(300)),
        "3": "T" + "CA" * 250 + "G" + "A" * 400,  # longer than several stretches
    }


def sites_of(genome, rng, n):
    out = set()
    while len(out) < n:
        chrom = rng.choice(sorted(genome))
        text = genome[chrom]
        pos = rng.choice([1, 2, len(text) - 8, rng.randrange(1, len(text) - 8)])
        ref = text[pos - 1:pos - 1 + rng.randrange(1, 6)]
        kind = rng.randrange(4)
        alt = (ref[0] + text[pos:pos + rng.randrange(1, 5)] + ref[1:] if kind == 0 else ref[:rng.randrange(1, len(ref) + 1)] if kind == 1
               else "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 5))) if kind == 2 else ref + ref)
        if alt != ref:
            out.add((chrom, pos, ref, alt))
    return sorted(out)


def test_normal_alleles(spark, genome):
    rng = random.Random(4)
    sites = sites_of(genome, rng, 600)
    reference = spark.createDataFrame([p for c, t in genome.items() for p in pieces(c, t.lower() if c == "2" else t, rng)], REFERENCE)
    df = spark.createDataFrame([(c, p, r.lower() if p % 3 else r, a) for c, p, r, a in sites], "chrom string, pos bigint, ref string, alt string")
    rows = alleles.normal_alleles(df, reference).collect()
    assert len(rows) == len(sites)
    moved = 0
    for r in rows:
        want = normal(r.pos, r.ref.upper(), r.alt, genome[r.chrom].upper())
        assert (r.new_pos, r.new_ref, r.new_alt) == want, (r, want)
        moved = max(moved, r.pos - r.new_pos)
        text = genome[r.chrom]
        one = text[:r.pos - 1] + r.alt + text[r.pos - 1 + len(r.ref):]
        assert one == text[:r.new_pos - 1] + r.new_alt + text[r.new_pos - 1 + len(r.new_ref):]
    assert moved > 3 * alleles.FIRST_STRETCH


def test_other_alleles_and_no_text(spark):
    sites = [("1", 5, "A", "*"), ("1", 5, "A", "<DEL>"), ("1", 5, "A", "A"), ("9", 7, "TCC", "TC"), ("9", 7, "CAA", "AA"), ("1", None, "A", "C")]
    df = spark.createDataFrame(sites + sites, "chrom string, pos bigint, ref string, alt string")
    got = {(r.ref, r.alt): (r.new_pos, r.new_ref, r.new_alt) for r in alleles.normal_alleles(df, spark.createDataFrame([], REFERENCE)).collect()}
    assert got == {("A", "*"): (5, "A", "*"), ("A", "<DEL>"): (5, "A", "<DEL>"), ("A", "A"): (5, "A", "A"),
                   ("TCC", "TC"): (7, "TC", "T"), ("CAA", "AA"): (7, "CA", "A")}
    assert alleles.normal_alleles(df.limit(0), spark.createDataFrame([], REFERENCE)).count() == 0


def records(calls, genome):
    """Records by loops over all calls."""
    written, sites = [], {}
    for sample, chrom, pos, ref, alt, gt in calls:
        placed = [(normal(pos, ref, a, genome[chrom])) for a in alt.split(",")]
        written.append((sample, chrom, placed, gt.replace("|", "/").split("/")))
        for p, r, _ in placed:
            sites[chrom, p] = max(sites.get((chrom, p), ""), r, key=len)
    alts, held = {}, {}
    for sample, chrom, placed, gt in written:
        full = [((chrom, p, sites[chrom, p]), a + sites[chrom, p][len(r):]) for p, r, a in placed]
        for site in {s for s, _ in full}:
            alts.setdefault(site, set()).update(a for s, a in full if s == site)
            own = [full[int(h) - 1][1] for h in gt if h.isdigit() and 0 < int(h) <= len(full) and full[int(h) - 1][0] == site]
            missing = sum(not (h.isdigit() and int(h) <= len(full)) for h in gt)
            got = held.setdefault((site, sample), [[], 0, 99])
            got[0] += own
            got[1], got[2] = max(got[1], len(gt)), min(got[2], missing)
    out = {}
    for (site, sample), (own, ploidy, missing) in held.items():
        order = sorted(alts[site])
        free = max(ploidy - len(own), 0)
        blank = min(free, missing)
        gt = ["."] * blank + ["0"] * (free - blank) + [str(i) for i in sorted(order.index(a) + 1 for a in own)]
        out.setdefault((*site, ",".join(order)), {})[sample] = "/".join(gt)
    return out


def test_unified_calls(spark, genome):
    rng = random.Random(8)
    sites = [s for s in sites_of(genome, rng, 150) if s[1] > 20]
    calls = []
    for chrom, pos, ref, alt in sites:
        text = genome[chrom]
        more = [alt] + [a for a in (ref + "T", ref[0] + "GG" + ref[1:], ref[0]) if a not in (ref, alt)][: rng.randrange(3)]
        for sample in rng.sample(range(30), 4) + [0]:
            numbers = [*map(str, range(len(more) + 1)), ".", "7"]
            calls.append((sample, chrom, pos, ref, ",".join(more), rng.choice("/|").join(rng.choice(numbers) for _ in range(rng.choice([1, 2, 2, 2])))))
    # one insertion written in two ways by two samples
    calls += [(1, "3", 102, "C", "CAC", "0/1"), (2, "3", 301, "A", "ACA", "1/1")]
    reference = spark.createDataFrame([(c, 0, t) for c, t in genome.items()], REFERENCE)
    odd = [(None, "1", 30, "A", "C", "0/1"), (3, "1", 30, None, "C", "0/1"), (3, "1", 30, "A", "C", None)]
    got = alleles.unified_calls(spark.createDataFrame(calls + odd, CALLS), reference, together=7).collect()
    found = {}
    for r in got:
        entries = [e.split("=") for e in r.calls.split(";")]
        names = [int(e[0]) for e in entries]
        assert len(entries) == r.n_samples <= 7 and names == sorted(names)
        place = found.setdefault((r.chrom, r.pos, r.ref, r.alt), {})
        assert not place.keys() & set(names)
        place.update((int(k), v) for k, v in entries)
    assert found == records(calls, genome)
    assert normal(102, "C", "CAC", genome["3"]) == normal(301, "A", "ACA", genome["3"]) == (1, "T", "TCA")
    (start,) = [calls for (chrom, pos, *_), calls in found.items() if (chrom, pos) == ("3", 1)]
    assert {1, 2} <= start.keys() and set(start[1]) - set("0/.") and set(start[2]) - set("0/.")


def test_no_calls(spark):
    assert alleles.unified_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], REFERENCE)).count() == 0
