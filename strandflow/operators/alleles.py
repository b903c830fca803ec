"""One way of writing for every allele, and sites joined over a cohort whatever their callers wrote.

An allele is written as short as it goes and as far left as it goes: bases that both alleles
share are cut behind and in front, and an insertion or deletion moves left over the reference
while the base before it equals its own last base.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut_lineage, materialised
from .joins import range_join, spread_join
from .ordered import global_index

SITE = ["chrom", "pos", "ref", "alt"]
#: Bases compared in the first round of moving left; every round doubles them.
FIRST_STRETCH = 64
#: Samples whose calls stand in one row of a cohort's site.
SAMPLES_TOGETHER = 1000


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix of two texts; places are compared only where both have several letters."""
    n = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), n + 1), lambda i: (i <= n) & (F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    return F.when(n <= 1, (F.left(a, n) == F.left(b, n)).cast("int") * n).otherwise(F.array_position(same, F.lit(False)) - 1).cast("int")


def _cut(text: Column, front: Column, behind: Column) -> Column:
    return F.substr(text, front + 1, F.greatest(F.length(text) - front - behind, F.lit(0)))


def normal_alleles(sites: DataFrame, reference: DataFrame, first: int = 1) -> DataFrame:
    """Distinct chrom, pos, ref, alt (one allele each) with new_pos, new_ref, new_alt.

    Reference: chrom, start (from 0), text; pieces do not overlap. An allele moves no further
    than the text is known, one base of which must stay before it; without any text it stays
    at its place. Alleles that are no bases (`*`, `<DEL>`, `.`) or equal the reference keep
    their form. Upper case is given back.
    """
    keyed = sites.dropna(subset=SITE).select(*SITE).distinct().withColumns({"_r": F.upper("ref"), "_a": F.upper("alt")})
    plain = F.col("_a").rlike("^[A-Z]+$") & F.col("_r").rlike("^[A-Z]+$") & (F.col("_a") != F.col("_r"))
    behind = F.when(plain, _shared(F.reverse("_r"), F.reverse("_a"))).otherwise(0)
    cut = keyed.withColumn("_behind", behind).withColumns(
        {"_r1": _cut(F.col("_r"), F.lit(0), F.col("_behind")), "_a1": _cut(F.col("_a"), F.lit(0), F.col("_behind"))}
    )
    cut = cut.withColumn("_front", F.when(plain, _shared(F.col("_r1"), F.col("_a1"))).otherwise(0)).withColumns(
        {"_r2": _cut(F.col("_r1"), F.col("_front"), F.lit(0)), "_a2": _cut(F.col("_a1"), F.col("_front"), F.lit(0))}
    )
    moves = plain & ((F.col("_r2") == "") | (F.col("_a2") == ""))
    cut = materialised(
        cut.withColumns({
            "_moves": moves, "unit": F.concat("_r2", "_a2"), "place": F.col("pos") - first + F.col("_front"),
        }), "alleles"
    )
    # substitutions: without the shared ends, at the place of their first base
    still = cut.where(~F.col("_moves")).select(
        *SITE, (F.col("pos") + F.col("_front")).alias("new_pos"), F.col("_r2").alias("new_ref"), F.col("_a2").alias("new_alt")
    )
    units = cut.where("_moves").withColumn("moved", F.lit(0).cast("bigint"))
    pieces = materialised(_pieces(reference), "pieces")
    settled = _moved_left(units, pieces)

    before = range_join(
        settled.withColumn("_at", F.col("place") - F.col("moved") - 1), pieces, pos="_at", how="left", spread_by=["pos", "alt"],
    )
    known = F.substr("text", (F.col("_at") - F.col("iv_start") + 1).cast("int"), F.lit(1))
    length = F.length("unit").cast("bigint")

    def turned(steps: Column) -> Column:
        k = F.pmod(steps, length).cast("int")
        return F.concat(F.substr("unit", F.length("unit") - k + 1, k), F.substr("unit", F.lit(1), F.length("unit") - k))

    # at the edge of the text the last step is taken back: its base is known, it was compared
    back = known.isNull() & (F.col("moved") > 0)
    steps = F.col("moved") - back.cast("bigint")
    anchor = F.when(back, F.substr("unit", (length - F.pmod(F.col("moved") - 1, length)).cast("int"), F.lit(1))).when(
        (F.col("moved") == 0) & (F.col("_front") > 0), F.substr("_r1", F.col("_front"), F.lit(1))
    ).otherwise(known)
    shift = before.withColumns({"_steps": steps, "_anchor": anchor}).withColumn("_unit", turned(F.col("_steps")))
    lost, whole = F.col("_a2") == "", F.col("_anchor").isNull()
    # nothing known in front: one of the shared bases behind stays
    after = F.substr("_r", F.length("_r") - F.col("_behind") + 1, F.lit(1))
    left = shift.select(
        *SITE,
        F.when(whole, F.col("pos")).otherwise(F.col("place") - F.col("_steps") - 1 + first).alias("new_pos"),
        F.when(whole, F.concat("_r2", after)).otherwise(F.concat("_anchor", F.when(lost, F.col("_unit")).otherwise(""))).alias("new_ref"),
        F.when(whole, F.concat("_a2", after)).otherwise(F.concat("_anchor", F.when(lost, "").otherwise(F.col("_unit")))).alias("new_alt"),
    )
    return still.unionByName(left)


def _pieces(reference: DataFrame) -> DataFrame:
    start = F.col("start").cast("bigint")
    return reference.where("length(text) > 0").select(
        "chrom", start.alias("iv_start"), (start + F.length("text")).alias("iv_end"), F.upper("text").alias("text")
    )


def _moved_left(units: DataFrame, pieces: DataFrame) -> DataFrame:
    """`moved`: over how many bases each unit moves. Only units that fitted a whole stretch go on."""
    done, stretch = None, FIRST_STRETCH
    going = units
    while True:
        seen = range_join(
            going.withColumn("_at", F.col("place") - F.col("moved") - 1), pieces, pos="_at", how="left", spread_by=["pos", "alt"]
        )
        upto = (F.col("_at") - F.col("iv_start") + 1).cast("int")
        behind = F.split(F.reverse(F.substr("text", F.greatest(upto - stretch + 1, F.lit(1)), F.least(upto, F.lit(stretch)))), "")
        unit = F.split(F.reverse("unit"), "")
        n = F.least(upto, F.lit(stretch))

        def fits(s: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), n),
                lambda i: (i < n) & F.coalesce(F.get(s["behind"], i) == F.get(s["unit"], F.pmod(F.col("moved") + i, F.size(s["unit"])).cast("int")), F.lit(False)),
            )

        # both lists stand in a list of one, so that they are split once a row and not once a base
        once = F.get(F.transform(F.array(F.struct(behind.alias("behind"), unit.alias("unit"))), fits), F.lit(0))
        more = F.coalesce(F.array_position(once, F.lit(False)) - 1, F.lit(0))
        step = cut_lineage(
            seen.withColumns({"_more": more, "_open": F.coalesce(more == n, F.lit(False))})
            .withColumn("moved", (F.col("moved") + F.col("_more")).cast("bigint"))
            .select(*units.columns, "_open")
        )
        ended = step.where(~F.col("_open")).drop("_open")
        done = ended if done is None else done.unionByName(ended)
        going = step.where("_open").drop("_open")
        if going.isEmpty():
            return done
        stretch *= 2


def unified_calls(geno: DataFrame, reference: DataFrame, first: int = 1, together: int = SAMPLES_TOGETHER) -> DataFrame:
    """Sites of a cohort, all alleles of one place in one record, calls in blocks of samples.

    Calls: sample, chrom, pos, ref, alt (alleles joined by commas), gt. Gives chrom, pos, ref, alt,
    block, n_samples, calls (`sample=gt` by sample, joined by `;`): at most `together` samples a row.

    The record's reference allele is the longest of its place, the others are filled up to it. One that
    contradicts it has its own record. Alternative alleles are sorted. A sample that has an
    alternative allele at another place has the reference here; missing alleles, and numbers
    without an allele, stay missing unless another row of the sample and place knows them. Phase is not kept.
    If the rows of a sample hold more alternative alleles than its ploidy, all are listed.
    Rows with a null in these columns are left out.
    """
    calls = materialised(geno.dropna(subset=["sample", *SITE, "gt"]).select("sample", *SITE, "gt"), "calls")
    written = materialised(
        calls.select(*SITE).distinct().select(*SITE, F.posexplode(F.split("alt", ",")).alias("number", "allele")), "written"
    )
    single = written.select("chrom", "pos", "ref", F.col("allele").alias("alt"))
    normal = normal_alleles(single, reference, first).withColumnRenamed("alt", "allele")
    placed = materialised(written.join(normal, ["chrom", "pos", "ref", "allele"]), "placed")

    spot = ["chrom", "new_pos"]
    longest = placed.groupBy(*spot).agg(F.max(F.struct(F.length("new_ref").alias("n"), "new_ref"))["new_ref"].alias("_long"))
    agrees = F.startswith(F.col("_long"), F.col("new_ref"))
    rest = F.substr("_long", F.length("new_ref") + 1, F.length("_long"))
    is_text = F.col("new_alt").rlike("^[A-Z]+$")
    filled = materialised(
        placed.join(longest, spot).select(
            *SITE, "number", "new_pos", F.when(agrees, F.col("_long")).otherwise(F.col("new_ref")).alias("site_ref"),
            F.when(agrees & is_text, F.concat("new_alt", rest)).otherwise(F.col("new_alt")).alias("site_alt"),
        ), "filled"
    )
    site = [*spot, "site_ref"]
    alts = filled.groupBy(*site).agg(F.array_sort(F.collect_set("site_alt")).alias("alts"))
    # per written site and record: which allele number is which of the record's alternatives
    numbers = (
        filled.join(alts, site)
        .select(*SITE, "new_pos", "site_ref", "alts", F.struct(
            (F.col("number") + 1).cast("string").alias("old"), F.array_position("alts", F.col("site_alt")).cast("int").alias("new")
        ).alias("n"))
        .groupBy(*SITE, "new_pos", "site_ref", "alts").agg(F.collect_list("n").alias("numbers"))
    )
    every = written.groupBy(*SITE).agg(F.count(F.lit(1)).alias("n_alts"))
    met = spread_join(calls, numbers.join(every, SITE), SITE, ["sample"])
    held = F.split("gt", r"[/|]")
    own = F.flatten(F.transform(held, lambda h: F.transform(F.filter("numbers", lambda n: n["old"] == h), lambda n: n["new"])))
    known = lambda h: F.coalesce(h.try_cast("int").between(0, F.col("n_alts")), F.lit(False))
    rows = met.select(
        "sample", *site, "alts", own.alias("own"), F.size(held).alias("ploidy"),
        F.size(F.filter(held, lambda h: ~known(h))).alias("missing"),
    )
    merged = rows.groupBy("sample", *site, "alts").agg(
        F.array_sort(F.flatten(F.collect_list("own"))).alias("own"), F.max("ploidy").alias("ploidy"), F.min("missing").alias("missing")
    )
    free = F.greatest(F.col("ploidy") - F.size("own"), F.lit(0))
    blank = F.least(free, F.col("missing"))
    genotype = F.concat_ws(
        "/", F.array_repeat(F.lit("."), blank), F.array_repeat(F.lit("0"), free - blank), F.transform("own", lambda i: i.cast("string"))
    )
    samples = materialised(global_index(calls.select("sample").distinct(), "sample", "at"), "samples")
    blocks = merged.withColumn("gt", genotype).join(
        samples.select("sample", F.floor(F.col("at") / together).cast("int").alias("block")), "sample"
    )
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("sample", "gt"))), lambda s: F.concat(s["sample"].cast("string"), F.lit("="), s["gt"])
    )
    return blocks.groupBy(*site, "alts", "block").agg(
        F.count(F.lit(1)).alias("n_samples"), F.array_join(listed, ";").alias("calls")
    ).select(
        "chrom", F.col("new_pos").alias("pos"), F.col("site_ref").alias("ref"), F.array_join("alts", ",").alias("alt"),
        "block", "n_samples", "calls",
    )
