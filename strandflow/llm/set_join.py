"""Exact Jaccard self-join of word n-gram sets that skips by set relations.

Sets are joined through inverted lists over the first tokens of every set
(prefix filter). Two kinds of work are skipped. Lists are cut into blocks by set
size, and a row stands in them with the position of the token in its set, so
blocks of other sizes and rows whose positions leave too little room for common
tokens are passed over. Lists with the same rows are one list. And answers are carried over: equal sets are one set,
and sets that were found similar to a list's leader already have its answer, so
later only rows of different answers in one list are compared.

Before whole sets are compared, parity bitmaps are: bit k tells whether an odd
number of tokens fall on k, so bits that differ are never more than the tokens
that only one set holds. This rejects without error.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..shared import discarded, materialised
from .texts import WordHashes, list_array, map_batches, mixed, picked, text_bytes

#: A token in this many prefixes stands behind all others in the common order.
FREQUENT = 64

#: Leaders are drawn again while the open comparisons are more than this many per
#: list row and each turn halves them. Only the order of work depends on it.
COMPARED_PER_ROW = 40

#: First open tokens of a set that its rows carry, to tell at which token a pair meets first.
LEAD = 8


def shingle_hashes(text: bytes, words: WordHashes, n: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text (A-Z lower-cased).

    Fewer than n words make one shingle of the whole sequence; none make none.
    """
    found = text.lower().split()
    count = len(found)
    if count == 0:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(words.__getitem__, found), np.uint64, count)
    width = min(n, count)
    out = np.full(count - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : count - width + 1 + k]
    return np.unique(mixed(out).view(np.int64))


def _needed(n: Column | int, percent: int) -> Column:
    """Smallest overlap of a set of n tokens with any set similar to it."""
    return F.ceil(n * percent / 100)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _looked_at(n: int, percent: int) -> int:
    """Tokens of a set whose frequency is counted: the prefix and a reserve."""
    p = prefix_length(n, percent)
    return min(n, p + p // 4 + 4)


def parity_bits(tokens: np.ndarray, width: int) -> np.ndarray:
    """`width` parity bits (a power of two, 64 or more) of a set, as 64-bit numbers."""
    odd = np.bincount(tokens & np.int64(width - 1), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _set_rows(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int | None) -> DataFrame:
    """id, n, sig (128-bit hash of the set), bits, wide and tokens: all, or those looked at first.

    bits are 256 parity bits, wide at least as many as there are tokens.
    """

    def sets(batch: pa.RecordBatch, words: WordHashes) -> pa.RecordBatch:
        found = [shingle_hashes(t, words, n) for t in batch.column(1).to_pylist()]
        kept = found if percent is None else [u[: _looked_at(len(u), percent)] for u in found]
        widths = [max(256, 1 << len(u).bit_length()) for u in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(u) for u in found], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(u.tobytes()) for u in found], pa.binary()),
                list_array([parity_bits(u, 256) for u in found], pa.int64()),
                list_array([parity_bits(u, w) for u, w in zip(found, widths)], pa.int64()),
                list_array(kept, pa.int64()),
            ],
            names=["id", "n", "sig", "bits", "wide", "tokens"],
        )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("text"))
    return map_batches(
        rows, sets,
        "id bigint, n bigint, sig binary, bits array<bigint>, wide array<bigint>, tokens array<bigint>",
        WordHashes,
    )


def _differing(a: Column, b: Column) -> Column:
    """Bits that differ; of two lengths the longer is folded, which keeps parities."""
    fold = lambda x, m: F.when(
        F.size(x) > m, F.zip_with(F.slice(x, F.lit(1), m), F.slice(x, m + 1, m), lambda p, q: p.bitwiseXOR(q))
    ).otherwise(x)
    short = F.least(F.size(a), F.size(b))
    return F.aggregate(
        F.zip_with(fold(a, short), fold(b, short), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
        F.lit(0), lambda t, k: t + k,
    )


def _can_link(percent: int) -> Column:
    """Sizes and positions of a pair sharing a token leave room for enough common tokens.

    In the common order, common tokens before this one are at most the smaller
    position, those after it at most the smaller rest.
    """
    na, nb = F.col("a.n"), F.col("b.n")
    ra, rb = F.col("a.rank"), F.col("b.rank")
    room = F.least(ra, rb) + 1 + F.least(na - ra - 1, nb - rb - 1)
    return (
        (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        & ((100 + percent) * room >= percent * (na + nb))
        & _may_differ(
            sum(F.bit_count(F.get("a.bits", F.lit(k)).bitwiseXOR(F.get("b.bits", F.lit(k)))) for k in range(4)),
            na + nb, percent,
        )
    )


def _may_differ(differing: Column, sizes: Column, percent: int) -> Column:
    """So few differing tokens fit a similar pair with this sum of sizes."""
    return (100 + percent) * differing <= (100 - percent) * sizes


def _verified(
    pairs: DataFrame, sketch: DataFrame, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int
) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar, as a table."""
    first = sketch.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("wide").alias("wx"))
    second = sketch.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("wide").alias("wy"))
    pairs = materialised(
        pairs.join(first, "x").join(second, "y")
        .where(
            (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
            & _may_differ(_differing(F.col("wx"), F.col("wy")), F.col("nx") + F.col("ny"), percent)
        )
        .select("x", "y").distinct(),
        "pairs",
    )
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    ids = materialised(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "ids")
    involved = picked(texts, "_id", ids)
    sets = materialised(_set_rows(involved, "_id", "_text", n, None).select("id", "tokens"), "sets")
    first = sets.select(F.col("id").alias("x"), F.col("tokens").alias("tx"))
    second = sets.select(F.col("id").alias("y"), F.col("tokens").alias("ty"))
    both = F.size(F.array_intersect("tx", "ty"))
    links = materialised(
        pairs.join(first, "x").join(second, "y")
        .where((100 + percent) * both >= percent * (F.size("tx") + F.size("ty")))
        .select("x", "y"),
        "links",
    )
    discarded(pairs, ids, sets)
    return links


def _prefixes(
    sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, frequent: int
) -> DataFrame:
    """Inverted lists as a table: tok, id, n, rank (position in the common order), b (size block), bits.

    The common order is: tokens that are not frequent by hash, then frequent
    ones by hash. Frequent are those found in `frequent` or more of the looked-at
    parts; any such choice keeps the join exact, it only keeps lists short. Sets
    whose looked-at part holds too few other tokens are read again whole. What
    they hold further back was not counted yet and is as frequent where they
    are near copies, so tokens in `frequent` or more of them are frequent too.
    Tokens that stand in one list only are left out: they pair with nothing.
    """
    p = F.col("n") - _needed(F.col("n"), percent) + 1
    posts = sets.select("id", "n", F.size("tokens").alias("looked"), F.posexplode("tokens").alias("pos", "tok"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))

    def read_again(hot: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Ids of sets with too few tokens outside `hot` in the looked-at part, and these sets whole."""
        hits = picked(posts, "tok", hot.select(F.col("tok").alias("id"))).groupBy("id", "n", "looked")
        short = materialised(
            hits.agg(F.count(F.lit(1)).alias("hits")).where(F.col("looked") - F.col("hits") < p).select("id").distinct(),
            "short",
        )
        whole = _set_rows(picked(texts, "_id", short), "_id", "_text", n, None).select("id", "sig", "n", "tokens")
        return short, materialised(whole.dropDuplicates(["id", "sig"]), "again")

    counts = materialised(posts.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "counts")
    seen = materialised(counts.where(F.col("df") >= frequent).select("tok"), "seen")
    before, crowd = read_again(seen)
    further = crowd.select(F.explode("tokens").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    hot = materialised(
        further.where(F.col("df") >= frequent).select("tok").unionByName(seen).distinct(), "hot"
    )
    short, again = read_again(hot)
    discarded(seen, before, crowd)
    late = (
        again.select("id", "sig", F.explode("tokens").alias("tok")).join(hot, "tok")
        .groupBy("id", "sig").agg(F.array_sort(F.collect_list("tok")).alias("late"))
    )
    late_tokens = F.coalesce("late", F.expr("CAST(array() AS array<bigint>)"))
    order = F.concat(F.array_except("tokens", late_tokens), late_tokens)
    whole = materialised(
        again.join(late, ["id", "sig"], "left")
        .select("id", "n", F.posexplode(F.slice(order, F.lit(1), p.cast("int"))).alias("rank", "tok"))
        .select("tok", "id", "n", "rank"),
        "whole",
    )
    wanted = (
        counts.select("tok", F.lit(False).alias("late"))
        .unionByName(whole.select("tok", F.lit(False).alias("late")))
        .unionByName(hot.select("tok", F.lit(True).alias("late")))
        .groupBy("tok").agg(F.max("late").alias("late"))
    )
    before = Window.partitionBy("id", "n").orderBy("pos")
    usual = (
        posts.drop("looked").join(wanted, "tok")
        .withColumn("behind", F.sum(F.col("late").cast("int")).over(before))
        .withColumn("rank", (F.col("pos") - F.col("behind")).cast("int"))
        .where(~F.col("late") & (F.col("rank") < p))
        .join(short, "id", "left_anti")
        .select("tok", "id", "n", "rank")
    )
    block = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / (percent - 1)))).cast("int")
    every = materialised(usual.unionByName(whole), "every")
    lists = materialised(
        _different(every).withColumn("b", block).join(sets.select("id", "n", "bits"), ["id", "n"]), "lists"
    )
    discarded(counts, hot, short, again, whole, every)
    return lists


def _different(lists: DataFrame) -> DataFrame:
    """Lists of two rows or more, of those with the same rows only the one of smallest token.

    Texts that share a passage meet in one list per token of it. A similar pair passes
    every test at each of its common tokens, so one list says all that they say. Lists
    are known to be the same by their number of rows and the sums of two independent
    hashes of them: two of 10^12 different lists agree with a chance below 10^-14.
    """
    total = lambda seed: F.sum(F.xxhash64("id", "n", F.lit(seed)).cast("decimal(20,0)")).alias(f"s{seed}")
    signed = lists.groupBy("tok").agg(F.count(F.lit(1)).alias("rows"), total(0), total(1)).where("rows > 1")
    kept = signed.groupBy("rows", "s0", "s1").agg(F.min("tok").alias("tok"))
    return lists.join(kept.select("tok"), "tok", "left_semi")


def _drawn(turn: int) -> Column:
    """One row of a list block by hash: another one for every token and turn."""
    return F.min(F.struct(F.xxhash64("tok", "id", F.lit(turn)).alias("_h"), "id", "n", "rank", "bits"))


def _ordered() -> list[Column]:
    return [F.least("a.id", "b.id").alias("x"), F.greatest("a.id", "b.id").alias("y")]


def _leader_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every row of a list block against the block's leader.

    Each list draws its own leader by hash, so that a group of similar sets
    meets many leaders and is joined whole with few comparisons.
    """
    leaders = lists.groupBy("tok", "b").agg(_drawn(0).alias("lead"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return (
        lists.alias("a").join(leaders.select("tok", "b", "lead.*").alias("b"), ["tok", "b"])
        .where((F.col("a.id") != F.col("b.id")) & _can_link(percent))
        .select(*_ordered()).distinct()
    )


def _placed(lists: DataFrame, parts: DataFrame) -> tuple[DataFrame, float]:
    """Rows of lists that hold several classes so far, with class `part` and the list's
    largest class `major`; and the comparisons of rows outside it with their whole lists."""
    placed = (
        lists.join(parts.select(F.col("node").alias("id"), "component"), "id", "left")
        .withColumn("part", F.coalesce("component", "id")).drop("component")
    )
    sizes = placed.groupBy("tok", "part").agg(F.count(F.lit(1)).alias("rows"))
    largest = materialised(
        sizes.groupBy("tok").agg(
            F.max(F.struct("rows", "part")).alias("m"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("parts")
        ).where("parts > 1"),
        "largest",
    )
    work = largest.agg(F.sum((F.col("rows") - F.col("m.rows")) * F.col("rows").cast("double"))).first()[0]
    opened = materialised(placed.join(largest.select("tok", F.col("m.part").alias("major")), "tok"), "opened")
    discarded(largest)
    return opened, work or 0.0


def _drawn_pairs(opened: DataFrame, turn: int, percent: int) -> DataFrame:
    """Rows outside a list's largest class against one member of that class."""
    inside = F.col("part") == F.col("major")
    leaders = opened.where(inside).groupBy("tok", "b").agg(_drawn(turn).alias("lead")).select("tok", "b", "lead.*")
    return (
        opened.where(~inside).alias("a").join(leaders.alias("b"), ["tok", "b"])
        .where(_can_link(percent)).select(*_ordered()).distinct()
    )


def _open_pairs(opened: DataFrame, percent: int) -> DataFrame:
    """Rows of one list with different answers so far, in blocks of near sizes.

    Rows of a list's largest class are never compared with each other, so a
    group of similar sets costs its size, not its square. A pair meets in many
    lists, and a similar one passes the tests in each. Rows carry the first `LEAD`
    tokens of their set in the common order; where both sets have an earlier one
    in common, the pair has met there already and is passed over here.
    """
    first = Window.partitionBy("id").orderBy("rank", "tok")
    lead = (
        opened.select("id", "tok", "rank").withColumn("k", F.row_number().over(first)).where(F.col("k") <= LEAD)
        .groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "tok"))), lambda x: x["tok"]).alias("lead"))
    )
    opened = materialised(opened.join(lead, "id"), "led")
    minor = opened.where(F.col("part") != F.col("major")).withColumn(
        "block", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1))
    )
    met = (
        (F.col("a.tok") == F.col("b.tok")) & (F.col("a.block") == F.col("b.b"))
        & (F.col("a.part") != F.col("b.part"))
        & ((F.col("b.part") == F.col("b.major")) | (F.col("a.id") < F.col("b.id")))
        & _can_link(percent)
        & F.coalesce(F.get(F.array_intersect("a.lead", "b.lead"), F.lit(0)) == F.col("a.tok"), F.lit(True))
    )
    return minor.alias("a").join(opened.alias("b"), met).select(*_ordered()).distinct()


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 4,
    percent: int = 85,
    frequent: int = FREQUENT,
) -> DataFrame:
    """id_col, n_shingles, component_id of every row: classes of n-gram sets that link.

    Two sets link when 100 * intersection >= percent * union. component_id is
    the smallest id reachable by links. The result is that of comparing all
    pairs. Null or wordless texts have an empty set and link with nothing. Rows
    that repeat an id are nodes of one document: they share its links, and each
    gives a row. Rows without an id give a row without a component. Other
    columns, whatever their names, are not looked at. An empty table gives an
    empty result. Whole texts are read a second time only
    where a possible partner is left.
    """
    named = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    sketch = materialised(_set_rows(named, "_doc", "_text", n, percent), "sketch")
    filled = sketch.where("n > 0 AND id IS NOT NULL")
    classes = materialised(filled.groupBy("sig").agg(F.min("id").alias("rep"), F.max("n").alias("_n")), "classes")
    firsts = materialised(
        filled.join(classes.select(F.col("rep").alias("id"), "sig"), ["id", "sig"], "left_semi"), "firsts"
    )
    rows = materialised(sketch.select("id", "n", "sig"), "rows")
    discarded(sketch)
    sketch, filled = rows, rows.where("n > 0 AND id IS NOT NULL")
    lists = _prefixes(firsts, named, "_doc", "_text", n, percent, frequent)
    links, turn = _verified(_leader_pairs(lists, percent), firsts, named, "_doc", "_text", n, percent), 0
    held, last = lists.count(), float("inf")
    while True:
        parts = materialised(connected_components(links, "x", "y"), "parts")
        stars = parts.where(F.col("node") != F.col("component")).select(
            F.col("component").alias("x"), F.col("node").alias("y")
        )
        opened, work = _placed(lists, parts)
        if work <= COMPARED_PER_ROW * held or work > last / 2:
            break
        turn, last = turn + 1, work
        found = _verified(_drawn_pairs(opened, turn, percent), firsts, named, "_doc", "_text", n, percent)
        links = stars.unionByName(found)
        discarded(opened)
    far = _verified(_open_pairs(opened, percent), firsts, named, "_doc", "_text", n, percent)
    discarded(lists, opened, firsts)
    same = classes.join(
        filled.select("id", "sig").distinct(), "sig"
    ).where(F.col("rep") != F.col("id")).select(F.col("rep").alias("x"), F.col("id").alias("y"))
    twice = filled.select("id", "sig").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    copies = same.join(twice.select(F.col("id").alias("y")), "y", "left_semi").select("x", "y")
    ends = materialised(
        connected_components(stars.unionByName(far).unionByName(copies), "x", "y")
        .select(F.col("node").alias("rep"), "component"),
        "ends",
    )
    discarded(far)
    out = sketch.select("id", "n", "sig").join(classes.select("sig", "rep"), "sig", "left").join(ends, "rep", "left")
    own = F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(
        F.coalesce("component", "rep", "id")
    )
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id")
    )
