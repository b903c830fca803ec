"""A Merkle manifest of a dataset: one tree per group, a tree over the groups, a proof per row.

Trees are built level by level: `fan` neighbours become their parent, by a
partial aggregate whose groups hold `fan` rows. Proofs come from pointer
jumping. Every node starts with a pointer to its parent and the segment of
siblings on that step. A round joins the table with itself on the pointers: the
ancestor's segment is appended and its pointer taken over, so the distance
doubles, and leaves of a tree of any height reach its root in a number of rounds
that is the logarithm of the height. Only nodes that a later round can meet stay
in the table, so after the first round it is hardly longer than the leaves.

Many leaves share an ancestor. A node's place in its level tells its ancestors,
so rows are joined by (ancestor, block of `block` neighbours) and an ancestor is
copied once per block below it: no join key ever has more than `block` rows on
one side, however large a group is.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import BUCKET, global_index, ranged, scan
from ..shared import discarded, materialised

SEGMENT = "array<struct<left:binary,right:binary>>"

#: Rows of one group that meet one copy of the group's own row.
GROUP_BLOCK = 100_000


def field(value: Column) -> Column:
    """A value as it enters a digest: `-` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def row_digest(values: Sequence[Column]) -> Column:
    """Lower-case hex sha256 of the values, one after the other."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _text(digests: Column) -> Column:
    """One or several 32-byte digests, as hex text."""
    return F.lower(F.hex(digests))


def _step(kids: Column) -> Column:
    """Siblings of `node` in its run (a list of places and digests in order): those before, those behind."""
    joined = lambda part: F.aggregate(part, F.lit(b""), lambda s, x: F.concat(s, x["digest"]))
    return F.struct(
        joined(F.filter(kids, lambda x: x["i"] < F.col("node.i"))).alias("left"),
        joined(F.filter(kids, lambda x: x["i"] > F.col("node.i"))).alias("right"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root (hex) that a leaf digest (hex) has under a proof."""
    return F.aggregate(
        proof, leaf, lambda at, x: F.sha2(F.concat(_text(x["left"]), at, _text(x["right"])), 256)
    )


def proof_digest(proof: Column) -> Column:
    """sha256 (hex) of a proof's siblings as hex text, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(_text(x["left"]), _text(x["right"]))), ""), 256)


def forest_proofs(leaves: DataFrame, fan: int = 3, block: int = 243) -> tuple[DataFrame, DataFrame]:
    """Proofs of all leaves up to the root of their own tree, and the roots.

    leaves: tree, i (0-based place), n (leaves of the tree), digest (binary) and
    other columns, which are kept. Returns the leaves with `proof`, and tree, root.
    Runs of `fan` neighbours become one node while a tree has several; the last
    run may be shorter. A lone leaf is its root and has an empty proof. `block`
    must be a power of `fan`.
    """
    names = leaves.columns
    size = leaves.agg(F.max("n")).first()[0] or 0
    own = F.struct(*[F.col(f"`{c}`") for c in names])
    level, tables, tops, steps = 0, [], [], []
    now = leaves.select("tree", "i", "n", "digest")
    left = size
    while left > 1:
        tops.append(now.where("n = 1").select("tree", F.col("digest").alias("root")))
        runs = materialised(
            now.where("n > 1").groupBy("tree", F.expr(f"i DIV {fan}").alias("p"))
            .agg(F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("kids"), F.max("n").alias("n"))
            .withColumn(
                "digest", F.unhex(F.sha2(F.array_join(F.transform("kids", lambda x: _text(x["digest"])), ""), 256))
            ),
            "runs",
        )
        tables.append(runs)
        steps.append(
            runs.select("tree", "n", "kids", F.explode("kids").alias("node"))
            .select("tree", F.lit(level).alias("l"), F.col("node.i").alias("i"), "n", F.array(_step(F.col("kids"))).alias("seg"))
        )
        now = runs.select("tree", F.col("p").alias("i"), F.expr(f"(n + {fan - 1}) DIV {fan}").alias("n"), "digest")
        left, level = -(-left // fan), level + 1
    tops.append(now.where("n = 1").select("tree", F.col("digest").alias("root")))
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    roots = materialised(roots, "roots")
    named = leaves.select("tree", "i", "n", own.alias("own"))
    if not steps:
        return named.select("own.*", F.array().cast(SEGMENT).alias("proof")), roots
    bottom = (
        named.join(steps[0].select("tree", "i", "seg"), ["tree", "i"], "left")
        .select("tree", F.lit(0).alias("l"), "i", "n", F.coalesce("seg", F.array().cast(SEGMENT)).alias("seg"), "own")
    )
    for more in steps[1:]:
        bottom = bottom.unionByName(more.withColumn("own", F.lit(None).cast(leaves.select(own).schema[0].dataType)))
    state = materialised(bottom, "pointers")
    discarded(*tables)
    reach = 1
    while fan**reach < size:
        below = fan**reach
        above = state.where(F.col("l") % (2 * reach) == reach).select(
            F.col("tree").alias("tree_"), F.col("l").alias("l_"), F.col("i").alias("i_"), F.col("seg").alias("seg_"),
            F.explode(F.sequence(F.expr(f"i * {below} DIV {block}"), F.expr(f"((i + 1) * {below} - 1) DIV {block}")))
            .alias("block_"),
        )
        met = (
            (F.col("tree") == F.col("tree_")) & (F.col("l") + reach == F.col("l_"))
            & (F.expr(f"i DIV {below}") == F.col("i_")) & (F.expr(f"i DIV {block}") == F.col("block_"))
        )
        far = F.coalesce(F.concat("seg", "seg_"), "seg").alias("seg")
        jumped = state.where(F.col("l") % (2 * reach) == 0).join(above, met, "left").select(
            "tree", "l", "i", "n", far, "own"
        )
        last, state = state, materialised(jumped, "pointers")
        discarded(last)
        reach *= 2
    return state.where("l = 0").select("own.*", F.col("seg").alias("proof")), roots


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with i and n: the place in its tree (column `tree`) by `order`, and the rows of the tree.

    Equal rows are counted first and placed side by side, so no order is undefined
    and a row repeated often is sorted once. No tree is sorted in one task.
    """
    names = rows.columns
    counted = ranged(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("times")), ["tree"], order)
    started = scan(counted, ["tree"], order, {"first": ("sum", "times")}, inclusive=False).drop(BUCKET)
    single = started.select(
        *names, F.explode(F.sequence(F.col("first"), F.expr("first + times - 1"))).alias("i")
    ).withColumn("_block", F.expr(f"i DIV {GROUP_BLOCK}"))
    sizes = counted.groupBy("tree").agg(F.sum("times").alias("n")).withColumn(
        "_block", F.explode(F.expr(f"sequence(0, (n - 1) DIV {GROUP_BLOCK})"))
    )
    return single.join(sizes, ["tree", "_block"]).drop("_block")


def manifest(
    rows: DataFrame, values: Sequence[str], group: str = "source", id_col: str = "doc_id", fan: int = 3,
    carried: Sequence[Column] = (),
) -> DataFrame:
    """id_col, leaf, subroot, root (hex), proof and the carried columns, of every row.

    A leaf is the digest of the row's `values`. Leaves of one group ascend by
    id_col (null first; equal ids by digest) and make a tree, whose root is the
    group's subroot; subroots, ordered by group (null first, UTF-8 bytewise), make
    the tree of `root`. `proof` lists, from the leaf up to the root, the siblings
    before and behind: `folded(leaf, proof)` is the root. Nulls differ from empty
    texts. Repeated rows are leaves of their own, side by side. Columns that are not
    named, whatever they are called, are not looked at. Whole texts are digested;
    nothing but digests is shuffled. An empty table gives an empty result.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    slim = rows.select(
        key.alias("tree"), F.col(id_col).alias("id"),
        F.unhex(row_digest([F.col(v) for v in values])).alias("digest"), F.struct(F.lit(0).alias("_"), *carried).alias("carried"),
    )
    leaves = materialised(placed(slim, ["id", "digest", "carried"]), "leaves")
    proven, subroots = forest_proofs(leaves, fan)
    numbered = materialised(
        global_index(subroots.select("tree", "root"), "tree", "i").join(F.broadcast(subroots.agg(F.count(F.lit(1)).alias("n")))),
        "groups",
    )
    upper, top = forest_proofs(
        numbered.select(F.lit("").alias("tree"), "i", "n", F.col("root").alias("digest"), F.col("tree").alias("group")), fan
    )
    sizes = leaves.groupBy("tree").agg(F.max("n").alias("n"))
    above = (
        upper.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("upper"))
        .join(sizes, "tree")
        .withColumn("_block", F.explode(F.expr(f"sequence(0, (n - 1) DIV {GROUP_BLOCK})"))).drop("n")
    )
    both = proven.withColumn("_block", F.expr(f"i DIV {GROUP_BLOCK}")).join(above, ["tree", "_block"])
    return both.select(
        F.col("id").alias(id_col), _text(F.col("digest")).alias("leaf"), _text(F.col("subroot")).alias("subroot"),
        _text(top.select("root").scalar()).alias("root"), F.concat("proof", "upper").alias("proof"), "carried",
    )
