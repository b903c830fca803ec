"""All pairs of vectors within a cosine threshold, by dual traversal of cover trees.

Unit vectors are compared by their distance: cosine >= c means distance <=
sqrt(2 - 2 c). Upper levels of the tree are made in Spark: a cell with more than
`block` vectors is split around pivots drawn from it, level by level, until every
cell fits in a block. Inside a block a cover tree is built: nested levels whose
radii halve, every node a centre that also stands on the next level, its points
side by side, its covering radius measured. The traversal descends both trees at
once from the pair (root, root) and drops a pair of nodes when their centres are
farther apart than the threshold and both covering radii; in Spark down to pairs
of blocks, in tasks below them. Bounds are widened by a rounding margin and what
is left is compared by its cosine, so the pairs are exactly those of comparing all.
"""

import math
import pickle
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..shared import discarded, materialised, new_folder
from .texts import bound_batches

BLOCK = 4096
PIVOTS = 512
DEPTH = 6  # levels split around pivots; larger cells are then cut by hash
MARGIN = 1e-7
SMALLEST = 2.0**-7  # radius of the last level
AT_ONCE = 1 << 18  # pairs of points compared without going further down
PER_NODE_PAIR = 1 << 10  # pairs of points that cost as much as one open pair of nodes
CELLS_A_FILE = 4
ROUND_BYTES = 32 << 20  # of blocks that all executors hold at once while the others stream past


def _given(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as a matrix, in the precision in which they stand."""
    kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
    return np.array(column.to_pylist(), kind)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors as doubles, each scaled to a largest component of 1."""
    x = x.astype(np.float64)
    return x / np.abs(x).max(axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return _scaled(_given(column))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Tree:
    """A cover tree over unit vectors: `order` puts the points of every node side by side.

    levels[k] = (centre, start, end, radius) of the nodes of level k, whose points
    are within 2 / 2**k of the centre (`radius` is the measured maximum). Level 0 is
    the root; a node's children are the nodes of the next level in its range.
    """

    def __init__(self, units: np.ndarray):
        n = len(units)
        self.order = np.arange(n)
        reach = _apart(units, units[:1])[:, 0] if n else np.zeros(0)
        root = (np.zeros(1, int), np.zeros(1, int), np.full(1, n), np.full(1, reach.max() if n else 0.0))
        self.levels = [root]
        radius = 1.0
        while radius >= SMALLEST and (self.levels[-1][2] - self.levels[-1][1] > 1).any():
            self.levels.append(self._next(units, radius))
            radius /= 2

    def _next(self, units: np.ndarray, radius: float) -> tuple[np.ndarray, ...]:
        centres, starts, ends, radii = [], [], [], []
        for centre, start, end, far in zip(*self.levels[-1]):
            own = self.order[start:end]
            if far <= radius:
                groups = [(centre, own, far)]
            else:
                groups, left = [], own
                pick = centre
                while len(left):
                    near = _apart(units[left], units[pick : pick + 1])[:, 0]
                    near[left == pick] = 0.0
                    inside = near <= radius
                    groups.append((pick, left[inside], near[inside].max()))
                    left = left[~inside]
                    pick = left[0] if len(left) else -1
            at = start
            for pick, points, reach in groups:
                self.order[at : at + len(points)] = points
                centres.append(pick)
                starts.append(at)
                at += len(points)
                ends.append(at)
                radii.append(reach)
        return np.array(centres), np.array(starts), np.array(ends), np.array(radii)


class _Links:
    """Counts and connecting pairs of the links found between two sets of points."""

    def __init__(self, a: int, b: int, weight_a: np.ndarray, weight_b: np.ndarray):
        self.count_a, self.count_b = np.zeros(a, np.int64), np.zeros(b, np.int64)
        self.weight_a, self.weight_b = weight_a, weight_b
        self.up = {}

    def top(self, node: int) -> int:
        up = self.up
        while (above := up.get(node, node)) != node:
            up[node] = up.get(above, above)
            node = above
        return node

    def join(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """Rows and columns (as nodes of one numbering) are one class."""
        first = self.top(int(rows[0]))
        for node in (*rows.tolist(), *cols.tolist()):
            self.up[self.top(node)] = first

    def add(self, rows: np.ndarray, cols: np.ndarray, hit: np.ndarray, shift: int) -> None:
        """hit[i, j]: point rows[i] of the one set links with point cols[j] of the other."""
        self.count_a[rows] += hit @ self.weight_b[cols]
        self.count_b[cols] += self.weight_a[rows] @ hit
        left = hit.any(axis=1)
        while left.any():  # one class of the linked points at a time
            inside = np.zeros(len(rows), bool)
            inside[np.flatnonzero(left)[0]] = True
            while True:
                across = hit[inside].any(axis=0)
                wider = hit[:, across].any(axis=1)
                if (wider == inside).all():
                    break
                inside = wider
            self.join(rows[inside], cols[across] + shift)
            left &= ~inside


def linked(a: dict, b: dict, threshold: float, same: bool) -> _Links:
    """Links between the points of two blocks by dual traversal, or inside one block.

    a, b: x (vectors), unit, norm, w (copies of each), tree. Inside a block every pair
    of points is met once, and a point does not link with itself. Pairs of nodes
    that are within the threshold as a whole are not taken apart further.
    """
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    shift = 0 if same else len(a["x"])
    out = _Links(len(a["x"]), len(b["x"]), a["w"], b["w"])

    def level(tree: Tree, k: int) -> tuple[np.ndarray, ...]:
        return tree.levels[min(k, len(tree.levels) - 1)]

    def compare(i: tuple[int, int], j: tuple[int, int]) -> None:
        rows, cols = a["tree"].order[i[0] : i[1]], b["tree"].order[j[0] : j[1]]
        for at in range(0, len(rows), 1024):
            some = rows[at : at + 1024]
            cosine = (a["x"][some] @ b["x"][cols].T) / (a["norm"][some, None] * b["norm"][cols])
            hit = cosine >= threshold
            if same and i == j:
                hit &= some[:, None] < cols
            if hit.any():
                out.add(some, cols, hit, shift)

    pairs = [((0, len(a["x"])), (0, len(b["x"])))]
    for k in range(1, max(len(a["tree"].levels), len(b["tree"].levels))):
        ca, sa, ea, ra = level(a["tree"], k)
        cb, sb, eb, rb = level(b["tree"], k)
        after = []
        for i, j in pairs:
            if (i[1] - i[0]) * (j[1] - j[0]) <= AT_ONCE:
                compare(i, j)
                continue
            ia, jb = np.searchsorted(sa, i), slice(*np.searchsorted(sb, j))
            most = (i[1] - i[0]) * (j[1] - j[0]) // PER_NODE_PAIR
            near, count = [], 0
            for at in range(ia[0], ia[1], 512):
                some = slice(at, min(ia[1], at + 512))
                apart = _apart(a["unit"][ca[some]], b["unit"][cb[jb]])
                reach = ra[some, None] + rb[jb]
                p, q = np.nonzero(apart <= limit + reach + MARGIN)
                count += len(p)
                if count > most:
                    break
                near.append((p + at, q + jb.start, apart[p, q] + reach[p, q] <= limit))
            if count > most:  # the bounds drop too little here: compare the points at once
                compare(i, j)
                continue
            for p, q, whole in zip(*(np.concatenate(part).tolist() for part in zip(*near))):
                one, two = (int(sa[p]), int(ea[p])), (int(sb[q]), int(eb[q]))
                if same and i == j and two < one:
                    continue
                if whole:
                    compare(one, two)
                else:
                    after.append((one, two))
        pairs = after
    for i, j in pairs:
        compare(i, j)
    return out


def _dealt(rows: DataFrame, pivots: DataFrame, own: list[str], schema) -> DataFrame:
    """Every row with its nearest pivot's cell and the distance `far`, slice by slice."""

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.select([*own, "cell"]).append_column("far", pa.array([], pa.float64()))
        cosine = _unit(_matrix(left["embedding"])) @ _unit(_matrix(right["embedding"])).T
        best = cosine.argmax(axis=1)
        far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine[np.arange(len(best)), best]))
        number = right["k"].to_numpy()[best].tolist()
        cells = [f"{c}/{k}" for c, k in zip(left["cell"].to_pylist(), number)]
        return left.select(own).append_column("cell", pa.array(cells)).append_column("far", pa.array(far))

    return rows.groupBy("cell", "_slice").cogroup(pivots.groupBy("cell", "_slice")).applyInArrow(nearest, schema)


def _placed(vectors: DataFrame, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """Vectors with their `cell`, and per split the new cells: node, parent, centre, radius.

    A cell of more than `block` vectors is split around its own vectors, drawn by
    hash, up to 512 of them; each vector goes to the nearest. The work is dealt out
    in slices of a cell, to which the cell's pivots are copied. Cells that are still
    too large after six splits (near copies without number) are cut by hash; such
    parts have no centre.
    """
    own = vectors.columns
    placed = vectors.withColumn("cell", F.concat(F.lit("d"), F.size("embedding").cast("string")))
    nodes = []
    for depth in range(DEPTH + 1):
        large = materialised(
            placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block), "large"
        )
        if large.isEmpty():
            break
        slices = F.ceil(F.col("n") / block).cast("bigint")
        marked = placed.join(large, "cell", "left").withColumn("_slice", F.pmod("h", slices))
        rest = marked.where("n IS NULL").select(*own, "cell")
        inside = marked.where("n IS NOT NULL")
        if depth == DEPTH:
            parts = inside.withColumn("parent", F.col("cell")).withColumn(
                "cell", F.concat_ws("/", "cell", F.concat(F.lit("s"), F.col("_slice").cast("string")))
            )
            nodes.append(parts.select(
                F.col("cell").alias("node"), "parent", F.lit(None).cast("array<double>").alias("centre"),
                F.lit(2.0).alias("radius"),
            ).distinct())
            placed = rest.unionByName(parts.select(*own, "cell"))
            break
        draw = Window.partitionBy("cell").orderBy(F.xxhash64("h", F.lit(depth)), "h", "rep")
        drawn = materialised(
            inside.withColumn("_k", F.row_number().over(draw)).where(F.col("_k") <= PIVOTS)
            .where(F.col("_k") <= F.ceil(2 * F.col("n") / block))
            .select("cell", "n", F.col("_k").cast("bigint").alias("k"), "embedding"),
            "pivots",
        )
        copied = drawn.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        schema = placed.select(*own, "cell").withColumn("far", F.lit(0.0)).schema
        split = materialised(_dealt(inside.select(*own, "cell", "_slice"), copied, own, schema), "cells")
        centres = drawn.select(
            F.concat_ws("/", "cell", F.col("k").cast("string")).alias("node"), F.col("cell").alias("parent"),
            F.col("embedding").cast("array<double>").alias("centre"),
        )
        reach = split.groupBy(F.col("cell").alias("node")).agg(F.max("far").alias("radius"))
        nodes.append(materialised(centres.join(reach, "node"), "nodes"))
        placed = rest.unionByName(split.select(*own, "cell"))
    return placed, nodes


def _distance(a: Column, b: Column) -> Column:
    """Distance of the directions of two vectors, in SQL functions; 0 where one is missing."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v
    )
    cosine = dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
    return F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * cosine)), F.lit(0.0))


def _block_pairs(placed: DataFrame, nodes: list[DataFrame], limit: float) -> DataFrame:
    """Pairs (a, b) of cells that the covering radii of the cells' tree leave open, a = b included.

    Both trees are descended at once, a level per step: every open pair is replaced by
    the pairs of its children (a cell without children stays), far ones are dropped.
    """
    leaves = placed.select(F.col("cell").alias("node")).distinct()
    pairs = leaves.select(F.split("node", "/")[0].alias("a")).distinct().withColumn("b", F.col("a"))
    if not nodes:
        return pairs
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    every = materialised(every, "tree")
    kept = leaves.join(every, "node", "left").select(
        F.col("node").alias("parent"), "node", "centre", F.coalesce("radius", F.lit(2.0)).alias("radius")
    )
    step = materialised(every.select("parent", "node", "centre", "radius").unionByName(kept), "step")
    first = step.select(*[F.col(c).alias(f"a_{c}") for c in step.columns])
    second = step.select(*[F.col(c).alias(f"b_{c}") for c in step.columns])
    for _ in nodes:
        pairs = (
            pairs.join(first, F.col("a") == F.col("a_parent")).join(second, F.col("b") == F.col("b_parent"))
            .where((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))
            .where(
                F.col("a_node").eqNullSafe(F.col("b_node"))
                | (_distance(F.col("a_centre"), F.col("b_centre")) <= F.col("a_radius") + F.col("b_radius") + limit + MARGIN)
            )
            .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        )
    return pairs


def _packed_blocks(placed: DataFrame) -> DataFrame:
    """One row per cell: its vectors as they stand and its cover tree, built once, as bytes; a few cells a file."""

    def pack(rows: pa.Table) -> pa.Table:
        x = _given(rows["embedding"])
        tree = Tree(_unit(_scaled(x)))
        content = {"id": rows["rep"].to_numpy(), "h": rows["h"].to_numpy(), "w": rows["w"].to_numpy(), "x": x,
                   "order": tree.order, "levels": tree.levels}
        return pa.table({"cell": rows["cell"][:1], "content": pa.array([pickle.dumps(content)], pa.binary())})

    files = -(-placed.select("cell").distinct().count() // CELLS_A_FILE) or 1
    dealt = placed.repartition(files, "cell")
    return materialised(dealt.groupBy("cell").applyInArrow(pack, "cell string, content binary"), "blocks")


FOUND = "id bigint, h bigint, n bigint, other bigint"


def _found(rows: pa.Table, threshold: float) -> pa.Table:
    """Link counts of both blocks' vectors, and pairs that connect the linked ones."""
    out: list[list] = [[], [], [], []]
    for a_bytes, b_bytes, same in zip(*(rows[c].to_pylist() for c in ("ca", "cb", "same"))):
        sides = [pickle.loads(a_bytes)]
        if not same:
            sides.append(pickle.loads(b_bytes))
        for side in sides:
            side["x"] = _scaled(side["x"])
            side["tree"] = SimpleNamespace(order=side["order"], levels=side["levels"])
            side["unit"] = _unit(side["x"])
            side["norm"] = np.sqrt((side["x"] * side["x"]).sum(axis=1))
        links = linked(sides[0], sides[-1], threshold, same)
        counts = [links.count_a + links.count_b] if same else [links.count_a, links.count_b]
        for side, count in zip(sides, counts):
            some = np.flatnonzero(count)
            out[0] += side["id"][some].tolist()
            out[1] += side["h"][some].tolist()
            out[2] += count[some].tolist()
            out[3] += [None] * len(some)
        names = np.concatenate([side["id"] for side in sides])
        for node in links.up:
            top = links.top(node)
            if top != node:
                out[0].append(int(names[node]))
                out[1].append(None)
                out[2].append(None)
                out[3].append(int(names[top]))
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("id", "h", "n", "other"), out)})


def _all_found(blocks: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """What `_found` has of all open pairs of blocks, in rounds.

    In a round all executors hold some blocks, ROUND_BYTES of them, and the others are read
    from the shared folder past them. So no block is shuffled, however many pairs are open:
    disk holds each block once, and memory the blocks of a round.
    """
    spark = blocks.sparkSession
    bound_batches(spark)
    upto = F.sum(F.length("content").cast("bigint")).over(Window.orderBy("cell"))  # one row per cell, without its vectors
    dealt = materialised(blocks.select("cell", F.floor((upto - 1) / ROUND_BYTES).alias("round")), "rounds")
    folder, schema = new_folder(spark, "found"), FOUND

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _found(pa.Table.from_batches([batch.slice(k, 1)]), threshold).to_batches()

    rounds = [r["round"] for r in dealt.select("round").distinct().orderBy("round").collect()]
    for at in rounds:
        own = F.broadcast(dealt.where(F.col("round") == at).select(F.col("cell").alias("a")))
        held = blocks.select(F.col("cell").alias("a"), F.col("content").alias("ca")).join(own, "a")
        asked = pairs.join(own, "a")
        passing = blocks.select(F.col("cell").alias("b"), F.col("content").alias("cb"))
        work = passing.join(F.broadcast(asked), "b").join(F.broadcast(held), "a")
        same = F.col("a") == F.col("b")
        work.select("ca", F.when(~same, F.col("cb")).alias("cb"), same.alias("same")).mapInArrow(run, schema).write.parquet(f"{folder}/{at}")
    return spark.read.schema(schema).parquet(*[f"{folder}/{at}" for at in rounds]) if rounds else spark.createDataFrame([], schema)


def _usable(v: str) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(v).isNotNull() & F.coalesce(F.forall(v, number), F.lit(False)) & F.exists(v, lambda x: x != 0)


def cosine_links(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """id_col, n_links, component_id and kept of every vector: links are pairs with cosine >= threshold.

    n_links counts the other vectors linked directly; component_id is the smallest
    id reachable by links, itself included; kept where it is the vector's own. The
    result is that of comparing all pairs in double precision. Equal vectors are
    compared once. Null, empty and zero vectors and such with null or non-finite
    components link with nothing; vectors of different lengths never link. Rows that
    repeat an id are one vertex, each with its own row; rows without id count as
    vectors but have no component and are not kept. Other columns are not looked
    at; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("embedding"))
    usable = rows.where(_usable("embedding"))
    classes = materialised(
        usable.groupBy("embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w"))
        .withColumn("h", F.xxhash64("embedding")),
        "classes",
    )
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    placed, nodes = _placed(classes.select("rep", "h", "w", "embedding"), block)
    blocks = _packed_blocks(placed)
    pairs = materialised(_block_pairs(placed, nodes, limit), "pairs")
    found = _all_found(blocks, pairs, threshold)
    discarded(blocks)
    counts = found.where("other IS NULL").groupBy(F.col("id").alias("rep"), "h").agg(F.sum("n").alias("across"))
    edges = found.where("other IS NOT NULL AND id IS NOT NULL").select(F.col("id").alias("src"), F.col("other").alias("dst"))
    twins = usable.select("id", F.xxhash64("embedding").alias("h"), "embedding")
    described = classes.join(counts, ["rep", "h"], "left").select(
        F.col("h").alias("_h"), F.col("embedding").alias("_v"), "rep", "w", "across"
    )
    member = materialised(
        twins.join(described, (F.col("h") == F.col("_h")) & (F.col("embedding") == F.col("_v")))
        .select("id", "rep", (F.col("w") - 1 + F.coalesce("across", F.lit(0))).cast("bigint").alias("n_links")),
        "members",
    )
    repeated = member.where("id IS NOT NULL").groupBy("id").agg(
        F.count_distinct("rep").alias("k"), F.min("rep").alias("m")
    ).where("k > 1").select(F.col("id"))
    more = member.join(repeated, "id", "left_semi").where("id <> rep").select(
        F.col("rep").alias("src"), F.col("id").alias("dst")
    )
    parts = materialised(
        connected_components(edges.unionByName(more), "src", "dst").select(F.col("node").alias("rep"), "component"),
        "parts",
    )
    linked_rows = member.join(parts, "rep", "left").select(
        "id", "n_links", F.when(F.col("id").isNotNull(), F.coalesce("component", "rep")).alias("component_id")
    )
    alone = rows.where(~F.coalesce(_usable("embedding"), F.lit(False))).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked_rows.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
