"""Graphs over cells and junctions: components, communities, connectivity."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..shared import cut_lineage, discarded, materialised
from .joins import hot_keys, spread_join


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50) -> DataFrame:
    """Label every node of an undirected graph with its component's smallest node.

    Alternating star rounds: each node hands its larger neighbours (then its
    smaller ones) to its smallest neighbour, until the edges are stars. The
    number of rounds grows with the logarithm of the graph, not with its
    diameter, and edges never outgrow the input. Smallest neighbours are partial
    aggregates; the joins are plain equi joins, so adaptive execution splits a
    hub's rows. Each half round is one columnar write that also yields the
    count and checksum by which the end is seen.
    """
    current, before = _settled(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        larger = both.where(F.col("v") > F.col("u")).join(lowest, "u")
        stars, middle = _settled(larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = stars.groupBy("u").agg(F.min("v").alias("m"))
        handed = stars.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        discarded(current)
        current, after = _settled(handed.where(F.col("u") != F.col("v")).distinct())
        discarded(stars)
        if after == middle == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    loops = edges.where(F.col(src) == F.col(dst)).select(F.col(src).alias("node")).distinct()
    settled = leaves.unionByName(roots)
    rest = loops.join(settled, "node", "left_anti").select("node", F.col("node").alias("component"))
    return settled.unionByName(rest)


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their number and checksum from the same write."""
    seen = Observation()
    table = materialised(
        edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges"
    )
    return table, (seen.get["n"], seen.get["x"])


def undirected(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """Both directions of every edge, the weights of repeated edges added."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    one = edges.select("src", "dst", w.alias("w"))
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def modularity(graph: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Modularity of a partition; graph holds both directions of each edge."""
    between = _between_communities(graph, labels, hot_keys(graph, ["src"]))
    return _modularity(between, resolution)


def _between_communities(graph: DataFrame, labels: DataFrame, hot: list[int]) -> DataFrame:
    """Edge weight between communities, both directions. The graph is symmetric,
    so the hot nodes are the same for both ends."""
    first = spread_join(
        graph, labels.select(F.col("node").alias("src"), F.col("community").alias("c")), ["src"], ["dst"], hot=hot
    )
    both = spread_join(
        first, labels.select(F.col("node").alias("dst"), F.col("community").alias("d")), ["dst"], ["src"], hot=hot
    )
    return both.groupBy("c", "d").agg(F.sum("w").alias("w"))


def _modularity(between: DataFrame, resolution: float) -> float:
    rows = between.groupBy("c").agg(
        F.sum(F.when(F.col("c") == F.col("d"), F.col("w")).otherwise(0.0)).alias("i"), F.sum("w").alias("k")
    )
    total = rows.agg(F.sum("i").alias("i"), F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("k2")).first()
    return total["i"] / total["m"] - resolution * total["k2"] / total["m"] ** 2


def _local_moves(graph: DataFrame, resolution: float, rounds: int, hot: list[int]) -> DataFrame:
    """Nodes move to the neighbouring community with the largest gain.

    Half of the nodes (by a hash that changes every round) may move at a time,
    which keeps pairs from swapping for ever.
    """
    degree = cut_lineage(graph.groupBy("src").agg(F.sum("w").alias("k")).withColumnRenamed("src", "node"))
    total = degree.agg(F.sum("k")).first()[0]
    labels = degree.select("node", "k", F.col("node").alias("community"))
    loops = graph.where(F.col("src") != F.col("dst"))
    idle = 0
    for turn in range(rounds):
        links = spread_join(
            loops, labels.select(F.col("node").alias("dst"), F.col("community").alias("c")), ["dst"], ["src"], hot=hot
        ).groupBy(F.col("src").alias("node"), "c").agg(F.sum("w").alias("w_ic"))
        sizes = labels.groupBy(F.col("community").alias("c")).agg(F.sum("k").alias("k_c"))
        stays = labels.select("node", F.col("community").alias("c"), F.lit(0.0).alias("w_ic"))
        options = (
            links.unionByName(stays).groupBy("node", "c").agg(F.max("w_ic").alias("w_ic"))
            .join(labels, "node").join(sizes, "c")
        )
        home = F.col("c") == F.col("community")
        others = F.col("k_c") - F.when(home, F.col("k")).otherwise(0.0)
        gain = F.round(F.col("w_ic") - F.lit(resolution) * F.col("k") * others / F.lit(total), 9)
        best = options.groupBy("node", "k", "community").agg(
            F.max(F.struct(gain.alias("g"), home.cast("int").alias("s"), F.col("c").alias("c")))["c"].alias("_to")
        )
        awake = F.pmod(F.xxhash64(F.lit(turn), F.col("node")), F.lit(2)) == 0
        labels = cut_lineage(
            best.select(
                "node", "k", F.when(awake, F.col("_to")).otherwise(F.col("community")).alias("community"),
                (awake & (F.col("_to") != F.col("community"))).alias("_moved"),
            )
        )
        idle = 0 if labels.where("_moved").limit(1).count() else idle + 1
        if idle == 2:
            break
    return labels.select("node", "community")


def communities(edges: DataFrame, resolution: float = 1.0, levels: int = 2, rounds: int = 8, weight: str | None = None) -> DataFrame:
    """Communities by modularity: moves, then the same on the graph of communities.

    A level is kept only if modularity does not fall. Labels are community
    ids, not comparable with those of other programs.
    """
    graph = cut_lineage(undirected(edges, weight))
    labels = graph.select(F.col("src").alias("node"), F.col("src").alias("community")).distinct()
    best, level_graph = _modularity(graph.withColumnsRenamed({"src": "c", "dst": "d"}), resolution), graph
    for _ in range(levels):
        hot = hot_keys(level_graph, ["src"])
        step = _local_moves(level_graph, resolution, rounds, hot)
        between = cut_lineage(_between_communities(level_graph, step, hot))
        score = _modularity(between, resolution)
        if score <= best + 1e-12:
            break
        best = score
        labels = cut_lineage(
            labels.join(
                step.select(F.col("node").alias("community"), F.col("community").alias("_to")), "community"
            ).select("node", F.col("_to").alias("community"))
        )
        level_graph = between.withColumnsRenamed({"c": "src", "d": "dst"})
    return labels


def group_connectivity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between groups against the number expected by chance, at most 1.

    edges: src, dst (directed neighbour edges); labels: node, community.
    """
    named = labels.select("node", "community")
    first = spread_join(edges, named.select(F.col("node").alias("src"), F.col("community").alias("c1")), ["src"], ["dst"])
    placed = spread_join(first, named.select(F.col("node").alias("dst"), F.col("community").alias("c2")), ["dst"], ["src"])
    counted = materialised(placed.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("e")), "between")
    sizes = labels.groupBy("community").agg(F.count(F.lit(1)).alias("n"))
    out = counted.groupBy(F.col("c1").alias("community")).agg(F.sum("e").alias("es"))
    stats = sizes.join(out, "community", "left").fillna(0, ["es"])
    cross = counted.where(F.col("c1") != F.col("c2")).select(
        F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b"), "e"
    ).groupBy("a", "b").agg(F.sum("e").alias("inter"))
    total = labels.agg(F.count(F.lit(1)).alias("_n")).scalar()
    one = stats.select(F.col("community").alias("a"), F.col("n").alias("n1"), F.col("es").alias("e1"))
    two = stats.select(F.col("community").alias("b"), F.col("n").alias("n2"), F.col("es").alias("e2"))
    joined = cross.join(one, "a").join(two, "b").withColumn("_n", total)
    expected = (F.col("e1") * F.col("n2") + F.col("e2") * F.col("n1")) / (F.col("_n") - 1)
    return joined.select(
        "a", "b", "inter",
        F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("inter"), expected), F.lit(1.0))).alias("connectivity"),
    )
