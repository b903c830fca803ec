"""Manifest trees and proofs against plain loops."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strandflow.llm import merkle_manifest as mm


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fan):
    """(root, siblings of every node as lists of (before, behind))."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place // fan * fan
            proofs[k].append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + fan])))
        nodes = [h("".join(nodes[k : k + fan])) for k in range(0, len(nodes), fan)]
        at = [p // fan for p in at]
    return nodes[0], proofs


def brute(rows, fan=3):
    """Sorted (id, leaf, subroot, root, proof digest) of rows (id, source, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for name in names:
        ordered = sorted((r[0] is not None, r[0] or 0, leaf_of(r)) for r in groups[name])
        below[name] = [(i if there else None, d) for there, i, d in ordered], *climb([d for _, _, d in ordered], fan)
    root, above = climb([below[n][1] for n in names], fan)
    out = []
    for name, upper in zip(names, above):
        leaves, subroot, proofs = below[name]
        for (i, d), proof in zip(leaves, proofs):
            out.append((i, d, subroot, root, h("".join(a + b for a, b in proof + upper))))
    return sorted(out, key=str)


def tables():
    rng = random.Random(1)
    many = [(k, rng.choice(["hot"] * 4 + ["", None, "é", "z", "Z", "日本", "one"]), rng.choice(["a", "", None, "é\n🎉"])) for k in range(900)]
    odd = [(5, "hot", "x"), (5, "hot", "x"), (5, "hot", "y"), (None, "hot", "x"), (None, None, None), (-3, "lone", "t" * 100_000)]
    return {
        "many": many + odd, "one": [(1, "s", "t")], "two groups": [(1, "s", "t"), (2, "r", None)],
        "single source": [(k, None, "t") for k in range(28)], "each its own source": [(k, f"s{k}", "t") for k in range(40)],
    }


@pytest.mark.parametrize("name", list(tables()))
@pytest.mark.parametrize("fan", [3, 2])
def test_against_loops(spark, monkeypatch, name, fan):
    rows = tables()[name]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, source string, text string, tree int, i string")
    monkeypatch.setattr(mm, "GROUP_BLOCK", 50)
    out = mm.manifest(docs, ["doc_id", "source", "text"], fan=fan) if fan == 3 else None
    if fan == 2:  # trees of another width, and blocks of few rows, so that ancestors are copied
        numbered = [(f"{s}!", k) for s in {r[1] for r in rows} for k in range(sum(r[1] == s for r in rows))]
        digests = [hashlib.sha256(f"{s}{k}".encode()).digest() for s, k in numbered]
        size = {s: sum(t == s for t, _ in numbered) for s, _ in numbered}
        leaves = spark.createDataFrame(
            [(s, k, size[s], bytearray(d)) for (s, k), d in zip(numbered, digests)], "tree string, i bigint, n bigint, digest binary"
        )
        proven, roots = mm.forest_proofs(leaves, fan=2, block=4)
        want = {s: climb([d.hex() for (t, _), d in zip(numbered, digests) if t == s], 2) for s in size}
        assert {r.tree: r.root.hex() for r in roots.collect()} == {s: w[0] for s, w in want.items()}
        for r in proven.collect():
            assert [(x.left.hex(), x.right.hex()) for x in r.proof] == want[r.tree][1][r.i]
        return
    got = out.select("doc_id", "leaf", "subroot", "root", mm.proof_digest(F.col("proof")), mm.folded(F.col("leaf"), F.col("proof")))
    found = [tuple(r) for r in got.collect()]
    assert all(r[5] == r[3] for r in found)
    assert sorted((r[:5] for r in found), key=str) == brute(rows)


def test_tampering_shows_and_empty_table(spark):
    docs = spark.createDataFrame([(k, f"s{k % 3}", "a\nb" if k % 2 else "ab") for k in range(60)], "doc_id bigint, source string, text string")
    values = ["doc_id", "source", "text"]
    now = mm.row_digest([F.col("doc_id"), F.col("source"), F.replace("text", F.lit("\n"), F.lit(""))])
    out = mm.manifest(docs, values, carried=[now.alias("now")])
    rows = out.select("doc_id", (mm.folded(F.col("carried.now"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert all(r.ok == (r.doc_id % 2 == 0) for r in rows) and len(rows) == 60
    assert mm.manifest(docs.limit(0), values).count() == 0
