import random

import brute
import pytest

from strandflow.llm import set_join
from strandflow.llm.queries import QUERIES


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.jaccard_classes(df, **kw).collect()}


def made(seed, groups, copies, words=60):
    """Groups of near copies that all hold one common passage."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows, at = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)] + passage
        for _ in range(copies if g else 3 * copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((at, " ".join(text)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent", [3, 64])
def test_near_copies_and_a_common_passage(spark, frequent):
    rows = made(1, 12, 5)
    assert run(spark, rows, frequent=frequent) == brute.jaccard_classes(rows)


def test_tokens_frequent_in_sets_read_again_stand_behind_all_others(spark):
    rng = random.Random(5)
    base, rows = [f"w{k}" for k in range(200)], []
    for i in range(20):
        text = list(base)
        for k in range(3 + i % 2, 190, 16):
            text[k + rng.randrange(6)] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = set_join._set_rows(docs, "doc_id", "text", 4, 85)
    lists = set_join._prefixes(sets, docs, "doc_id", "text", 4, 85, 4)
    longest = lists.groupBy("tok").count().agg({"count": "max"}).first()[0] or 0
    assert longest < 4  # each set has more tokens of its own than its prefix holds
    rows += [(100 + i, t + " end") for i, t in rows[:3]]
    assert run(spark, rows, frequent=4) == brute.jaccard_classes(rows)


def test_only_common_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"a{rng.randrange(6)}" for _ in range(rng.randrange(1, 40)))) for i in range(120)]
    assert run(spark, rows, frequent=4, n=2) == brute.jaccard_classes(rows, n=2)


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two\n"), (6, "one"), (7, "a b c d e"),
        (8, "a b c d e"), (9, "É é x y"), (10, "é é x y"), (11, "long " * 30000), (12, "long " * 9),
    ]
    got = run(spark, rows)
    assert got == brute.jaccard_classes(rows)
    assert got[1] == (0, 1) and got[5] == (1, 4) and got[8] == (2, 7) and got[12] == (1, 11)


def test_repeated_ids_null_ids_extra_columns_empty_table(spark):
    text = "a b c d e f g"
    rows = [(5, text, 1), (5, "q r s t u", 2), (2, text, 3), (7, "q r s t u", 4), (None, text, 5), (2, text, 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in set_join.jaccard_classes(df).collect())
    assert got == [(0, 0), (2, 2), (2, 2), (5, 2), (5, 2), (7, 2)]
    assert set_join.jaccard_classes(df.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_jaccard_classes"](spark, folder).collect()}
    assert got == brute.jaccard_classes(rows)
