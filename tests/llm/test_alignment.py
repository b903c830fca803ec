"""Cross-tokenizer alignment against plain loops."""

import hashlib
import os
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandflow.llm import alignment
from strandflow.llm import texts as texts_of
from strandflow.llm.queries import QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in _plain}
BYTE |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_plain))}


def bytes_a(i):
    return bytes(BYTE[c] for c in A.id_to_token(i))


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
        return []
    ends = lambda ids, f: np.cumsum([len(f(i)) for i in ids]).tolist()
    ends_a, ends_b = ends(a, bytes_a), ends(b, bytes_b)
    out, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def brute(rows):
    """Sorted rows of the query for (id, text)."""
    groups = [(i, groups_of(t)) for i, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for _, g in groups]
    count = Counter(pair for one in links for pair in one)
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, g), one in zip(groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(one.values()),
            sum(n for (a, b), n in one.items() if count[a, b] == most[a]), sum(n * count[p] for p, n in one.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def results(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


ODD = [
    None, "", " ", "\n\n \t x", "a", "▁ hidden", "é ß 日本語 한국어 🎉 ½ ﬁ", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 nul",
    "a" * 3000, "ab" * 700 + " " * 900 + "end", "0123456789" * 200, "naïve café — “quotes” … ", "🎉" * 300,
]


def test_query_against_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert results(QUERIES["op13_token_alignment"](spark, FOLDER)) == brute(rows)


@pytest.mark.parametrize("lane,wide", [(256, 4096), (3, 1)])
def test_odd_texts(spark, monkeypatch, lane, wide):
    """Odd and random texts, repeated rows and ids, rows without id, clashing extra columns."""
    rng = random.Random(lane)
    texts = ODD + ["".join(rng.choice("ab é日🎉\n 01<|") for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, texts[20]), (5, texts[20]), (None, texts[21]), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, block int, a string")
    if lane != 256:  # lanes as short as they can be; every group by its distinct ids
        monkeypatch.setattr(alignment, "WIDE", wide)
        cut = alignment.lanes_of
        monkeypatch.setattr(alignment, "lanes_of", lambda *args: cut(*args, lane=lane))
        got = alignment.aligned([t for _, t in rows], *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
        want = [groups_of(t) for _, t in rows]
        assert got["n_groups"].tolist() == [len(g) for g in want]
        assert got["n_links"].tolist() == [sum(len(x) * len(y) for x, y in g) for g in want]
        return
    assert results(alignment.align(docs)[0]) == brute(rows)


def test_empty_table_and_counts(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, "one")], "doc_id bigint, text string")
    done, counts = alignment.align(docs.limit(0))
    assert done.count() == 0 and counts.count() == 0
    done, counts = alignment.align(docs)
    got = {(r.a, r.b): (r.n, r.best) for r in counts.collect()}
    want = Counter(p for t in ("one two two", "one") for p in {(a, b) for x, y in groups_of(t) for a in x for b in y})
    assert {p: n for p, (n, _) in got.items()} == dict(want) and all(best for _, best in got.values())


def test_lanes_end_where_both_sides_end():
    ends_a, ends_b = np.array([2, 4, 6, 8, 9]), np.array([1, 4, 5, 8, 9])
    lanes = alignment.lanes_of(ends_a, ends_b, np.array([5]), np.array([5]), lane=2)
    assert lanes.T.tolist() == [[0, 2, 0], [2, 4, 2], [4, 5, 4]]


def test_a_block_needs_little_more_than_its_tokens():
    """Temporary tables of a block are small numbers and go as soon as they are read."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(400)]
    paths = [*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))]
    alignment.aligned(texts[:1], *paths)
    tracemalloc.start()
    got = alignment.aligned(texts, *paths)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * int(got["n_a"].sum() + got["n_b"].sum())


def test_texts_come_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(alignment, "aligned", lambda texts, a, b, real=alignment.aligned: real([None] * len(texts), a, b))
    docs = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    kept = spark.conf.get(texts_of.BATCH_CONF)
    spark.conf.set(texts_of.BATCH_CONF, "64m")

    def bounded(batch, limit):
        assert batch.get_total_buffer_size() < 4 * texts_of.BATCH_BYTES
        return texts_of.byte_slices(batch, limit)

    monkeypatch.setattr(alignment, "byte_slices", bounded)
    try:
        blocks = alignment.blocks_of(docs, "doc_id", "text", *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
        assert blocks.agg(F.sum(F.size("docs"))).first()[0] == 40
    finally:
        spark.conf.set(texts_of.BATCH_CONF, kept)
