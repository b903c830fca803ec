"""Personal data: base spans against plain patterns, proposals, thresholds, redaction."""

import hashlib
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strandflow.llm import pii
from strandflow.llm.queries import QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PLAIN)


def checksum(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        total += int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10))
    return total % 10 == 0


def fits(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {
        "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
        "card": 14 <= len(digits) <= 19 and checksum(digits), "phone": 10 <= len(digits) <= 15,
    }[kind]


def base_of(text):
    spans = [
        (m.start(), KINDS.index(kind), m.end(), kind) for kind, p in PLAIN.items() for m in re.finditer(p, text or "")
        if fits(kind, m[0])
    ]
    return sorted(spans)


def listing(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


ODD = [
    None, "", " ", "a@b.c-_x@d.e", "a@b@c.d.e f@g", "x@y.z..w@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 010.000.0255.1 0.0.0.0",
    "4111 1111 1111 1111 12", "4111111111111111", "4111-1111-1111-1111 4012 8888 8888 1881", "+1 (017) 555-7713-", "+1((((( +49.30.1234567 +1",
    "🎉 ä@b.de mail é+x@y.org 🎉 1.1.1.1", "call +44 20 7946 0958 or x%y@a-b.co.uk", "12 " * 30, "+" * 50 + "1 2 3 4 5 6 7 8 9 0",
]


def test_base_spans_against_patterns(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab1234567890 ..--@@++()é🎉_%") for _ in range(rng.randrange(120))) for _ in range(400)]
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)] + [(None, texts[12], 1, "x"), (4, texts[4], 1, "x"), (4, texts[4], 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int, base string")
    got = pii.pii_spans(docs, pii.Judge()).select("row.doc_id", "row.text", "row.base", "spans").collect()
    assert len(got) == len(rows) and all(r.base == "x" for r in got)
    for r in got:
        assert [tuple(s) for s in r.spans] == base_of(r.text), r.text
    empty = docs.limit(0)
    assert pii.pii_spans(empty, pii.fit(empty)).count() == 0


def test_query_on_its_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op11_pii_spans"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = base_of(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listing(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in want) for k in KINDS]
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert [s for s in spans if s[0] in KINDS] == [[k, str(a), str(b)] for a, _, b, k in want]


@pytest.fixture(scope="module")
def corpus(spark):
    """Every family with context, and decoys that look alike."""
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(good):
        while True:
            s = rng.choice("3456") + digits(15)
            if checksum(s) == good:
                return s

    def one(kind):
        return {
            "mail": f"write to {rng.choice('abc')}{digits(2)}@mail{digits(1)}.example.com today",
            "net": f"host {rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(255)} up",
            "pay": f"card {card(True)} paid", "call": f"phone +1 ({digits(3)}) 555-{digits(4)} now",
            "d1": f"order {card(False)} sent", "d2": f"sat at home.then {digits(2)} left",
            "d3": f"size {digits(2)} {digits(3)} {digits(2)} cm", "d4": f"version {rng.randrange(300, 999)}.1.{rng.randrange(300, 999)}.2",
        }[kind]

    kinds = ["mail", "net", "pay", "call", "d1", "d2", "d3", "d4"]
    texts = [f"Some text with {one(kinds[k % 8])} and more." for k in range(1600)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_disguised_forms_are_added_and_decoys_left(spark, corpus):
    judge = pii.fit(corpus)
    assert {"mail", "net", "pay", "call"} <= set(judge.thresholds)
    hidden = [
        ("mail", "write to b17 (at) mail3 (dot) example (dot) com today"), ("mail", "write to c40(at)mail5.example.com today"),
        ("pay", "card 4111.1111.1111.1111 paid"), ("net", "host 10[.]24[.]3[.]9 up"), ("call", "phone 001 (415) 555-2671 now"),
    ]
    decoys = ["order 4111111111111112 sent", "sat at home.then 12 left", "size 10 200 30 cm", "version 700.1.800.2"]
    rows = [(k, f"Some text with {t} and more.") for k, t in enumerate([t for _, t in hidden] + decoys)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.pii_spans(docs, judge).select("row.doc_id", "spans").collect()}
    for k, (kind, text) in enumerate(hidden):
        assert kind in got[k], text
    assert all(got[k] == [] for k in range(len(hidden), len(rows)))
    left = {
        r.doc_id: [s.kind for s in r.spans] for r in pii.pii_spans(corpus, judge).select("row.doc_id", "spans").collect()
    }
    wrong = sum(bool(v) for k, v in left.items() if k % 8 >= 4)
    assert wrong <= 0.02 * len(left) / 2 and all(left[k] for k in left if k % 8 < 4)


def test_all_proposals_are_learnt_from(spark, monkeypatch):
    """12,000 decoys and 400 addresses: none is left out for being many."""
    rows = [(f"size {i % 90 + 10} {i} {i % 83 + 10} cm",) for i in range(100_000, 112_000)] + [(f"write to m{i}@example.com now",) for i in range(400)]
    docs = spark.createDataFrame(rows, "text string")
    seen = []

    class Trees(pii.GBTClassifier):
        def fit(self, learnt):
            seen.extend(r["count"] for r in learnt.groupBy("label").count().orderBy("label").collect())
            return super().fit(learnt)

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    judge = pii.fit(docs)
    slim = F.struct("c.family", "c.s", "c.before", "c.after")
    found = pii.proposed(docs).select(F.explode("proposals").alias("c")).select(pii.confirmed(F.col("c")).alias("right"), F.xxhash64(slim).alias("h"))
    learnt = found.where(F.pmod("h", F.lit(4)) != 0)
    assert seen == [learnt.where("NOT right").count(), 2 * learnt.where("right").count()] and learnt.where("NOT right").count() > 8_000
    assert found.where("NOT right").count() > 10_000 and "mail" in judge.thresholds


def test_long_texts_take_linear_time(spark):
    big = 1 << 20
    texts = ["a" * big, "1" * big, "1." * (big // 2), "a@" * (big // 2), "x@" + "a." * (big // 2), "+1" + "(" * big, "1 " * (big // 2),
             "0" * big, "AB12 " + "A1B2 " * (big // 5), "a.b@c.de " * (big // 64)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    start = time.time()
    got = {r.doc_id: r.n for r in pii.pii_spans(docs, pii.Judge()).select("row.doc_id", F.size("spans").alias("n")).collect()}
    assert time.time() - start < 120
    assert got[9] == big // 64 and got[0] == 0


def test_redaction(spark):
    text = "🎉 a@b.cd and +1 (017) 555-7713 x"
    docs = spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "doc_id bigint, text string")
    out = pii.pii_spans(docs, pii.Judge()).select("row.doc_id", pii.redacted(F.col("row.text"), F.col("spans"), "#").alias("t"))
    assert {r.doc_id: r.t for r in out.collect()} == {1: "🎉 # and # x", 2: "clean", 3: None}
