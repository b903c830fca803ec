"""Personal data in texts: pattern spans, and candidates judged by boosted trees; SQL functions only.

Base patterns report what they find. Besides them, generators with high recall
propose overlapping spans: disguised addresses, grouped and national numbers,
accounts, network addresses. Boosted trees judge every proposal by its format
and the characters around it. They are trained on the corpus itself: proposals
whose content passes its family's rule (an address, Luhn digits, an account's
remainder) against those that do not, and disguised copies of the former, so
that forms which the patterns miss are known too. Each family's threshold comes
from proposals held out of the fit: the lowest score from which on nine
proposals of ten and more are right. The trees are turned into one SQL
expression, so that texts are judged in place, in one pass, without a shuffle.
"""

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ranged, scan
from ..shared import discarded, materialised

# The base patterns. Possessive runs and the check of what stands before
# keep the first match at every place and make long runs linear; `\G` is the end of the match before.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BASE = ["email", "ip", "card", "phone"]

# Generators, (family, pattern). They propose spans, also overlapping ones.
_AT = r"(?:@| ?[\[({] ?at ?[\])}] ?| at )"
_DOT = r"(?:\.| ?[\[({] ?dot ?[\])}] ?| dot )"
GENERATORS = [
    ("mail", rf"(?i)(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++{_AT}[\p{{L}}\p{{N}}-]++(?:{_DOT}[\p{{L}}\p{{N}}-]++)++"),
    ("net", r"(?<![0-9.])[0-9]{1,3}(?:(?:\.| ?[\[(]\.[\])] ?)[0-9]{1,3}){3}(?![0-9.])"),
    ("net", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:[:-][0-9A-Fa-f]{0,4}){5,7}(?![0-9A-Za-z:])"),
    ("pay", r"(?<![\p{L}\p{N}])[0-9]{4}(?:[ ./-][0-9]{4}){3}(?:[ ./-]?[0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("pay", r"(?<![\p{L}\p{N}])[0-9]{13,19}(?![\p{L}\p{N}])"),
    ("call", r"(?<![\p{L}\p{N}])(?:\+|00|\()?[0-9]{1,4}(?:[ ()./-]{1,2}[0-9]{2,7}){2,5}(?![\p{L}\p{N}])"),
    ("bank", r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
]
FAMILIES = ["mail", "net", "pay", "call", "bank"]

# Words that stand before personal data, by family.
HINTS = {
    "mail": "mail|write to|contact", "net": "ip|host|server|address|mac", "pay": "card|visa|credit|pay",
    "call": "tel|phone|call|fax|mobile|cell", "bank": "iban|account|bank",
}
BEFORE, AFTER, CHUNK = 24, 8, 512


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check digit of a short string of digits is right."""
    value = lambda k: F.substr(digits, -k, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda s, k: s + F.when(k % 2 == 1, value(k)).otherwise(value(k) * 2 - F.when(value(k) > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def account_fits(s: Column) -> Column:
    """Remainder 1 by 97 of an account number whose first four characters are put last, A = 10 to Z = 35."""
    bare = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))
    place = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda r, c: F.when(c == "", r).otherwise((r * F.when(place(c) > 9, 100).otherwise(10) + place(c)) % 97),
    )
    return rest == 1


def _chosen(family: Column, by: dict[str, Column]) -> Column:
    """The value of a family, by a chain of conditions."""
    out = F.lit(None)
    for name in reversed(FAMILIES):
        out = F.when(family == name, by[name]).otherwise(out)
    return out


def confirmed(c: Column) -> Column:
    """The content of a proposal passes its family's own rule."""
    s, digits = c["s"], digits_of(c["s"])
    card = F.length(digits).between(14, 19)
    return _chosen(c["family"], {
        "mail": s.rlike(f"^{EMAIL}$"),
        "net": s.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "pay": F.when(card & s.rlike("^[0-9 -]*$"), luhn(digits)).otherwise(False),
        "call": s.startswith("+") & F.length(digits).between(10, 15) & s.rlike(f"^{PHONE}$"),
        "bank": F.when(F.length(s) <= 42, account_fits(s)).otherwise(False),
    })


def disguised(c: Column) -> Column:
    """A confirmed proposal's text in a form that the base patterns do not know."""
    s = c["s"]
    return _chosen(c["family"], {
        "mail": F.replace(F.replace(s, F.lit("@"), F.lit(" (at) ")), F.lit("."), F.lit(" (dot) ")),
        "net": F.replace(s, F.lit("."), F.lit("[.]")),
        "pay": F.regexp_replace(digits_of(s), "([0-9]{4})(?=[0-9])", "$1."),
        "call": F.regexp_replace(s, r"^\+", "00"),
        "bank": F.replace(s, F.lit(" "), F.lit("")),
    })


def features(c: Column) -> Column:
    """Format and context of a proposal (family, s, before, after) as an array of numbers."""
    s, before, after = c["s"], c["before"], c["after"]
    digits = digits_of(s)
    count = lambda pattern: F.regexp_count(s, F.lit(pattern))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    kind = lambda ch: (
        F.when(ch == "", 0).when(ch.rlike(r"\s"), 1).when(ch.rlike("[0-9]"), 2).when(ch.rlike(r"\p{L}"), 3).otherwise(4)
    )
    n = F.length(digits)
    values = [
        F.length(s), n, count(r"\p{L}"), count(r"[^\p{L}\p{N}]"), count("[0-9]++"), F.array_max(
            F.transform(F.split(s, "[^0-9]++"), lambda x: F.length(x))
        ),
        flag(s.startswith("+")), flag(s.startswith("00")), count("[()]"), count(r"\."), count("[ -]"),
        flag(s.rlike("(?i)@|[^a-z]at[^a-z]")), flag(s.rlike(r"(?i)[a-z]{2,6}$")), flag(s.rlike("(?i)dot")),
        flag(F.when(n.between(13, 19), luhn(digits)).otherwise(False)),
        flag(s.rlike(rf"^{PART}(?:[^0-9]++{PART}){{3}}$")),
        flag(F.when((c["family"] == "bank") & (F.length(s) <= 42), account_fits(s)).otherwise(False)),
        kind(F.right(before, F.lit(1))), kind(F.left(after, F.lit(1))),
        *[flag(F.lower(before).rlike(rf"(?:{HINTS[f]})[^a-z]{{0,6}}$")) for f in FAMILIES],
        *[flag(c["family"] == f) for f in FAMILIES],
    ]
    return F.array(*[v.cast("double") for v in values])


def _running(values: Column) -> Column:
    """Sums of all values before each one. Chunks are summed first, so that long lists cost little more."""
    sums = lambda a: F.aggregate(
        a, F.array(F.lit(0).cast("bigint")), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x))
    )
    last = F.ceil(F.size(values) / CHUNK).cast("int") - 1
    inner = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: sums(F.slice(values, k * CHUNK + 1, CHUNK)))
    totals = F.slice(F.transform(inner, lambda a: F.element_at(a, -1)), F.lit(1), F.greatest(last, F.lit(0)))
    moved = F.zip_with(
        inner, sums(totals), lambda a, o: F.transform(F.slice(a, F.lit(1), F.size(a) - 1), lambda x: x + o)
    )
    return F.flatten(moved)


def located(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]], keep: list[str]) -> DataFrame:
    """df's `keep` columns and per pattern its matches: array of start, end, s, before, after.

    patterns: name to (pattern, condition without which it has no match). Places count code
    points. Matches and what stands between them are taken from the text; their lengths
    give the places. Each step is a projection of its own, so nothing is computed twice.
    """
    none = F.array().cast("array<string>")
    hits = df.select(*keep, text, *[
        F.when(may, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f"h_{n}")
        for n, (p, may) in patterns.items()
    ])
    parts = hits.select(*keep, *[f"h_{n}" for n in patterns], *[
        F.when(F.size(f"h_{n}") > 0, F.split(text, p, -1)).otherwise(none).alias(f"p_{n}") for n, (p, _) in patterns.items()
    ])

    def lengths(n: str) -> Column:
        return F.transform(f"h_{n}", lambda h, i: (F.length(h) + F.length(F.get(f"p_{n}", i))).cast("bigint"))

    sums = parts.select("*", *[_running(lengths(n)).alias(f"r_{n}") for n in patterns])

    def spans(n: str) -> Column:
        def one(h: Column, i: Column) -> Column:
            part = F.get(f"p_{n}", i)
            start = F.get(f"r_{n}", i) + F.length(part)
            return F.struct(
                start.alias("start"), (start + F.length(h)).alias("end"), h.alias("s"),
                F.right(part, F.lit(BEFORE)).alias("before"), F.left(F.get(f"p_{n}", i + 1), F.lit(AFTER)).alias("after"),
            )

        return F.transform(f"h_{n}", one).alias(n)

    return sums.select(*keep, *[spans(n) for n in patterns])


def proposed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row (all columns of docs), base (array of start, rank, end, kind) and proposals of every document.

    proposals: array of start, end, s, before, after, family.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    one = one.withColumn("digit", F.col("text").rlike("[0-9]"))
    at, digit = F.contains("text", F.lit("@")), F.col("digit")
    may = {"mail": at | F.col("text").rlike(r"(?i)[\[({ ]at[\])} ]"), "net": digit & F.col("text").rlike("[:.-]")}
    patterns = {
        "email": (EMAIL, at), "ip": (IP, digit & F.contains("text", F.lit("."))), "card": (CARD, digit),
        "phone": (PHONE, digit & F.contains("text", F.lit("+"))),
    } | {f"g{k}": (p, may.get(f, digit)) for k, (f, p) in enumerate(GENERATORS)}
    found = located(one, "text", patterns, ["row"])
    n = lambda x: F.length(digits_of(x["s"]))
    right: dict[str, Callable[[Column], Column]] = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: x["s"].rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": lambda x: F.when(n(x).between(14, 19), luhn(digits_of(x["s"]))).otherwise(False),
        "phone": lambda x: n(x).between(10, 15),
    }

    def span(kind: str) -> Callable[[Column], Column]:
        rank = F.lit(BASE.index(kind)).alias("rank")
        return lambda x: F.struct(x["start"].alias("start"), rank, x["end"].alias("end"), F.lit(kind).alias("kind"))

    def proposal(family: str) -> Callable[[Column], Column]:
        return lambda x: F.struct(*[x[c].alias(c) for c in ("start", "end", "s", "before", "after")], F.lit(family).alias("family"))

    base = F.concat(*[F.transform(F.filter(k, right[k]), span(k)) for k in BASE])
    proposals = F.concat(*[F.transform(f"g{k}", proposal(f)) for k, (f, _) in enumerate(GENERATORS)])
    return found.select("row", F.array_sort(base).alias("base"), proposals.alias("proposals"))


def _score(model, x: Column) -> Column:
    """The sum of a boosted model's trees over an array of features, as one expression."""

    def walk(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.get(x, F.lit(split.featureIndex())) <= float(split.threshold()), walk(node.leftChild())).otherwise(
            walk(node.rightChild())
        )

    return sum(
        (walk(tree._java_obj.rootNode()) * float(w) for tree, w in zip(model.trees, model.treeWeights)), F.lit(0.0)
    )


class Judge:
    """A fitted model with one threshold per family; without a model nothing is added."""

    def __init__(self, model=None, thresholds: dict[str, float] | None = None):
        self.model, self.thresholds = model, thresholds or {}

    def accepted(self, proposals: Column) -> Column:
        """The proposals whose score reaches their family's threshold."""
        if not self.thresholds:
            return F.filter(proposals, lambda c: F.lit(False))
        scored = F.transform(proposals, lambda c: F.struct(c.alias("c"), features(c).alias("x")))
        family = lambda c: F.coalesce(*[
            F.when(c["family"] == f, F.lit(t)) for f, t in self.thresholds.items()
        ], F.lit(float("inf")))
        kept = F.filter(scored, lambda p: _score(self.model, p["x"]) >= family(p["c"]))
        return F.transform(kept, lambda p: p["c"])


def fit(docs: DataFrame, text_col: str = "text", precision: float = 0.9, trees: int = 12, depth: int = 4) -> Judge:
    """Boosted trees and thresholds from all proposals of the corpus.

    A quarter of them, by hash, is held out of the fit and gives the thresholds. A family
    that never reaches `precision` on them has no threshold and adds nothing, and so does a
    corpus without confirmed or without other proposals.
    """
    all_rows = proposed(docs.select(F.col(text_col).alias("text"))).select(F.explode("proposals").alias("c"))
    slim = F.struct("c.family", "c.s", "c.before", "c.after")
    labelled = materialised(
        all_rows.select(slim.alias("c"), confirmed(F.col("c")).alias("right"), F.xxhash64(slim).alias("h")), "proposals"
    )
    sides = {r["right"] for r in labelled.select("right").distinct().collect()}
    if not {True, False} <= sides:
        discarded(labelled)
        return Judge()
    mask = F.struct(F.col("c.family").alias("family"), disguised(F.col("c")).alias("s"), "c.before", "c.after")
    real = labelled.where(F.col("right").isNotNull()).withColumn("real", F.lit(True))
    masked = labelled.where("right").withColumn("c", mask).withColumn("real", F.lit(False))
    sample = materialised(
        real.unionByName(masked).select(
            "c.family", features(F.col("c")).alias("x"), F.col("right").cast("double").alias("label"), "real",
            (F.pmod("h", F.lit(4)) == 0).alias("held"),
        ),
        "sample",
    )
    vectors = sample.withColumn("features", array_to_vector("x"))
    learnt = vectors.where("NOT held")
    if learnt.select("label").distinct().count() < 2:
        return Judge()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, minInstancesPerNode=2).fit(learnt)
    scored = sample.where("held AND real").select("family", "label", _score(model, F.col("x")).alias("score"))
    counted = scored.groupBy("family", "score").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n"))
    above = scan(ranged(counted, ["family"], ["score"]), ["family"], ["score"], {"rights": ("sum", "right"), "all": ("sum", "n")}, descending=True)
    reached = above.where(F.col("rights") / F.col("all") >= precision).groupBy("family").agg(F.min("score").alias("t"))
    thresholds = {r["family"]: max(r["t"], 0.0) for r in reached.collect()}
    discarded(labelled, sample)
    return Judge(model, thresholds)


def pii_spans(docs: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """row (all columns of docs) and spans (array of start, rank, end, kind) of every document.

    Base spans all stay; to them come accepted proposals that begin and end where no base
    span does, with their family as kind (rank after the base kinds). Places count code
    points of the whole text, end exclusive. A null text is empty; other columns, whatever
    their names, pass through `row`; repeated rows and rows without id each give a
    row; an empty table gives an empty result.
    """
    found = proposed(docs, text_col).withColumn("accepted", judge.accepted(F.col("proposals")))
    ends = lambda name: F.transform("base", lambda b: b[name])
    placed = found.select("row", "base", "accepted", ends("start").alias("starts"), ends("end").alias("ends"))
    new = F.filter("accepted", lambda c: ~F.array_contains("starts", c["start"]) & ~F.array_contains("ends", c["end"]))
    rank = lambda c: F.array_position(F.array(*map(F.lit, FAMILIES)), c["family"]).cast("int") + len(BASE) - 1
    added = F.transform(new, lambda c: F.struct(
        c["start"].alias("start"), rank(c).alias("rank"), c["end"].alias("end"), c["family"].alias("kind")
    ))
    return placed.select("row", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mask: str = "[PRIVATE]") -> Column:
    """The text with every stretch that spans cover replaced by one mask."""
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] > s["start"]),
            F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(
                F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end")
            ))),
        ).otherwise(F.concat(out, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text).cast("bigint")))
    kept = F.zip_with(begins, ends, lambda a, b: F.substr(text, a.cast("int") + 1, (b - a).cast("int")))
    return F.when(text.isNotNull(), F.array_join(kept, mask))
