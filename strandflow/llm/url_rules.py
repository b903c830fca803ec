"""URL filtering by association rules, in SQL functions and Spark's FP-growth.

A short list of site rules judges some urls. Their tokens and verdicts are the
transactions from which FP-growth mines token combinations; rules that point to a
verdict with enough support and confidence judge the urls that no site rule fits,
found through an inverted index from a rule's rarest token.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Site rules (fixed values): verdict, host and start of the path.
SITE_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    found = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def site_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest site rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    out = F.lit(None)
    for verdict, site, start in reversed(ordered):
        fits = ((host == site) | F.endswith(host, F.lit(f".{site}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: top domain, other labels, path parts (numbers as one), query keys, scheme."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    sites = F.transform(
        labels, lambda x, i: F.concat(F.when(i == F.size(labels) - 1, "top:").otherwise("site:"), x)
    )
    steps = F.transform(
        F.filter(F.split(path, "/"), lambda x: x != ""),
        lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, r"^[0-9]+", "#")),
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1))
    )
    scheme = F.concat(F.lit("scheme:"), F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z0-9+.\-]*)://", 1))
    return F.array_distinct(F.concat(sites, steps, keys, F.array(scheme)))


VERDICT = "verdict:"


def mined_index(labelled: DataFrame, min_support: float, min_rows: int, min_confidence: float) -> DataFrame:
    """One row `index`: rules with a verdict as consequent, by their rarest token.

    labelled: tokens, verdict. Support pruning bounds the rules: the tokens of a rule
    stand together in `min_support` of the urls and in `min_rows` of them. A rule is left out if one with fewer
    tokens among its own has the same verdict and no less confidence.
    """
    transactions = labelled.select(
        F.array_append("tokens", F.concat(F.lit(VERDICT), "verdict")).alias("items")
    )
    support = min(1.0, max(min_support, min_rows / max(1, transactions.count())))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(transactions)
    rules = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(VERDICT))).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring_index(F.col("consequent")[0], ":", -1).alias("verdict"), "confidence", "support",
    ).where(~F.exists("tokens", lambda t: F.startswith(t, F.lit(VERDICT))))
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    by_rule = rules.withColumn("token", F.explode("tokens")).join(single, "token")
    led = by_rule.groupBy("tokens", "verdict", "confidence", "support").agg(
        F.min(F.struct("freq", "token"))["token"].alias("lead")
    )
    shorter = led.select(
        F.col("tokens").alias("_t"), F.col("verdict").alias("_v"), F.col("confidence").alias("_c"), F.explode("tokens").alias("_on")
    )
    # A shorter rule stands in the longer one with every token, so with its own rarest.
    dominated = (
        led.withColumn("_on", F.explode("tokens"))
        .join(shorter.select("_t", "_v", "_c", "_on"), "_on")
        .where(
            (F.col("verdict") == F.col("_v")) & (F.size("_t") < F.size("tokens")) & (F.col("_c") >= F.col("confidence"))
            & (F.size(F.array_except("_t", "tokens")) == 0)
        )
        .select("tokens", "verdict").distinct()
    )
    kept = led.join(dominated, ["tokens", "verdict"], "left_anti")
    grouped = kept.groupBy("lead").agg(
        F.sort_array(F.collect_list(F.struct("tokens", "confidence", "support", "verdict"))).alias("rules")
    )
    return grouped.groupBy().agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("lead", "rules")))).alias("index")
    )


def judge_urls(
    pages: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] | None = None,
    min_support: float = 0.01, min_rows: int = 20, min_confidence: float = 0.8, default: str = "allow",
) -> DataFrame:
    """row (all columns of pages), host, path, rule and verdict of every url.

    Site rules come first: a rule fits its host and all subdomains if the path starts
    with the rule's; the longest wins. The urls they judge are the labels for the
    mining. Other urls get the verdict of the mined rule with the highest
    confidence, then support, among those whose tokens they all hold, else
    `default`. All labelled urls are mined. A null url, or one without `://`, has
    empty host and path. Repeated rows are judged alike, rows without id pass
    through `row`, as do other columns of any name; an empty table gives an empty
    result, and without labelled urls all others get the default.
    """
    rules = SITE_RULES if rules is None else rules
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    url = F.col(f"row.`{url_col}`")
    host, path = url_parts(url)
    parted = pages.select(row).select("row", host.alias("host"), path.alias("path"))
    judged = parted.withColumn("site", site_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "tokens", url_tokens(F.col("host"), F.col("path"), url)
    )
    labelled = judged.where("site IS NOT NULL").select("tokens", F.col("site.verdict").alias("verdict"))
    index = mined_index(labelled, min_support, min_rows, min_confidence).scalar()
    led = F.filter("tokens", lambda t: F.map_contains_key(F.col("index"), t))
    near = F.flatten(F.transform(led, lambda t: F.element_at(F.col("index"), t)))
    fitting = F.filter(near, lambda r: F.size(F.array_except(r["tokens"], F.col("tokens"))) == 0)
    best = F.array_max(
        F.transform(
            fitting,
            lambda r: F.struct(r["confidence"], r["support"], F.size(r["tokens"]), r["verdict"].alias("verdict")),
        )
    )
    return judged.withColumn("index", index).select(
        "row", "host", "path", F.col("site.rule").alias("rule"),
        F.coalesce(F.col("site.verdict"), best["verdict"], F.lit(default)).alias("verdict"),
    )
