"""Document quality: plain counts and a hashed n-gram likelihood ratio, in SQL functions only.

The verdict compares two multinomials over hashed word n-grams (one and two
words, `buckets` cells): one of trusted documents, one of the whole corpus. A
document's score is the mean log ratio of its n-grams, so length does not
matter. The cut is a low quantile of the scores that trusted documents have when
each is left out of the trusted counts, so it follows the size of the tables.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import exact_quantiles
from ..shared import materialised
from .texts import picked

BLANK = r"[ \t\n\x0B\f\r]"
SYMBOL = r"[#*$%&|<>]"
MILLION = 1_000_000


def _all_but_last(a: Column, k: int) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - k, F.lit(0)))


def _all_but_first(a: Column, k: int) -> Column:
    return F.slice(a, F.lit(k + 1), F.greatest(F.size(a) - k, F.lit(0)))


def _joined(a: Column, k: int) -> Column:
    """Hashes of neighbours k apart: twice as many words in each."""
    return F.zip_with(_all_but_last(a, k), _all_but_first(a, k), lambda x, y: F.xxhash64(x, y))


def _covered(places: Column, width: int) -> Column:
    """Words in windows whose hash occurs twice or more, each word once.

    places: (hash, position) sorted. Repeated windows stand side by side there;
    their positions, sorted again, cover the distance to the next one, at most
    the width.
    """
    repeated = F.filter(
        places,
        lambda x, i: (F.get(places, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(places, i + 1)["h"].eqNullSafe(x["h"])),
    )
    at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    steps = F.zip_with(
        at, _all_but_first(at, 1), lambda x, y: F.least(F.coalesce(y - x, F.lit(width)), F.lit(width))
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _places(windows: Column) -> Column:
    indexed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.sort_array(indexed)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row (all columns of docs), words and hashes of words, pairs and 8-word windows."""
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).alias("text")
    split = one.select("row", text).withColumn("words", F.filter(F.split("text", BLANK + "+"), lambda w: w != ""))
    hashed = split.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("h2", _joined(F.col("h1"), 1))


def _cells(buckets: int) -> Column:
    cell = lambda h: F.pmod(h, F.lit(buckets).cast("bigint")).cast("int")
    return F.concat(F.transform("h1", cell), F.transform("h2", cell))


def cell_counts(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000
) -> DataFrame:
    """cell, raw, good: how often every cell occurs in all documents and in the trusted ones.

    All documents are counted in one pass; the table has `buckets` rows, whatever
    the corpus. `trusted` (column id) marks documents before their words are counted:
    texts stay in place while the ids are few enough to be broadcast. Documents without
    words give a null cell, which the last join drops; leaving them out before would
    hash all texts twice.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = picked(slim, "id", trusted.select("id").distinct(), "left").select("text", F.col("_picked").isNotNull().alias("good"))
    cells = measured(marked).select(F.col("row.good").alias("good"), F.explode_outer(_cells(buckets)).alias("cell"))
    counted = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("raw"), F.count_if("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    return every.join(counted, "cell", "left").fillna(0, ["raw", "good"])


def log_ratios(counts: DataFrame, buckets: int = 10_000) -> DataFrame:
    """One row `weights`: per cell the log ratio of trusted to corpus frequency, in millionths.

    Each count is raised by one.
    """
    sums = counts.groupBy().agg(
        F.sum("raw").alias("raws"), F.sum("good").alias("goods"),
        F.sort_array(F.collect_list(F.struct("cell", "raw", "good"))).alias("cells"),
    )
    share = lambda count, total: F.log((count + 1) / (total + buckets))
    return sums.select(
        F.transform(
            "cells",
            lambda c: F.round(
                (share(c["good"], F.col("goods")) - share(c["raw"], F.col("raws"))) * MILLION
            ).cast("bigint"),
        ).alias("weights")
    )


def left_out_scores(
    docs: DataFrame, trusted: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    buckets: int = 10_000,
) -> DataFrame:
    """id, score of the trusted documents that pass the plain rules, each without its own part in `counts`.

    A document is left out with all rows of its id, so its score is that of a good
    document nobody labelled. Counts of its own cells are taken from its sorted cells, where
    equal ones stand side by side; only rows of ids that come more than once are shuffled.
    """
    ids = materialised(trusted.select("id").distinct(), "trusted")
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    twice = materialised(
        picked(slim.select("id"), "id", ids).groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("id"), "twice"
    )
    rows = picked(slim, "id", ids)

    def ruled(some: DataFrame) -> DataFrame:
        return _ruled(some, "text").select(F.col("row.id").alias("id"), F.col("base_failed").alias("failed"), _cells(buckets).alias("cells"))

    several = ruled(picked(rows, "id", twice)).groupBy("id").agg(
        F.max("failed").alias("failed"), F.flatten(F.collect_list("cells")).alias("cells")
    )
    every = ruled(picked(rows, "id", twice, "left_anti")).unionByName(several)
    placed = every.withColumn("cells", F.sort_array("cells"))
    whole = counts.groupBy().agg(
        F.struct(
            F.sum("raw").alias("raws"), F.sum("good").alias("goods"),
            F.transform(F.sort_array(F.collect_list(F.struct("cell", "raw", "good"))), lambda c: F.struct(c["raw"], c["good"])).alias("cells"),
        ).alias("all")
    )
    known = placed.withColumn("all", whole.scalar())

    def run(cell: Column, own: Column) -> Column:
        c = F.get("all.cells", cell)
        return F.when(own > 0, own * F.log((c["good"] - own + 1) / (c["raw"] + 1))).otherwise(0.0)

    def step(s: Column, cell: Column) -> Column:
        same = s["cell"] == cell
        return F.struct(
            cell.alias("cell"), F.when(same, s["own"] + 1).otherwise(1).alias("own"),
            F.when(same, s["total"]).otherwise(s["total"] + run(s["cell"], s["own"])).alias("total"),
        )

    start = F.struct(F.lit(-1).alias("cell"), F.lit(0).alias("own"), F.lit(0.0).alias("total"))
    total = F.aggregate("cells", start, step, lambda s: s["total"] + run(s["cell"], s["own"]))
    n = F.size("cells")
    score = total / n - F.log((F.col("all.goods") - n + buckets) / (F.col("all.raws") + buckets))
    # written before rows are dropped: a filter would be pushed down and repeat all that it looks at
    scored = materialised(known.select("id", "failed", n.alias("n"), F.when(n > 0, score).alias("score")), "scores")
    return scored.where("NOT failed AND n > 0").select("id", "score")


def trusted_ids(labels: DataFrame, rows: int | None = None) -> DataFrame:
    """Ids of all documents labelled good; with `rows` at most that many, those of smallest hash."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    if rows is not None:
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return good.select(F.col("doc_id").alias("id"))


def _ruled(docs: DataFrame, text_col: str) -> DataFrame:
    """`measured` with the counts and base_failed of every document."""
    h4 = measured(docs, text_col).withColumn("h4", _joined(F.col("h2"), 2))
    h8 = h4.withColumn("h8", _joined(F.col("h4"), 4))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    counted = h8.select(
        "row", "h1", "h2",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size(F.array_distinct("h8")) < F.size("h8"), _places(F.col("h8"))).alias("places"),
    )
    done = counted.select(
        "row", "h1", "h2", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("places").isNull(), F.lit(0).cast("bigint"))
        .otherwise(_covered(F.col("places"), 8)).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return done.withColumn("base_failed", failed)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 10_000,
    lost: float = 0.01,
) -> DataFrame:
    """row (all columns of docs), the counts, `score`, base_failed and kept of every document.

    Words are runs without space or \\t to \\r. Rejected are documents with fewer
    than 20 words, with over 30 % of words in repeated 8-word windows, or whose
    mean log ratio is below the cut: the `lost` quantile, interpolated for any number of
    them, of the scores of trusted documents that are left out of the trusted counts
    one by one. Without such documents only the plain rules reject. Every document labelled
    good is trusted, and every document is counted. A null text has no words. Rows without id, repeated
    rows and other columns of any name pass through `row` unchanged; an empty
    table gives an empty result.
    """
    trusted = materialised(trusted_ids(labels), "good")
    counts = materialised(cell_counts(docs, trusted, id_col, text_col, buckets), "cells")
    scores = left_out_scores(docs, trusted, counts, id_col, text_col, buckets)
    cut = exact_quantiles(scores, [], "score", {"cut": lost}).select(F.coalesce("cut", F.lit(float("-inf")))).scalar()
    judged = _ruled(docs, text_col).withColumns(
        {"cells": _cells(buckets), "weights": log_ratios(counts, buckets).scalar()}
    )
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda s, c: s + F.get(F.col("weights"), c))
    score = F.when(F.size("cells") > 0, total / F.size("cells") / MILLION).otherwise(0.0)
    return judged.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", score.alias("score"), "base_failed"
    ).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= cut))
