"""The registered queries of this subpackage and the SQL that checks them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import materialised
from . import (
    alignment, bpe_stream, chat, cover_tree, fixity, merkle_manifest, packing, pii, ppm, quality, secret_scan, set_join, url_rules,
)

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op10_jaccard_classes(spark, folder):
    """Classes of documents whose 4-word shingles overlap by 85 % or more."""
    return set_join.jaccard_classes(table(spark, folder, "documents"))


@query
def op5_quality_rules(spark, folder):
    """Counts, likelihood ratio score and verdict of every document."""
    out = quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "score",
    )


@query
def op2_secret_spans(spark, folder):
    """Secrets in all documents: pattern spans and spans confirmed by their structure."""
    found = secret_scan.secret_spans(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    return found.select(
        "row.doc_id",
        secret_scan.counted(spans, "assign").alias("n_assign"),
        secret_scan.counted(spans, "access").alias("n_access"),
        secret_scan.counted(spans, "hex").alias("n_hex"),
        F.sha2(secret_scan.listed(secret_scan.base_spans(spans)), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


TRICKY = r"\### Assistant: </turn> ok"


@query
def op3_chat_format(spark, folder):
    """All conversations formatted, and digests of what is read back from the output."""
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    messages = rows.withColumn("parts", chat.typed_parts(F.coalesce("text", F.lit(""))))
    out = chat.formatted(messages)
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join("trained", "")
    return chat.read_back(out).select(
        "conv_id", "n_turns", F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLES["op3_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), one AS (
    SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
        CASE WHEN role = 'assistant' THEN text ELSE '' END AS trained
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    sum(length(trained))::BIGINT AS loss_chars,
    sha256(string_agg(trained, '' ORDER BY turn)) AS loss_sha256,
    sum(8 + length(role) + 8 + length(body) + 7)::BIGINT AS formatted_chars
FROM one GROUP BY conv_id
"""


@query
def op7_best_fit_packing(spark, folder):
    """All documents in as few sequences of 2048 tokens as vector best fit makes."""
    return packing.pack_documents(table(spark, folder, "documents"))


@query
def op8_bpe_stream(spark, folder):
    """All documents through the streaming encoder and decoder."""
    return bpe_stream.round_trip(table(spark, folder, "documents"))


@query
def op1_fixity_audit(spark, folder):
    """Pages as records of one archive per host against a damaged replica.

    In the replica records with page_id % 97 = 5 have a changed byte and those with 11
    are missing; those with 23 are missing in the first one.
    """
    fate = F.pmod("page_id", F.lit(97))
    hurt = F.when(fate == 5, F.concat(F.lit("#"), F.substring("html", 2, 2**31 - 1))).otherwise(F.col("html"))
    whole = fixity.warc_record(F.col("url"), F.col("html"))
    records = table(spark, folder, "pages").select(
        "page_id", url_rules.url_parts(F.col("url"))[0].alias("archive"),
        F.octet_length(whole).cast("bigint").alias("length"), F.sha2(whole, 256).alias("digest"),
        F.sha2(fixity.warc_record(F.col("url"), hurt), 256).alias("hurt"),
    )
    laid = materialised(fixity.with_offsets(records, ["page_id", "digest"]), "records")
    return fixity.audit(
        laid.where(F.coalesce(fate != 23, F.lit(True))),
        laid.where(F.coalesce(fate != 11, F.lit(True))).withColumn("digest", F.col("hurt")),
    )


ORACLES["op1_fixity_audit"] = r"""
WITH page AS (
    SELECT page_id, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS archive,
        coalesce(url, '') AS url, coalesce(html, '') AS html,
        CASE WHEN page_id % 97 = 5 THEN '#' || substr(html, 2) ELSE coalesce(html, '') END AS hurt,
        chr(13) || chr(10) AS nl
    FROM pages
), head AS (
    SELECT *, 'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || url || nl
        || 'Content-Type: text/html' || nl || 'Content-Length: ' AS h
    FROM page
), rec AS (
    SELECT page_id, archive, h || strlen(html) || nl || nl || html || nl || nl AS a,
        h || strlen(hurt) || nl || nl || hurt || nl || nl AS b
    FROM head
), laid AS (
    SELECT *, coalesce(sum(strlen(a)) OVER (
        PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0)::BIGINT AS place FROM rec
)
SELECT archive, place AS "offset", strlen(a)::BIGINT AS length,
    CASE page_id % 97 WHEN 5 THEN 'changed' WHEN 11 THEN 'missing' ELSE 'extra' END AS status,
    CASE WHEN page_id % 97 <> 23 THEN sha256(a) END AS digest_a,
    CASE WHEN page_id % 97 <> 11 THEN sha256(b) END AS digest_b
FROM laid WHERE page_id % 97 IN (5, 11, 23)
"""


@query
def op4_ppm_score(spark, folder):
    """All documents under a byte trie learnt from those that are not held out."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    return ppm.score_documents(table(spark, folder, "documents"), held)


@query
def op6_url_rules(spark, folder):
    """Host, path, site rule and verdict of every page's url."""
    return url_rules.judge_urls(table(spark, folder, "pages").select("page_id", "url")).select(
        "row.page_id", "host", "path", "rule", "verdict"
    )


@query
def op9_cover_tree(spark, folder):
    """Vectors within cosine 0.9: number of links, component and whether it stays."""
    return cover_tree.cosine_links(table(spark, folder, "embeddings"))


@query
def op12_merkle_proofs(spark, folder):
    """Manifest of all documents with proofs, checked against rows whose line ends were lost."""
    docs = table(spark, folder, "documents")
    values = ["doc_id", "source", "lang", "n_chars", "text"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    hurt = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = merkle_manifest.row_digest([*map(F.col, values[:-1]), hurt])
    found = merkle_manifest.manifest(docs, values, carried=[now.alias("now")])
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle_manifest.folded(F.col("carried.now"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_LEVELS = 12
ORACLES["op12_merkle_proofs"] = (
    r"""
WITH crc AS (
    SELECT doc_id, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten([[ascii(substr(doc_id::VARCHAR, k::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
            for k in range(1, length(doc_id::VARCHAR) + 1)])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END)) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), f AS (
    SELECT d.*, coalesce(crc % 2 = 0, false) AS hurt, coalesce('1' || source, '0') AS tree,
        coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        replace(text, chr(10), '') AS bare
    FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id
), leaf AS (
    SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS d,
        sha256(head || CASE WHEN hurt THEN coalesce(strlen(bare) || ':' || bare, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS e
    FROM f
), s0 AS (
    SELECT tree, doc_id, d, e, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaf
)"""
    + "".join(
        f""", {t}{k + 1} AS (
    SELECT tree, i // 3 AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {t}{k}) AS x GROUP BY tree, i // 3
)"""
        + (
            f""", t0 AS (
    SELECT '' AS tree, d, tree AS g, row_number() OVER (ORDER BY tree) - 1 AS i FROM s{_LEVELS}
)""" if t == "s" and k == _LEVELS - 1 else ""
        )
        for t in "st" for k in range(_LEVELS)
    )
    + """, p0 AS (SELECT doc_id, tree, d AS leaf, e AS up, i, '' AS proof FROM s0)"""
    + "".join(
        f""", q{t}{k} AS (
    SELECT tree, i // 3 AS p, count(*) OVER (PARTITION BY tree) AS n, i, d,
        coalesce(string_agg(d, '') OVER (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
        coalesce(string_agg(d, '') OVER (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
    FROM {t}{k}
), {'p' if t == 's' else 'r'}{k + 1} AS (
    SELECT x.doc_id, x.tree, x.leaf, CASE WHEN n = 1 THEN x.up ELSE sha256(a || x.up || b) END AS up, x.i // 3 AS i,
        {'x.subroot, ' if t == 't' else ''}CASE WHEN n = 1 THEN x.proof ELSE x.proof || a || b END AS proof
    FROM {'p' if t == 's' else 'r'}{k} AS x JOIN q{t}{k} AS y ON x.tree = y.tree AND x.i = y.i
)"""
        + (
            f""", r0 AS (
    SELECT x.doc_id, '' AS tree, x.leaf, x.up, t0.i, t0.d AS subroot, x.proof FROM p{_LEVELS} AS x JOIN t0 ON x.tree = t0.g
)""" if t == "s" and k == _LEVELS - 1 else ""
        )
        for t in "st" for k in range(_LEVELS)
    )
    + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, up AS folded_root, up = d AS verified
FROM r{_LEVELS} JOIN t{_LEVELS} ON true
"""
)


@query
def op13_token_alignment(spark, folder):
    """Groups and links of two tokenizers over all documents, with corpus-wide counts of the links."""
    return alignment.align(table(spark, folder, "documents"))[0]


@query
def op11_pii_spans(spark, folder):
    """Personal data in all documents: pattern spans, and proposals that boosted trees accept."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(pii.BASE))
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return pii.pii_spans(docs, pii.fit(docs)).select(
        "row.doc_id", *[number(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(spans).alias("spans"),
    )
