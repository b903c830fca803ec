"""Fixity audit of web archives: Merkle trees over ordered offset ranges, in SQL functions.

Every record of an archive has an offset and a digest. The records that start in
one range of `leaf_bytes` make a leaf: the digest of their offsets, lengths and
digests in order. Sixteen neighbours make a node of the next level, up to one root
per archive. Two replicas with equal roots hold the same records. Otherwise only
branches that differ are descended, down to the ranges and then to the records.
Ranges are fixed by offset, so a large archive is many leaves; nothing gathers more
than one range or sixteen digests.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ranged, scan
from ..shared import materialised

LEAF_BYTES = 1 << 18
BITS = 4  # sixteen children


def with_offsets(records: DataFrame, order: list[str]) -> DataFrame:
    """records (archive, length, ...) with the `offset` of each in its archive, in the given order.

    Running sums over ranges of (archive, order), so that no archive is one task.
    """
    placed = ranged(records.withColumn("_one", F.lit(1)), ["archive"], order)
    return scan(placed, ["archive"], order, {"offset": ("sum", "length")}, inclusive=False).drop("_one", "_bucket")


def _nodes(entries: DataFrame, leaf_bytes: int) -> DataFrame:
    """Level 0: archive, level, idx and both replicas' hashes of every range."""
    entry = F.concat_ws(":", F.col("offset"), F.col("length"), F.col("digest"))
    line = F.struct("offset", "length", "digest", entry.alias("line"))
    per = entries.withColumn("idx", F.floor(F.col("offset") / leaf_bytes)).groupBy("archive", "idx").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("replica") == r, line))).alias(r) for r in ("a", "b")
        ]
    )
    return per.select(
        "archive", F.lit(0).alias("level"), "idx",
        *[
            F.when(F.size(r) > 0, F.sha2(F.array_join(F.transform(r, lambda x: x["line"]), "\n"), 256)).alias(r)
            for r in ("a", "b")
        ],
    )


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    named = lambda r: F.when(F.col(r).isNotNull(), F.struct("idx", F.concat_ws(":", "idx", r).alias("line")))
    up = nodes.groupBy("archive", F.shiftright("idx", BITS).alias("_up")).agg(
        *[F.sort_array(F.collect_list(named(r))).alias(r) for r in ("a", "b")]
    )
    return up.select(
        "archive", F.lit(level).alias("level"), F.col("_up").alias("idx"),
        *[
            F.when(F.size(r) > 0, F.sha2(F.array_join(F.transform(r, lambda x: x["line"]), "\n"), 256)).alias(r)
            for r in ("a", "b")
        ],
    )


def trees(entries: DataFrame, leaf_bytes: int = LEAF_BYTES) -> list[DataFrame]:
    """Tables of nodes by level, the last with one root per archive."""
    level = materialised(_nodes(entries, leaf_bytes), "leaves")
    tables = [level]
    highest = level.agg(F.max("idx")).first()[0] or 0
    while highest > 0:
        level = materialised(_parents(level, len(tables)), "nodes")
        tables.append(level)
        highest >>= BITS
    return tables


def audit(replica_a: DataFrame, replica_b: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """archive, offset, length, status, digest_a and digest_b of every record that differs.

    Replicas: archive, offset, length, digest. status: `changed` (both hold a record at
    the offset, but another one), `missing` (only a holds one), `extra` (only b).
    Records at one offset are paired in the order of length and digest. A null
    archive is an archive of its own; null lengths and digests are empty entries;
    rows without offset count as offset 0. Repeated rows are compared one by one.
    Other columns are not looked at; equal replicas and empty tables give an
    empty result.
    """
    one = lambda df, name: df.select(
        F.lit(name).alias("replica"), F.coalesce("archive", F.lit("")).alias("archive"),
        F.coalesce(F.col("offset").cast("bigint"), F.lit(0).cast("bigint")).alias("offset"),
        F.coalesce(F.col("length").cast("bigint"), F.lit(0).cast("bigint")).alias("length"),
        F.coalesce("digest", F.lit("")).alias("digest"),
    )
    entries = one(replica_a, "a").unionByName(one(replica_b, "b"))
    tables = trees(entries, leaf_bytes)
    differ = lambda t: t.where(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "idx")
    open_nodes = differ(tables[-1])
    for table in reversed(tables[:-1]):
        below = table.withColumn("_up", F.shiftright("idx", BITS))
        above = open_nodes.select(F.col("archive").alias("_a"), F.col("idx").alias("_i"))
        open_nodes = differ(below.join(above, (F.col("archive") == F.col("_a")) & (F.col("_up") == F.col("_i")), "left_semi"))
    ranges = open_nodes.select(F.col("archive").alias("_a"), F.col("idx").alias("_i"))
    suspects = entries.join(
        ranges, (F.col("archive") == F.col("_a")) & (F.floor(F.col("offset") / leaf_bytes) == F.col("_i")), "left_semi"
    )
    record = F.struct("length", "digest")
    paired = suspects.groupBy("archive", "offset").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("replica") == r, record))).alias(r) for r in ("a", "b")]
    )
    both = paired.select("archive", "offset", F.explode(F.arrays_zip("a", "b")).alias("p"))
    return both.where(~F.col("p.a").eqNullSafe(F.col("p.b"))).select(
        "archive", "offset", F.coalesce("p.a.length", "p.b.length").alias("length"),
        F.when(F.col("p.b").isNull(), "missing").when(F.col("p.a").isNull(), "extra").otherwise("changed").alias("status"),
        F.col("p.a.digest").alias("digest_a"), F.col("p.b.digest").alias("digest_b"),
    )


def warc_record(url: Column, body: Column) -> Column:
    """A response record as text: header lines, a blank line, the body and the record's end."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
