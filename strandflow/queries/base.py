"""Registering queries with the SQL that checks them, and shared input views."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Omics-shaped views over the given tables. The same text runs in Spark and in the check.
VIEWS = {
    "v_expr": """
SELECT l_suppkey AS cell, l_partkey AS gene, CAST(SUM(l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "v_cells": """
SELECT s_suppkey AS cell, s_name AS barcode, CAST(s_nationkey % 5 AS INT) AS cluster,
       CASE WHEN s_nationkey % 2 = 0 THEN 'control' ELSE 'patient' END AS condition
FROM supplier""",
    "v_genes": """
SELECT p_partkey AS gene, p_name AS symbol, p_brand = 'Brand#2' AS mt FROM part""",
    "v_bulk": """
SELECT CAST(l_suppkey % 6 AS INT) AS sample,
       CASE WHEN l_suppkey % 6 < 3 THEN 'control' ELSE 'patient' END AS condition,
       l_partkey AS gene, CAST(SUM(l_quantity) AS BIGINT) AS n, CAST(MAX(l_linenumber) * 100 AS INT) AS len
FROM lineitem GROUP BY l_suppkey % 6, l_partkey""",
    "v_tx2gene": """
SELECT concat('T', CAST(p_partkey AS STRING), '.', CAST(p_size AS STRING)) AS tx,
       concat('T', CAST(p_partkey AS STRING)) AS tx_base, p_brand AS gene
FROM part""",
    "v_quant": """
SELECT CAST(l_suppkey % 6 AS INT) AS sample,
       concat('T', CAST(l_partkey AS STRING), '.', CAST(l_partkey % 7 AS STRING)) AS tx,
       CAST(SUM(l_quantity) AS BIGINT) AS n, CAST(MAX(l_linenumber) * 100 AS INT) AS len,
       CAST(SUM(l_quantity) AS BIGINT) / CAST(MAX(l_linenumber) * 100 AS DOUBLE) AS tpm
FROM lineitem GROUP BY l_suppkey % 6, l_partkey""",
    "v_de": """
SELECT gene, round(log2((p + 1.0) / (c + 1.0)), 6) AS lfc,
       CASE WHEN c > 0 AND p > 0 THEN round(exp(-abs(p - c) / 10.0), 6) END AS p
FROM (SELECT gene, CAST(SUM(CASE WHEN condition = 'control' THEN n ELSE 0 END) AS BIGINT) AS c,
             CAST(SUM(CASE WHEN condition = 'patient' THEN n ELSE 0 END) AS BIGINT) AS p
      FROM v_bulk GROUP BY gene) AS s""",
    "v_geno": """
WITH r AS (
  SELECT CAST(l_suppkey % 6 AS INT) AS sample, CAST(l_orderkey % 26 AS INT) AS c,
         l_orderkey * 10 + l_linenumber % 2 AS pos, l_quantity, l_discount, l_tax,
         l_extendedprice, l_returnflag, l_linestatus
  FROM lineitem),
g AS (
  SELECT sample, c, pos, CAST(MAX(l_quantity) AS INT) AS dp,
         CASE WHEN MAX(l_tax) = 0 THEN NULL ELSE CAST(ROUND(MAX(l_discount) * 100) AS INT) * 10 END AS gq,
         MAX(l_extendedprice) AS qual,
         MAX(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS rf,
         MAX(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) AS ls
  FROM r GROUP BY sample, c, pos)
SELECT sample,
       CASE WHEN c < 22 THEN CAST(c + 1 AS STRING) WHEN c = 22 THEN 'X' WHEN c = 23 THEN 'Y'
            WHEN c = 24 THEN 'MT' ELSE 'GL1' END AS chrom,
       pos,
       substr('ACGT', CAST(pos % 4 AS INT) + 1, 1) AS ref,
       CASE WHEN pos % 11 = 0 THEN concat(substr('ACGT', CAST(pos % 4 AS INT) + 1, 1), 'AG')
            ELSE substr('ACGT', CAST((pos % 4 + 1 + pos % 3) % 4 AS INT) + 1, 1) END AS alt,
       CASE WHEN rf = 0 THEN '0/0' WHEN rf = 1 THEN '0/1' WHEN ls = 0 THEN '1/1' ELSE '1/2' END AS gt,
       dp, gq, qual,
       concat(CASE WHEN rf = 0 THEN '0/0' ELSE '0/1' END, ':', CAST(dp - dp % 3 AS STRING), ',',
              CAST(dp % 3 AS STRING), ':', CAST(dp AS STRING)) AS fmt
FROM g""",
    "v_sites": """
SELECT chrom, pos, ref, alt, MAX(qual) AS score, CAST(MAX(dp) AS INT) AS dp
FROM v_geno GROUP BY chrom, pos, ref, alt""",
    "v_af": """
SELECT DISTINCT chrom, pos, ref, alt, CAST(pos % 100 AS DOUBLE) / 100 AS af FROM v_geno WHERE pos % 3 = 0""",
    "v_truth": """
SELECT DISTINCT chrom, pos, ref, alt FROM v_geno WHERE pos % 5 = 0""",
    "v_intervals": """
SELECT CAST(n_nationkey % 22 + 1 AS STRING) AS chrom, CAST(n_nationkey AS BIGINT) * 5000 AS iv_start,
       CAST(n_nationkey AS BIGINT) * 5000 + 40000 AS iv_end, n_name AS name
FROM nation""",
    "v_chain": """
SELECT CAST(n_nationkey % 5 + 1 AS STRING) AS chrom, CAST(n_nationkey AS BIGINT) * 6000 AS src_start,
       CAST(n_nationkey AS BIGINT) * 6000 + CASE WHEN n_nationkey % 3 = 0 THEN 35000 ELSE 20000 END AS src_end,
       CAST(n_nationkey AS BIGINT) * 6000 + 777 AS tgt_start,
       CAST(n_nationkey % 5 + 1 AS STRING) AS tgt_chrom,
       CASE WHEN n_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand, n_name AS name
FROM nation""",
    "v_reads": """
SELECT event_id AS name, event_type AS library, CAST(user_id % 5 + 1 AS INT) AS chrom,
       CAST(floor(value * 4) AS BIGINT) AS pos, CAST(event_id % 2 AS INT) AS strand,
       CAST(user_id % 60 AS INT) AS mapq, CAST(user_id AS BIGINT) AS qual_sum,
       concat(substr('ACGT', CAST(event_id % 4 AS INT) + 1, 1), substr('CATG', CAST(user_id % 4 AS INT) + 1, 1), 'GT') AS seq
FROM events""",
    "v_alns": """
SELECT event_id AS name, event_type AS sample, CAST(user_id % 5 + 1 AS INT) AS chrom,
       CAST(floor(value * 40) AS BIGINT) AS pos, CAST(event_id % 2 AS INT) AS strand, CAST(user_id % 60 AS INT) AS mapq,
       CASE CAST(user_id % 8 AS INT) WHEN 0 THEN '12M' WHEN 1 THEN '3S9M' WHEN 2 THEN '5M2I5M' WHEN 3 THEN '4M3D8M'
            WHEN 4 THEN '6M500N6M' WHEN 5 THEN '2S4M1I3M2D2M' WHEN 6 THEN '2H1I4=2X5M1P' ELSE '*' END AS cigar,
       concat(substr('ACGTACG', CAST(event_id % 4 AS INT) + 1, 3), substr('CATGGAC', CAST(user_id % 4 AS INT) + 1, 4),
              substr('TTGACCA', CAST(event_id % 3 AS INT) + 1, 5)) AS seq,
       concat(substr('5:?DI5:', CAST(event_id % 3 AS INT) + 1, 5), substr('?DI5:?DII', CAST(user_id % 3 AS INT) + 1, 7)) AS qual
FROM events""",
    "v_exons": """
SELECT n_name AS gene, CAST(n_nationkey % 5 + 1 AS INT) AS chrom, CASE WHEN n_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CAST(n_nationkey * 700 + k * 300 AS BIGINT) AS iv_start, CAST(n_nationkey * 700 + k * 300 + 90 + n_regionkey * 40 AS BIGINT) AS iv_end
FROM nation CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) AS e""",
    "v_reference": """
SELECT CAST(p_partkey % 5 + 1 AS INT) AS chrom, CAST(floor((p_partkey - 1) / 5) * 16 AS BIGINT) AS start,
       substr(concat('ACGTTGCA', 'CCATGGAT', 'TTGACCAA', 'GGTTAACC'), CAST(p_size % 16 AS INT) + 1, 16) AS text
FROM part""",
    "v_map": """
SELECT CAST(p_partkey % 22 + 1 AS STRING) AS chrom, CAST(p_partkey * 300 AS BIGINT) AS pos,
       floor(p_partkey / 22) * 0.05 + floor(p_partkey / 66) * 0.4 AS cm
FROM part""",
    "v_sets": """
SELECT c_custkey AS id,
       CAST(MAX(CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 1 ELSE 0 END) AS INT) AS s1,
       CAST(MAX(CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN 1 ELSE 0 END) AS INT) AS s2,
       CAST(MAX(CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN 1 ELSE 0 END) AS INT) AS s3,
       CAST(MAX(CASE WHEN substr(o_orderpriority, 1, 1) = '4' THEN 1 ELSE 0 END) AS INT) AS s4,
       CAST(MAX(CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 1 ELSE 0 END) AS INT) AS s5
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "v_pred": """
SELECT l_linestatus AS var_type,
       CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
       CAST((l_linenumber + l_partkey) % 3 AS INT) AS yhat
FROM lineitem""",
    "v_junctions": """
SELECT CAST(l_suppkey % 6 AS INT) AS sample, l_returnflag AS chrom,
       (l_partkey % 200) * 100000 AS j_start, (l_partkey % 200) * 100000 + l_linenumber * 1000 AS j_end,
       CAST(SUM(l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_suppkey % 6, l_returnflag, l_partkey % 200, l_linenumber""",
    "v_events": """
SELECT l_partkey AS event, CAST(l_suppkey % 6 AS INT) AS sample,
       CASE WHEN l_suppkey % 6 < 3 THEN 'control' ELSE 'patient' END AS condition,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS BIGINT) AS inc,
       CAST(SUM(CASE WHEN l_returnflag <> 'A' THEN l_quantity ELSE 0 END) AS BIGINT) AS skip
FROM lineitem GROUP BY l_partkey, l_suppkey % 6""",
    "v_listing": """
SELECT DISTINCT o_custkey AS id, o_orderpriority AS suffix FROM orders""",
    "v_weights": """
SELECT p_partkey AS gene, CAST(p_size % 3 AS INT) AS label, p_size / 50.0 AS w FROM part""",
}
NEEDS = {
    "v_af": ["v_geno"], "v_truth": ["v_geno"], "v_sites": ["v_geno"], "v_de": ["v_bulk"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_views(names: str | list[str], sql: str) -> str:
    """SQL text that carries the views it uses."""
    names = names.split() if isinstance(names, str) else names
    ordered: list[str] = []
    for name in names:
        for need in [*NEEDS.get(name, []), name]:
            if need not in ordered:
                ordered.append(need)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Views that keep nearly every row as a group of its own, by the table and columns they group by.
GROUPED = {"v_expr": ("lineitem", ["l_suppkey", "l_partkey"])}
#: Rows that a task groups there, whatever the size of the table.
ROWS_A_TASK = 250_000


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the views above as a DataFrame."""
    text = with_views(name, f"SELECT * FROM {name}")
    for t in TABLES:
        if re.search(rf"\b{t}\b", text):
            rows = table(spark, folder, t)
            if GROUPED.get(name, ("",))[0] == t:
                rows = rows.repartition(-(-rows.count() // ROWS_A_TASK) or 1, *GROUPED[name][1])
            rows.createOrReplaceTempView(t)
    return spark.sql(text)


def view_over(rows: DataFrame, name: str, source: str) -> DataFrame:
    """One of the views above that reads only the view `source`, over rows of it that stand somewhere already."""
    rows.createOrReplaceTempView(source)
    return rows.sparkSession.sql(VIEWS[name])


def register(name: str, sql: str | None = None, views: str = ""):
    """Decorator: a query by name, with its check where SQL can express one."""

    def keep(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double; adding 0.0 turns a negative zero into zero."""
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
