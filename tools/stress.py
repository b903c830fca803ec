"""Runs operators with one key holding a third of the rows and lists the slowest tasks.

Usage: python tools/stress.py FOLDER [ROWS]   (FOLDER: a new scratch folder)
Per stage it prints the longest and the median task time, the number of tasks,
and the largest share of shuffled rows any task read.
"""

import glob
import io
import json
import os
import sys
import time
from collections import defaultdict

import zstandard
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from strandflow.operators import bulk, cells, markers, ordered, reads  # noqa: E402


def cases(spark, folder, n):
    hot = F.col("id") % 3 == 0
    spark.range(n).select(
        F.when(hot, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).cast("bigint").alias("cell"),
        F.when(hot, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(20000))).cast("bigint").alias("gene"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(50)) + 1).alias("n"),
    ).groupBy("cell", "gene").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/expr")
    expr = spark.read.parquet(f"{folder}/expr")
    some = spark.range(5000).select(F.col("id").alias("cell"), (F.col("id") % 8).cast("int").alias("cluster"))
    turned = expr.select(F.col("gene").alias("cell"), F.col("cell").alias("gene"), (F.col("n") + F.rand(1)).alias("x"))
    every = expr.select(F.col("gene").alias("cell")).distinct().withColumn("cluster", (F.col("cell") % 8).cast("int"))
    locus = spark.range(n).select(
        F.lit("lib").alias("library"), F.lit(1).alias("chrom"), F.lit(1).alias("sample"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 1000000).alias("pos"), (F.col("id") % 2).cast("int").alias("strand"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("qual_sum"), F.col("id").alias("name"),
    )
    genes = spark.range(2000).select(
        F.lit(1).alias("chrom"), (F.col("id") * 500).alias("iv_start"), (F.col("id") * 500 + 700).alias("iv_end"), F.col("id").alias("gene")
    )
    p = spark.range(n).select(F.col("id").alias("gene"), F.when(hot, F.lit(1.0)).otherwise(F.rand(3)).alias("p"))
    yield "normalised", lambda: cells.normalised(expr)
    yield "top shares", lambda: cells.top_shares(expr)
    yield "markers", lambda: markers.marker_stats(cells.normalised(expr), some)
    yield "rank sums", lambda: markers.rank_sums(turned, every)
    yield "display clip", lambda: cells.display_clip(turned)
    yield "row index", lambda: ordered.global_index(spark.range(n).select(F.xxhash64("id").alias("id")), "id")
    yield "duplicates", lambda: reads.mark_duplicates(locus)
    yield "gene counts", lambda: reads.gene_counts(locus, genes)
    yield "adjusted p", lambda: bulk.adjusted_p(p)


def summary(folder):
    tasks, names = defaultdict(list), {}
    for path in glob.glob(f"{folder}/eventlog*/events*"):
        with open(path, "rb") as raw:
            stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) if path.endswith("zstd") else raw
            for line in io.TextIOWrapper(stream):
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    for stage in event["Stage IDs"]:
                        names[stage] = (event.get("Properties") or {}).get("spark.job.description", "")
                elif event["Event"] == "SparkListenerTaskEnd":
                    m = event.get("Task Metrics") or {}
                    rows = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks[event["Stage ID"]].append((m.get("Executor Run Time", 0), rows))
    for stage, done in sorted(tasks.items(), key=lambda s: -max(t for t, _ in s[1]))[:20]:
        times, rows = sorted(t for t, _ in done), [r for _, r in done]
        share = max(rows) / sum(rows) if sum(rows) else 0.0
        print(f"{names.get(stage, ''):14s} longest {times[-1]:6d} ms  median {times[len(times) // 2]:6d} ms  tasks {len(times):4d}  largest share {share:.2f}")


def main():
    folder, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 6_000_000
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "64").config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8MB")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, make in cases(spark, folder, n):
        spark.sparkContext.setJobDescription(name)
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        print(f"{name:14s} {time.time() - start:6.1f} s", flush=True)
    spark.stop()
    summary(folder)


if __name__ == "__main__":
    main()
