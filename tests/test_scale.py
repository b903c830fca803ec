"""Plans and steps that decide how much a task holds or how often a table is computed."""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from strandflow.llm import texts
from strandflow.operators import alleles, cells, joins
from strandflow.queries import base, plans, variants


def plan_of(df):
    """The plan as it was run, without the one that it began with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_text_batches_are_cut_before_they_are_sent(spark):
    """Workers get batches of BATCH_BYTES, not Spark's 64 MB of which they then take slices."""
    rows = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.get_total_buffer_size()])], names=["n"])

    sent = [r.n for r in texts.map_batches(rows, sizes, "n bigint").collect()]
    assert len(sent) > 1 and max(sent) < 4 * texts.BATCH_BYTES


def test_sizes_of_settings():
    assert [texts._bytes_of(s) for s in ("67108864b", "64m", "64MB", "4194304")] == [64 << 20] * 3 + [4 << 20]
    assert texts._bytes_of("-1") > 1 << 40


def test_floors_sort_no_counts(spark):
    expr = spark.range(2000).select((F.col("id") % 50).alias("cell"), (F.col("id") * 7 % 90).alias("gene"), F.lit(1).alias("n"))
    found = cells.floor_cells_and_genes(expr, 3, 2)
    assert "SortMergeJoin" not in plan_of(found)
    assert found.count() == 2000


def test_a_few_long_intervals_are_not_shuffled(spark):
    """One interval per chromosome has more than BROADCAST_COPIES bins of 16 kb, but is one row."""
    long = spark.createDataFrame([("1", 100, 400_000_000), ("2", 5, 30)], "chrom string, iv_start bigint, iv_end bigint")
    rows = [("1", 99, 100), ("1", 100, 101), ("1", 300_000_000, 300_000_001), ("1", 400_000_000, 400_000_001), ("2", 29, 31), ("2", 30, 31), ("1", 0, 500_000_000)]
    left = spark.createDataFrame(rows, "chrom string, start bigint, end bigint")
    met = joins.overlap_join(left, long, how="left_semi")
    assert sorted(map(tuple, met.collect())) == sorted([rows[1], rows[2], rows[4], rows[6]])
    assert "SortMergeJoin" not in plan_of(met)


def test_calls_are_computed_once(spark, tmp_path, monkeypatch):
    """The two call queries build the calls view once and read it from a table afterwards."""
    lines = spark.range(300).select(
        F.floor(F.col("id") / 2).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 12).alias("l_suppkey"), (F.col("id") % 2).cast("int").alias("l_linenumber"),
        (F.col("id") % 40 + 1.0).alias("l_quantity"), (F.col("id") * 3.5).alias("l_extendedprice"), (F.col("id") % 10 / 100).alias("l_discount"), (F.col("id") % 8 / 100).alias("l_tax"),
        F.substring(F.lit("ANR"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"), F.substring(F.lit("FO"), (F.col("id") % 2 + 1).cast("int"), F.lit(1)).alias("l_linestatus"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    for module, name in ((plans, "cohort_regions_and_report"), (variants, "J12_unified_calls")):
        made = []
        monkeypatch.setattr(module, "view", lambda s, d, n, made=made: made.append(n) or base.view(s, d, n))
        out = base.QUERIES[name](spark, str(tmp_path))
        assert made == ["v_geno"]
        assert out.count() > 0
        assert not re.search("lineitem", plan_of(out))


def test_counts_are_grouped_in_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    lines = spark.range(1000).select((F.col("id") % 10).alias("l_suppkey"), (F.col("id") % 100).alias("l_partkey"), F.lit(2.0).alias("l_quantity"))
    lines.unionByName(lines.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in lines.dtypes])).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(base, "ROWS_A_TASK", 100)
    found = base.view(spark, str(tmp_path), "v_expr")
    assert found.rdd.getNumPartitions() == 11
    assert sorted(r.n or 0 for r in found.collect()) == [0] + [20] * 100


def test_prefixes_of_short_and_long_texts(spark):
    pairs = [("A", "A", 1), ("A", "C", 0), ("", "A", 0), ("A", "AC", 1), ("ACG", "ACT", 2), ("CG", "CG", 2), ("", "", 0)]
    rows = spark.createDataFrame(pairs, "a string, b string, n int")
    assert [r.got for r in rows.select(alleles._shared(F.col("a"), F.col("b")).alias("got")).collect()] == [n for *_, n in pairs]
