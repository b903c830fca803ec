"""Writing results: tables, header-first text, partitioned and split outputs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hashed
from ..operators.ordered import global_index
from ..shared import materialised


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated with a header; texts that need it are quoted, quotes inside doubled."""
    df.write.options(header=True, escape='"').csv(path)


def write_wide_counts(counts: DataFrame, path: str, cells_per_file: int = 64) -> None:
    """Long counts (gene, cell, n) as wide gene x cell tables, one file per block of cells.

    Every file has its own header and the genes that one of its cells counts, zeros written.
    Cells are numbered, and their place in the block is the column, so a table has the same
    width whatever the number of cells, and for each count at most one row of it is written. A missing cell is named null.
    """
    named = counts.select(F.col("gene").cast("string").alias("gene"), F.coalesce(F.col("cell").cast("string"), F.lit("null")).alias("cell"), "n")
    number = global_index(named.select("cell").distinct(), "cell", "_at")
    cells = materialised(
        number.select("cell", F.floor(F.col("_at") / cells_per_file).alias("block"), (F.col("_at") % cells_per_file).alias("_at")), "cells"
    )
    amount = F.sum("n")
    kind = named.select(amount.alias("n")).schema["n"].dataType.simpleString()
    if kind in ("float", "double"):
        amount = F.nanvl(amount, F.lit(None).cast(kind))
    zero = F.lit(0).cast(kind).cast("string")
    values = named.join(hashed(cells), "cell").select("block", F.lit(1).alias("_row"), "gene", "_at", "n", F.lit(None).cast("string").alias("name"))
    names = cells.select(
        "block", F.lit(0).alias("_row"), F.lit("gene").alias("gene"), "_at",
        F.lit(None).cast(named.schema["n"].dataType).alias("n"), F.col("cell").alias("name"),
    )
    # one task writes a block, so that it is one file; its counts are brought together there and nowhere else
    placed = names.unionByName(values).repartition("block")
    once = placed.groupBy("block", "_row", "gene", "_at", "name").agg(amount.alias("n"))
    field = F.when(F.col("_row") == 0, F.col("name")).otherwise(F.coalesce(F.col("n").cast("string"), zero))
    rows = once.groupBy("block", "_row", "gene").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_at").cast("int").alias("at"), field.alias("x")))).alias("_f")  # one a cell of the block
    )
    # cells without the gene are one repeated text, so that a row costs its counts and not its width until it is split
    absent = lambda n: F.repeat(F.concat(F.lit(","), zero), n)
    line = F.aggregate(
        "_f", F.struct(F.lit(0).alias("to"), F.lit("").alias("s")),
        lambda made, f: F.struct((f["at"] + 1).alias("to"), F.concat(made["s"], absent(f["at"] - made["to"]), F.lit(","), f["x"]).alias("s")),
        lambda made: F.concat(made["s"], absent(F.lit(cells_per_file) - made["to"])),
    )
    by_place = F.map_from_entries("_f")
    header = F.transform(F.sequence(F.lit(0), F.lit(cells_per_file - 1)), lambda k: F.try_element_at(by_place, k))
    fields = F.when(F.col("_row") == 0, header).otherwise(F.split(F.substring(line, 2, 1 << 30), ","))
    # its header comes first
    placed = rows.sortWithinPartitions("block", "_row").select("block", "gene", fields.alias("_f"))
    placed.select("block", "gene", *[F.get("_f", F.lit(k)).alias(f"c{k}") for k in range(cells_per_file)]).write.partitionBy(
        "block"
    ).options(header=False, escape='"').csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated, unquoted, with a header."""
    df.write.options(header=True, sep="\t", quote="").csv(path)


def write_lines(
    df: DataFrame,
    path: str,
    header: Sequence[str],
    sep: str = "\t",
    compression: str = "none",
    footer: Sequence[str] = (),
) -> None:
    """Header lines in the first part file, then the rows joined by `sep`, then the footer.

    Read in file-name order the parts are one valid file; rows are written by
    all tasks.
    """
    spark = df.sparkSession
    rows = df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    for lines, before in ((header, True), (footer, False)):
        if lines:
            edge = spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1)
            rows = edge.unionByName(rows) if before else rows.unionByName(edge)
    rows.write.option("compression", compression).text(path)


def write_by(df: DataFrame, path: str, *keys: str) -> None:
    """Publish under key prefixes, e.g. run_id and sample, spreading large keys over files."""
    df.write.partitionBy(*keys).option("maxRecordsPerFile", 5_000_000).parquet(path)


def write_split(df: DataFrame, condition: Column, accepted: str, rejected: str) -> None:
    """One flagged table, two outputs; the flagged rows are computed once."""
    flagged = df.withColumn("_ok", condition).persist()
    try:
        flagged.where("_ok").drop("_ok").write.parquet(accepted)
        flagged.where("NOT _ok").drop("_ok").write.parquet(rejected)
    finally:
        flagged.unpersist()


def write_sorted_vcf(variants: DataFrame, path: str, header: Sequence[str], order: Column) -> None:
    """Compressed variant text, parts in genome order, the header in the first part."""
    spark = variants.sparkSession
    rows = (
        variants.withColumn("_o", order)
        .repartitionByRange("_o", "pos")
        .sortWithinPartitions("_o", "pos")
    )
    body = rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in variants.columns]).alias("value"))
    first = spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1)
    first.unionByName(body).write.option("compression", "gzip").text(path)


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    """Paired outputs per sample and mate, four lines per read."""
    four = F.concat_ws(
        "\n",
        F.concat(F.lit("@"), F.col("name").cast("string"), F.lit("/"), F.col("mate").cast("string")),
        F.col("seq"), F.lit("+"), F.col("qual"),
    )
    reads.select("sample", "mate", four.alias("value")).write.partitionBy("sample", "mate").option(
        "compression", compression
    ).text(path)


def write_by_barcode(reads: DataFrame, path: str, barcodes: int = 64) -> None:
    """Reads bucketed by barcode hash, so that no folder per barcode is needed."""
    reads.withColumn("barcode_group", F.pmod(F.xxhash64("barcode"), F.lit(barcodes))).write.partitionBy(
        "barcode_group"
    ).parquet(path)


def save_experiment(tables: dict[str, DataFrame], path: str) -> None:
    """One parquet folder per member table of an experiment."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")


def load_experiment(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
