"""Line-oriented text inputs; line numbers come from file splits, not from one task."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import hashed
from ..operators.ordered import BUCKET, scan
from ..shared import materialised


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str | list[str], per_file: bool = True) -> DataFrame:
    """Lines with `file` and a 0-based `line_no`, per file or over all files by name.

    Ids grow along a file split, so a line's place in its split needs no sort;
    the sizes of earlier splits (one row per split, broadcast: lines stay in place) are added on top.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = lines.groupBy("file", "_block").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_first")
    )
    keys = ["file"] if per_file else []
    order = Window.partitionBy(*keys).orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0))).drop("_size")
    numbered = lines.join(F.broadcast(offsets), ["file", "_block"])
    return numbered.select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "value")


def read_table(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = ",") -> DataFrame:
    """CSV or TSV with a header; types are inferred only where no schema is given."""
    reader = spark.read.option("header", True).option("sep", sep)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


#: A field and the comma before it: quoted, with doubled quotes inside, or plain up to the next comma.
FIELD = r'(?s),(?:"(?:[^"]++|"")*+"|[^,"]*+)'
LINES_AT_ONCE = 1 << 16


#: Bytes of text that a task looks through at once, unless one line has more.
BYTES_AT_ONCE = 2 << 20


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of at most BYTES_AT_ONCE or one row."""
    if batch.num_rows > 1 and batch.nbytes > BYTES_AT_ONCE:
        half = batch.num_rows // 2
        yield from _pieces(batch.slice(0, half))
        yield from _pieces(batch.slice(half))
    elif batch.num_rows:
        yield batch


#: A record of which the first field alone is quoted: that field, and what stands behind it.
FIRST_QUOTED = '^"(?P<first>(?:[^"]|"")*)"(?P<rest>(?:,[^"]*)?)$'
SPARSE = "value string, gene string, width int, kept array<struct<at:int,x:string>>"


def _sparse(value: pa.Array, tried: np.ndarray) -> list[pa.Array]:
    """The columns SPARSE of records: those tried that can be split at commas, no field but the first being quoted, have
    gene (first field), width (number of fields) and kept (the others with their places, no zeros); the rest keep their text."""
    quoted = tried & pc.match_substring(value, '"').to_numpy(zero_copy_only=False)
    found = pc.extract_regex(value.filter(pa.array(quoted)), FIRST_QUOTED)
    led = np.zeros(len(value), bool)
    led[np.flatnonzero(quoted)[found.is_valid().to_numpy(zero_copy_only=False)]] = True
    found = found.drop_null()
    good = tried & (led | ~quoted)
    own = np.arange(len(value))
    own[led] = len(value) + np.arange(len(found))
    lines = pa.concat_arrays([value, found.field("rest")]).take(pa.array(own[good]))
    lists = pc.split_pattern(lines, ",")
    width = pc.list_value_length(lists).to_numpy()
    fields, stops = lists.flatten(), np.cumsum(width, dtype=np.int64)
    firsts = stops - width
    at = np.arange(len(fields), dtype=np.int32) - np.repeat(firsts, width).astype(np.int32)
    zeros = pc.is_in(fields, value_set=pa.array(["0", "0.0", ""])).to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(~zeros & (at > 0))
    ends = np.append(0, np.searchsorted(kept, stops)).astype(np.int32)
    cells = pa.StructArray.from_arrays([pa.array(at[kept]), fields.take(pa.array(kept))], names=["at", "x"])
    spelt = pc.replace_substring(found.field("first"), '""', '"')
    firsts[led[good]] = len(fields) + np.arange(len(found))
    gene = pa.concat_arrays([fields, spelt]).take(pa.array(firsts))
    row = pa.array(np.cumsum(good) - 1, mask=~good)
    listed = pa.ListArray.from_arrays(pa.array(ends), cells)
    return [
        value.take(pa.array(np.arange(len(value)), mask=good)), gene.take(row),
        pa.array(width, pa.int32()).take(row), listed.take(row),
    ]


def _placed_lines(spark: SparkSession, path: str | list[str], counts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lines as (file, line_no, value, _start, _whole), and the files by number (file, path).

    _start is the line's own number where an even number of quotes stands before it in its
    file, _whole tells that the line is a record by itself. Quotes are counted per file split
    (one row each, broadcast); inside a split a task counts on as it reads, so lines stay in
    place. With `counts`, the lines that are data records come as `_sparse` gives them.
    """
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("bigint")
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = lines.groupBy("path", "_block").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_first"), F.sum(quotes).alias("_quotes")
    )
    order = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialised(
        splits.select(
            "path", "_block", "_first", F.dense_rank().over(Window.orderBy("path")).alias("file"),
            *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(c) for c in ("_size", "_quotes")],
        ),
        "splits",
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count = None, 0
        for batch in batches:
            for part in _pieces(batch):
                value, line_no = part.column("value"), part.column("line_no").to_numpy()
                first, before = part.column("_first").to_numpy(), part.column("_quotes").to_numpy()
                own = pc.count_substring(value, '"').to_numpy().astype(np.int64)
                total = np.cumsum(own)
                begins = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
                base = before[begins] - (total - own)[begins]
                if first[0] == key:
                    base[0] = count
                seen = np.repeat(base, np.diff(np.append(begins, len(first)))) + total - own
                key, count = first[-1], seen[-1] + own[-1]
                starts = seen % 2 == 0
                whole = starts & (own % 2 == 0)
                tried = counts & whole & (line_no > 0) & (pc.binary_length(value).to_numpy() > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("file"), part.column("line_no"), pa.array(line_no, mask=~starts), pa.array(whole), *_sparse(value, tried)],
                    names=["file", "line_no", "_start", "_whole", *(c.split(" ")[0] for c in SPARSE.split(", "))],
                )

    numbered = lines.join(F.broadcast(offsets), ["path", "_block"])
    placed = numbered.select("file", (F.col("_size") + F.col("_id") - F.col("_first")).alias("line_no"), "value", "_first", "_quotes")
    return placed.mapInArrow(place, f"file int, line_no bigint, _start bigint, _whole boolean, {SPARSE}"), offsets.select("file", "path").distinct()


def _record_texts(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """file, record, value of the records among placed lines that still are text: of one line, and of several."""
    rest = placed.where("NOT _whole").withColumn(BUCKET, F.floor(F.col("line_no") / LINES_AT_ONCE))
    begun = scan(rest, ["file"], ["line_no"], {"record": ("max", "_start")})
    long = begun.groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), "\n").alias("value")
    )
    whole = placed.where("_whole AND value <> ''").select("file", F.col("line_no").alias("record"), "value")
    return whole, long


def _fields(records: DataFrame) -> DataFrame:
    """file, record and fields of records that are text."""
    led = F.concat(F.lit(","), F.col("value"))
    found = F.regexp_extract_all(led, F.lit(FIELD), F.lit(0))
    whole = records.withColumn("_found", found).withColumn(
        "_sound", F.aggregate("_found", F.lit(0).cast("bigint"), lambda n, x: n + F.length(x)) == F.length("value") + 1
    )
    plain = lambda x: F.when(
        x.startswith(',"'), F.replace(F.substring(x, 3, 1 << 30).substr(F.lit(1), F.length(x) - 3), F.lit('""'), F.lit('"'))
    ).otherwise(F.substring(x, 2, 1 << 30))
    checked = F.when(F.col("_sound"), F.col("_found")).otherwise(
        F.raise_error(F.concat(F.lit("no quoted record: "), F.substring("value", 1, 100))).cast("array<string>")
    )
    return whole.select("file", "record", F.transform(checked, plain).alias("fields"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Quoted comma-separated records as file, record (number of its first line, from 0) and fields (array).

    Commas, doubled quotes and line breaks may stand inside quotes. A line begins a record
    when an even number of quotes stands before it in its file: quotes are counted per file
    split and then line by line, so no file passes one task. Records of one line,
    nearly all, stay where they are; only lines of longer ones are brought together.
    A text that is no list of fields raises.
    """
    lines, files = _placed_lines(spark, path)
    whole, long = _record_texts(materialised(lines, "lines"))
    found = _fields(whole.unionByName(long))
    return found.join(F.broadcast(files), "file").select(F.col("path").alias("file"), "record", "fields")  # one row per file


def read_wide_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Wide gene x cell tables (first column = gene) as long non-zero counts.

    Each file has its own header; its names may be one fewer than the fields of a row,
    which then begins with the gene. Names are joined to values by file and place after
    zeros are gone, so no list of all cells is copied or passes the driver. Values that are
    no numbers (as NA) are missing. A row of another width raises.
    """
    lines, _ = _placed_lines(spark, path, counts=True)
    placed = materialised(lines, "lines")
    whole, long = _record_texts(placed)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                found = _sparse(part.column("value"), part.column("record").to_numpy() > 0)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *found], names=["file", "record", *(c.split(" ")[0] for c in SPARSE.split(", "))])

    joined = materialised(long.mapInArrow(split, f"file int, record bigint, {SPARSE}"), "joined")
    texts = whole.unionByName(joined.where("value IS NOT NULL").select("file", "record", "value"))
    records = materialised(_fields(texts), "records")
    heads = records.where("record = 0")
    sizes = heads.select("file", F.size("fields").alias("_names"))
    names = heads.select(F.col("file").alias("_file"), F.posexplode("fields").alias("_place", "cell"))
    listed = F.filter(F.transform("fields", lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda f: f["at"] > 0)
    parsed = records.where("record > 0").select("file", F.get("fields", F.lit(0)).alias("gene"), F.size("fields").alias("width"), listed.alias("kept"))
    plain = [t.where("width IS NOT NULL").select("file", "gene", "width", "kept") for t in (placed, joined)]
    rows = plain[0].unionByName(plain[1]).unionByName(parsed).join(hashed(sizes), "file").withColumn("_over", F.col("width") - F.col("_names"))
    checked = F.when(F.col("_over").isin(0, 1), F.col("kept")).otherwise(
        F.raise_error(F.concat(F.lit("a row of another width than its header: "), F.col("gene"))).cast(parsed.schema["kept"].dataType)
    )
    long = rows.select("file", "gene", "_over", F.explode(checked).alias("v")).select(
        "file", "gene", (F.col("v.at") - F.col("_over")).alias("at"), F.trim("v.x").try_cast("double").alias("n")
    ).where("n <> 0")
    met = (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_place"))
    return long.join(hashed(names), met).select("gene", "cell", "n")


def read_manifest(
    spark: SparkSession,
    path: str,
    names: Sequence[str] = ("sample_id", "run_id", "file_name", "upload_type", "sample_guid"),
    head: int = 0,
    tail: int = 0,
) -> DataFrame:
    """Whitespace-separated rows by position, without the first `head` and last `tail` lines of the text."""
    if head or tail:
        lines = numbered_lines(spark, path, per_file=False)
        last = lines.agg(F.max("line_no").alias("_last")).scalar()
        lines = lines.where((F.col("line_no") >= head) & (F.col("line_no") <= last - tail))
    else:
        lines = read_lines(spark, path)
    fields = F.split(F.trim("value"), r"\s+")
    return lines.select(*[F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(names)])


def listed_files(spark: SparkSession, path: str, include: str = "*") -> DataFrame:
    """Names and sizes below a path that match a pattern; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", include).load(path)
    return found.select("path", "length")


def read_per_file(
    spark: SparkSession, path: str | list[str], schema: str, pattern: str, name: str = "sample", header: bool = True, sep: str = "\t"
) -> DataFrame:
    """Delimited files of one kind, with a column taken from each file's path.

    A path that does not exist fails the read. Used for quantification files
    and junction files per sample, maps per chromosome, event counts per type.
    """
    rows = (
        spark.read.schema(schema)
        .options(header=header, sep=sep, recursiveFileLookup=True)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("_path"))
    )
    return rows.withColumn(name, F.regexp_extract("_path", pattern, 1)).drop("_path")


def read_genetic_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, pos, rate, cm of map files, one per chromosome: a header, then place, rate and map place by blanks.

    The chromosome stands in the file name, between `chr` and the next underscore or dot.
    """
    lines = spark.read.text(path).select("value", F.regexp_extract("_metadata.file_name", "chr([^_.]+)", 1).alias("chrom"))
    parts = F.split(F.trim("value"), r"\s+")
    return lines.select(
        "chrom", F.get(parts, F.lit(0)).try_cast("bigint").alias("pos"), F.get(parts, F.lit(1)).try_cast("double").alias("rate"),
        F.get(parts, F.lit(2)).try_cast("double").alias("cm"),
    ).where("pos IS NOT NULL")
