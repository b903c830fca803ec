"""Small helpers shared by the text operators of this subpackage."""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: the space and the control characters tab to carriage return.
BLANKS = " \t\n\x0b\f\r"


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound and then forgotten."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their order evenly."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def text_bytes(text: str) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


#: Bytes that a function over Arrow batches is given at once, unless one row has more.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bytes_of(size: str) -> int:
    """Bytes of a size setting, as 67108864b or 64m; without a bound more than any batch."""
    number, unit = re.match(r"(-?\d+)\s*([kmgtp]?)", size.strip().lower()).groups()
    found = int(number) << 10 * " kmgtp".index(unit or " ")
    return found if found > 0 else 1 << 62


def byte_slices(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of at most `limit` bytes or one row; nothing for no rows."""
    if batch.num_rows > 1 and batch.nbytes > limit:
        half = batch.num_rows // 2
        yield from byte_slices(batch.slice(0, half), limit)
        yield from byte_slices(batch.slice(half), limit)
    elif batch.num_rows:
        yield batch


def bound_batches(spark: SparkSession) -> None:
    """Executors send batches of BATCH_BYTES at most: Spark's own bound, 64 MB, stands in the executor and the worker at once."""
    if _bytes_of(spark.conf.get(BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


def map_batches(
    df: DataFrame, fn: Callable[..., pa.RecordBatch], schema: str, memo: Callable[[], object] | None = None
) -> DataFrame:
    """fn over the Arrow batches of every partition, cut by bytes; empty batches are left out.

    With a memo, one is made per partition and given to fn as second argument. Executors
    send batches of that size too.
    """
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = () if memo is None else (memo(),)
        for batch in batches:
            for part in byte_slices(batch):
                yield fn(part, *kept)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def list_array(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one numpy array per row."""
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def packed(df: DataFrame, text_col: str) -> tuple[DataFrame, Column]:
    """df with all columns in one struct `row`, whatever their names, and the text column in it."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(row.alias("row")), F.col(f"row.`{text_col}`").alias("text")


#: So many ids at most are sent to all executors (16 MB of numbers).
PICKED_AT_MOST = 2_000_000


def picked(rows: DataFrame, id_col: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose id stands in `ids` (column id); with left_anti those whose does not.

    The ids are counted first: up to a bound they are broadcast and the rows stay
    in place, beyond it both sides are shuffled.
    """
    few = ids.limit(PICKED_AT_MOST + 1).count() <= PICKED_AT_MOST
    right = ids.select(F.col("id").alias("_picked"))
    return rows.join(F.broadcast(right) if few else right, F.col(id_col) == F.col("_picked"), how)
