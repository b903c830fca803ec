"""Best-fit packing of token sequences under several capacities.

A document is cut into pieces of at most `tokens` tokens. A bin has three
capacities: tokens, documents, and attention cost (the sum of squared lengths).
A piece is described by its length alone, so pieces of one length are alike, and
the whole packing follows from how many pieces each length has: a table of at
most `tokens` rows, whatever the corpus. Lengths are placed in falling order;
each goes to the group of equal bins that the rule prefers among those that can
take it under every capacity. What comes out is a short list of ranges: the
pieces of a length numbered from `lo` to `hi` go to bins counted from `first`.
Spark numbers the pieces of every length and looks their place up.
"""

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..shared import materialised
from .texts import map_batches, text_bytes

PLAN = "length bigint, lo bigint, hi bigint, per_bin bigint, first bigint, used bigint"


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a `tokenizers` file, from its vocabulary and added tokens.

    Token ids are those of `tokenizers` for the file; this engine returns them as
    numpy arrays, several times faster.
    """
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    return tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text; those texts that the fast engine refuses are encoded by `tokenizers`.

    Its pattern search raises ValueError on about a million blanks in a row.
    """
    try:
        return encoding(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, tokens: int) -> list[tuple[int, int]]:
    """[start, end) of the pieces of n tokens: whole ones, only the first may be shorter."""
    first = n % tokens or min(n, tokens)
    return [(0, first)] + [(s, s + tokens) for s in range(first, n, tokens)]


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokens: int = 2048,
    end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document.

    A document is the ids of its text followed by end_id; a null text is empty, so
    its one piece is end_id alone. Whole texts are read, in place.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.append(token_ids(text.decode(), path), end_id).astype("<u4")
            for k, (start, end) in enumerate(cut(len(ids), tokens)):
                part = ids[start:end]
                row = (doc, k, start, end - start, zlib.crc32(part.tobytes()), part)
                for column, value in zip(out, row):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_batches(rows, split, schema + ", ids array<bigint>" * with_ids)


def plan(
    counts: dict[int, int], tokens: int = 2048, documents: int = 256, cost: int = 2048 * 2048,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm",
) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges (length, lo, hi, per_bin, first, used) that place `counts` pieces of every length.

    Piece number r of a length, lo <= r < hi, goes to bin first + (r - lo) // per_bin
    and starts there at used + ((r - lo) % per_bin) * length. Groups of bins with
    equal content are handled at once. `rule` is "norm" (least weighted square of
    what is left in every capacity) or "dot" (largest weighted product of the
    piece and the room left); ties go to the older group. A piece that exceeds a
    capacity alone raises ValueError. At most two groups are added per length, so
    the plan is bounded by the token capacity, not by the number of pieces.
    """
    room_of = np.array([tokens, documents, cost], np.float64)
    weight = np.array(weights)
    left = np.zeros((0, 3))  # of every group
    first, size, used = (np.zeros(0, np.int64) for _ in range(3))
    bins, ranges = 0, []
    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length], np.float64)
        if (item > room_of).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity alone")
        alive = left[:, 0] >= 1
        left, first, size, used = left[alive], first[alive], size[alive], used[alive]
        lo, count = 0, counts[length]
        while lo < count:
            fits = np.flatnonzero((left >= item).all(axis=1))
            if not len(fits):
                per = int(min(room_of // item))
                full, odd = divmod(count - lo, per)
                for n, k in ((full, per), (1 if odd else 0, odd)):
                    if n:
                        ranges.append((length, lo, lo + n * k, k, bins, 0))
                        left = np.vstack([left, room_of - k * item])
                        first, size, used = (np.append(a, v) for a, v in ((first, bins), (size, n), (used, k * length)))
                        lo, bins = lo + n * k, bins + n
                break
            if rule == "norm":
                score = (((left[fits] - item) / room_of) ** 2 * weight).sum(axis=1)
            else:
                score = -((left[fits] / room_of) * (item / room_of) * weight).sum(axis=1)
            g = fits[np.argmin(score)]
            n = int(min(size[g], count - lo))
            ranges.append((length, lo, lo + n, 1, int(first[g]), int(used[g])))
            lo += n
            if n < size[g]:  # the rest of the group stays as it was
                left = np.vstack([left, left[g]])
                first, size, used = (
                    np.append(a, v) for a, v in ((first, first[g] + n), (size, size[g] - n), (used, used[g]))
                )
                size[g] = n
            left[g] -= item
            used[g] += length
    return ranges


def packed(rows: DataFrame, order: list[Column | str], **capacities) -> DataFrame:
    """rows (with a column `length`) and the sequence_id and offset where each is packed.

    Rows are numbered inside (partition, length) and the partitions' counts are
    added up, so no length gathers in one task. `order` settles the numbers inside
    a partition. An empty table gives an empty result; repeated rows are packed
    each for itself.
    """
    spark = rows.sparkSession
    table = materialised(rows.withColumn("_part", F.spark_partition_id()), "pieces")
    parts = table.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    ranges = spark.createDataFrame(plan(counts, **capacities), PLAN)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part", "length").orderBy(*order)
    numbered = table.join(starts, ["_part", "length"]).withColumn(
        "_rank", F.col("_start") + F.row_number().over(inside) - 1
    )
    places = F.broadcast(ranges.withColumnRenamed("length", "_length"))
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    at = F.col("_rank") - F.col("lo")
    return numbered.join(places, here).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("first") + F.floor(at / F.col("per_bin"))).cast("bigint").alias("sequence_id"),
        (F.col("used") + at % F.col("per_bin") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokens: int = 2048,
    end_id: int = 0, with_ids: bool = False, **capacities,
) -> DataFrame:
    """Pieces of all documents and their places; see `pieces`, `plan` and `packed`.

    Unless `documents` or `cost` is given, those capacities are as large as `tokens` pieces
    can make them, so that they never raise the number of sequences. Rows without id and
    repeated rows are packed each for itself; columns of other names are not looked at.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    rows = pieces(docs, path, id_col, text_col, tokens, end_id, with_ids)
    capacities = {"cost": tokens * tokens, "documents": tokens} | capacities
    return packed(rows, ["doc_id", "piece", "start", "ids_crc32"], tokens=tokens, **capacities)
