"""Alignment of two tokenizers over whole texts, by lockstep vectorised merging.

Both tokenizers cut the same bytes. A block of documents is merged at once: one
NumPy state holds, for every lane, where it stands in the tokens of A and of B.
Each step advances in every lane the side that ends first, or both where their
ends meet; those lanes emit a cut and the links of the group that it closes, and
lanes that came to their end are compacted away. Long documents are dealt to
several lanes at ends that both sides share, so that no document steps alone.

Id pairs are counted over the corpus with one row per (block, pair), which is far
fewer than one per document; the counts come back to the blocks the same way.
"""

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..shared import materialised
from .bpe_stream import byte_characters
from .packing import encoding
from .texts import bound_batches, byte_slices, list_array, text_bytes

#: Tokens of A in a lane, about; text bytes merged at once; links of a group beyond which
#: equal ids of a group are merged before they are paired.
LANE, BLOCK_BYTES, WIDE = 256, 2 << 20, 4096

DOCS = "array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,pairs:bigint>>"
BLOCKS = f"block bigint, docs {DOCS}, a array<int>, b array<int>, held array<int>, steps array<int>, times array<bigint>"


class ByteTokenizer:
    """A byte-level vocabulary of `tokenizers`; special tokens in texts are plain text."""

    def __init__(self, path: str):
        self.path, self.slow = path, None
        byte = {c: b for b, c in enumerate(byte_characters())}
        vocab = Tokenizer.from_file(path).get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for spelt, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in spelt) if all(c in byte for c in spelt) else spelt.encode()

    def encode(self, text: str) -> list[int]:
        """Ids by the fast engine of the same vocabulary, by `tokenizers` where that refuses the text."""
        try:
            return encoding(self.path).encode_ordinary(text)
        except ValueError:
            if self.slow is None:
                self.slow = Tokenizer.from_file(self.path)
                self.slow.encode_special_tokens = True
            return self.slow.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """A sentencepiece vocabulary; it puts a space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> tuple[ByteTokenizer, PieceTokenizer, np.ndarray, np.ndarray, list[str]]:
    """A, B, the bytes of every id of A and of B, and the spellings of ids with what follows them."""
    a, b = ByteTokenizer(path_a), PieceTokenizer(path_b)
    sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
    most = max(map(len, sizes))
    return a, b, *sizes, [f"{i}{end}" for end in ",|;" for i in range(most)]


def lanes_of(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Rows (start in A, end in A, start in B) of lanes, each within one document.

    docs_a, docs_b: number of tokens up to the end of each document. A long document
    is cut after about `lane` tokens, at the first end of the next (at most sixteen) tokens that
    B shares; where there is none, the lane goes on.
    """
    starts = np.concatenate([[0], docs_a[:-1]])
    counts = np.maximum((docs_a - starts - 1) // lane, 0)
    doc = np.repeat(np.arange(len(docs_a)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    tried = (starts[doc] + nth * lane)[:, None] + np.arange(min(16, lane))
    inside = tried < docs_a[doc][:, None]
    ends = ends_a[np.minimum(tried, len(ends_a) - 1) - 1]
    at = np.searchsorted(ends_b, ends)
    shared = inside & (ends_b[np.minimum(at, len(ends_b) - 1)] == ends)
    some, first = shared.any(axis=1), shared.argmax(axis=1)
    cut_a = np.concatenate([starts, tried[np.arange(len(doc)), first][some]])
    cut_b = np.concatenate([np.concatenate([[0], docs_b[:-1]]), at[np.arange(len(doc)), first][some] + 1])
    order = np.argsort(cut_a, kind="stable")
    cut_a, cut_b = cut_a[order], cut_b[order]
    return np.stack([cut_a, np.append(cut_a[1:], docs_a[-1]), cut_b])


def group_links(a: np.ndarray, b: np.ndarray, ga: np.ndarray, ia: np.ndarray, gb: np.ndarray, ib: np.ndarray):
    """(group, id of A, id of B, times) of all pairs in the groups a[ga:ia], b[gb:ib]."""
    p, q = ia - ga, ib - gb
    many = p * q
    if many.max() == 1:
        return np.arange(len(ga)), a[ga], b[gb], np.ones(len(ga), np.int64)
    wide = np.flatnonzero(many > WIDE)
    many[wide] = 0
    group = np.repeat(np.arange(len(ga)), many)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
    out = [(group, a[ga[group] + nth // q[group]], b[gb[group] + nth % q[group]], np.ones(len(group), np.int64))]
    for g in wide:
        one, times_one = np.unique(a[ga[g] : ia[g]], return_counts=True)
        two, times_two = np.unique(b[gb[g] : ib[g]], return_counts=True)
        out.append((
            np.full(len(one) * len(two), g), np.repeat(one, len(two)), np.tile(two, len(one)),
            np.outer(times_one, times_two).ravel(),
        ))
    return tuple(np.concatenate(column) for column in zip(*out))


def lockstep(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, lanes: np.ndarray) -> Iterator[tuple]:
    """Each step's cuts and links of all lanes: (ia, ib) behind every closed group, and its links.

    Links come as (place in A where the group ends, id of A, id of B, times).
    """
    begin_a, stop, begin_b = lanes
    state = np.stack([begin_a, begin_b, begin_a, begin_b, stop])  # places in A, B; group starts; end of the lane
    while state.shape[1]:
        x, y = ends_a[state[0]], ends_b[state[1]]
        state[0] += x <= y
        state[1] += y <= x
        met = np.flatnonzero(x == y)
        if not len(met):
            continue
        ia, ib, ga, gb, _ = closed = state[:, met]
        group, one, two, times = group_links(a, b, ga, ia, gb, ib)
        yield ia, ib, (ia[group], one, two, times)
        state[2:4, met] = closed[:2]
        if (ia == closed[4]).any():
            state = np.ascontiguousarray(state[:, state[0] < state[4]])


def cuts_and_links(
    a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Cuts (places in A and in B, in order), and of every link the place in A where its group ends, its id pair and times."""
    cuts, links = [], []
    for ia, ib, (place, one, two, times) in lockstep(a, b, ends_a, ends_b, lanes_of(ends_a, ends_b, docs_a, docs_b)):
        cuts.append((ia.astype(np.int32), ib.astype(np.int32)))
        links.append((place.astype(np.int32), one.astype(np.int64) << 32 | two, times))
    cut_a, cut_b = (np.concatenate(c) for c in zip(*cuts))
    del cuts
    order = np.argsort(cut_a)
    return cut_a[order], cut_b[order], *(np.concatenate(c) for c in zip(*links))


def reading_order(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, most: int) -> np.ndarray:
    """Spellings in reading order: the ids of a group's A, those of its B, then the next group."""
    stop_a, stop_b = np.zeros(len(a), np.int32), np.zeros(len(b), np.int32)
    stop_a[cut_a - 1] = stop_b[cut_b - 1] = 1
    group_a = np.cumsum(stop_a, dtype=np.int32) - stop_a
    group_b = np.cumsum(stop_b, dtype=np.int32) - stop_b
    coded = np.empty(len(a) + len(b), np.int32)
    coded[np.arange(len(a)) + np.append(0, cut_b)[group_a]] = a + most * stop_a
    coded[np.arange(len(b)) + cut_a[group_b]] = b + 2 * most * stop_b
    return coded


def aligned(texts: list[str | None], path_a: str, path_b: str) -> dict:
    """Figures, links and group digest of some texts: what one row of the blocks holds, as arrays.

    n_a, n_b, n_groups, n_links, digest, pairs (end of the text's part in steps) for
    every text; a, b, held for every distinct id pair, with the number of texts that
    link it; steps, times: per text its distinct pairs and how often each is linked. Pairs
    are indices that ascend within a text; `steps` are the differences of one and the next,
    small numbers that shrink well on their way, and the running sum gives them back.
    """
    one, two, size_a, size_b, spelt = tokenizers_of(path_a, path_b)
    found, both = [], []
    for k, text in enumerate(texts):
        if not text:
            continue
        whole = " " + text
        x, y, raw = one.encode(whole), two.encode(text), whole.encode()
        if b"".join([one.bytes[i] for i in x]) == raw == b"".join([two.bytes[i] for i in y]):
            found.append(k)
            both.append((np.array(x, np.int32), np.array(y, np.int32)))
    count = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links", "pairs")}
    digest = [""] * len(texts)
    empty = np.zeros(0, np.int64)
    if not found:
        return count | {"digest": digest} | dict.fromkeys(("a", "b", "held", "steps", "times"), empty)
    a, b = (np.concatenate([t[s] for t in both]) for s in (0, 1))
    docs_a, docs_b = (np.cumsum([len(t[s]) for t in both]) for s in (0, 1))
    del both
    cut_a, cut_b, place, key, times = cuts_and_links(a, b, np.cumsum(size_a[a]), np.cumsum(size_b[b]), docs_a, docs_b)
    at, coded = 0, reading_order(a, b, cut_a, cut_b, len(spelt) // 3)
    for k, stop in zip(found, docs_a + docs_b):
        joined = "".join([spelt[c] for c in coded[at:stop].tolist()])
        digest[k], at = sha256(joined[:-1].encode()).hexdigest(), stop
    del coded
    doc = np.searchsorted(docs_a, place)
    del place
    pairs, pair = np.unique(key, return_inverse=True)
    del key
    held, inverse = np.unique(doc * len(pairs) + pair, return_inverse=True)
    del doc, pair
    totals = np.zeros(len(held), np.int64)
    np.add.at(totals, inverse, times)
    del inverse, times
    owner, pair = np.divmod(held, len(pairs))
    where = np.array(found)
    count["n_a"][where] = np.diff(docs_a, prepend=0)
    count["n_b"][where] = np.diff(docs_b, prepend=0)
    count["n_groups"][where] = np.bincount(np.searchsorted(docs_a, cut_a), minlength=len(found))
    np.add.at(count["n_links"], where[owner], totals)
    count["pairs"] = np.cumsum(np.bincount(where[owner], minlength=len(texts)))
    return count | {
        "digest": digest, "a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "held": np.bincount(pair, minlength=len(pairs)),
        "steps": np.diff(pair, prepend=0), "times": totals,
    }


def blocks_of(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """One row per block of documents: figures of every document, its links as indices into the block's id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in byte_slices(batch, BLOCK_BYTES):
                out = aligned([t.decode() for t in part.column(1).to_pylist()], path_a, path_b)
                rows = pa.StructArray.from_arrays(
                    [
                        part.column(0), *[pa.array(out[n], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array(out["digest"], pa.string()), pa.array(out["pairs"], pa.int64()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
                )
                whole = pa.array([0, len(rows)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.ListArray.from_arrays(whole, rows),
                        *[list_array([out[n]], pa.int32()) for n in ("a", "b", "held", "steps")],
                        list_array([out["times"]], pa.int64()),
                    ],
                    names=["block", "docs", "a", "b", "held", "steps", "times"],
                )
                number += 1
            pa.default_memory_pool().release_unused()

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, n, best: documents that link an id pair, and whether no other b has more with this a."""
    pairs = blocks.select(F.explode(F.arrays_zip("a", "b", "held")).alias("p")).select("p.*")
    counts = materialised(pairs.groupBy("a", "b").agg(F.sum("held").alias("n")), "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Figures of every document, and the counts a, b, n, best of every id pair in the corpus.

    id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A reads a
    space and the text, B the text alone. A text that is null or empty, or that one of
    the two does not give back byte by byte, has no tokens: zeros and an empty digest.
    Each row is a document, so repeated rows and ids count each; rows without id give
    a row without id. Other columns are not looked at; an empty table gives empty
    results. Links are pairs of occurrences; within a group of over 4096 links equal
    ids are merged before they are paired, so a group without inner cuts needs memory
    for its distinct ids only. Memory holds a block (two megabytes of text or one document).
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    blocks = materialised(blocks_of(docs, id_col, text_col, path_a, path_b), "blocks")
    counted = materialised(pair_counts(blocks), "counted")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p")).select("block", "pos", "p.*")
    answers = asked.join(counted, ["a", "b"]).select(F.col("block").alias("of"), "pos", "n", "best")
    figures = f"{id_col} bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pos").to_numpy())
        n, best = (right.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        out = []
        for row in left.to_batches():
            for k in range(row.num_rows):
                docs = row.column("docs")[k].values
                steps, times = (row.column(c)[k].values.to_numpy() for c in ("steps", "times"))
                pair = np.cumsum(steps)
                stop = docs.field("pairs").to_numpy()
                sums = [np.append(0, np.cumsum(v)) for v in (times * best[pair], times * n[pair])]
                best_links, total = (s[stop] - s[np.append(0, stop[:-1])] for s in sums)
                first = [docs.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                out.append(pa.Table.from_arrays(
                    [*first, pa.array(best_links), pa.array(total), docs.field("groups_sha256")],
                    names=[f.split(" ")[0] for f in figures.split(", ")],
                ))
        return pa.concat_tables(out)

    slim = blocks.select("block", "docs", "steps", "times")
    done = slim.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(scored, figures)
    return done, counted
