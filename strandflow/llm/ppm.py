"""Prediction by partial matching over bytes: a pretrained context trie scores every document.

The trie holds all byte contexts up to `order` of the training texts. A symbol
not seen after a context escapes to the next shorter one (escape estimate: number
of distinct symbols seen), where the symbols seen before are excluded. Because
every symbol seen after a long context was also seen after its shorter ones, the
symbols excluded at a node are those of the one longer node, so a probability
needs counts of single nodes only. The trie is a table of (context, symbol,
count) that Spark aggregates and joins.

Texts are scored in blocks. A block sends the distinct n-grams and words it
holds to the parts of the tables (packed, sorted arrays), gets their values back,
and scores its documents; no executor ever holds a whole table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import discarded, materialised
from .texts import WordHashes, text_bytes

#: Bytes that never occur in UTF-8: before every text, and the symbol that ends it.
START, END = 0xFF, 0xFE
SYMBOLS = 255
END_WORD = b"\n"

SLOTS = 61  # parts of the tables a block sends to
TOGETHER = 512  # blocks whose arrays meet in one part
STEP = 1 << 20  # positions held at a time

GRAM, WORD = 0, 1


def ngram_keys(text: bytes, order: int, at: int, to: int) -> np.ndarray:
    """Keys of the positions [at, to) of text and its end symbol: `order` bytes of context and the symbol."""
    lead = bytes([START]) * max(0, order - at) + text[max(0, at - order) : min(to, len(text))]
    if to > len(text):
        lead += bytes([END])
    data = np.frombuffer(lead, np.uint8).astype(np.int64)
    keys = np.zeros(to - at, np.int64)
    for k in range(order + 1):
        keys <<= 8
        keys |= data[k : k + to - at]
    return keys


def _steps(text: bytes):
    n = len(text) + 1
    return ((at, min(n, at + STEP)) for at in range(0, n, STEP))


def _summed(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted runs (keys, counts), sorted, and the sums of their counts."""
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(part) for part in zip(*runs))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class _Counter:
    """Counts of keys; those of texts that are not learnt from count 0."""

    def __init__(self):
        self.runs, self.waiting, self.held = [], {True: [], False: []}, 0

    def add(self, keys: np.ndarray, learn: bool) -> None:
        self.waiting[learn].append(keys)
        self.held += len(keys)
        if self.held > 4 * STEP:
            self.flush()

    def flush(self) -> None:
        for learn, keys in self.waiting.items():
            if keys:
                distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
                self.runs.append((distinct, counts.astype(np.int64) * int(learn)))
        self.waiting, self.held = {True: [], False: []}, 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        self.flush()
        return _summed(self.runs)


def _part_of(kind: int, keys: np.ndarray) -> np.ndarray:
    """Part of the tables a key belongs to; n-grams of one context stay together."""
    return (keys >> 8 if kind == GRAM else keys) % SLOTS


def _slot(kind: str, key: str) -> Column:
    own = F.when(F.col(kind) == GRAM, F.shiftright(F.col(key), 8)).otherwise(F.col(key))
    return F.pmod(own, F.lit(SLOTS).cast("bigint")).cast("int")


def _bytes_of(numbers: np.ndarray) -> bytes:
    """Numbers with their bytes of equal weight side by side, which compresses well."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers_of(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _bytes_of(np.diff(keys, prepend=np.int64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers_of(data, np.int64), dtype=np.int64)


LISTS = "block bigint, slot int, super bigint, kind int, keys binary, counts binary"


def _lists_of(table: pa.Table, order: int) -> pa.Table:
    """What a block holds: distinct keys by kind and slot, with their counts in training texts."""
    words = WordHashes()
    found = {GRAM: _Counter(), WORD: _Counter()}
    for text, held in zip(table["text"], table["held"].to_pylist()):
        text = text.as_py().lower()
        for at, to in _steps(text):
            found[GRAM].add(ngram_keys(text, order, at, to), not held)
        tokens = text.split()
        tokens.append(END_WORD)
        found[WORD].add(
            np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens)).view(np.int64), not held
        )
    block = table["block"][0].as_py()
    rows = []
    for kind, counter in found.items():
        keys, counts = counter.merged()
        slot = _part_of(kind, keys)
        for s in range(SLOTS):
            here = slot == s
            if here.any():
                rows.append((block, s, block // TOGETHER, kind, _packed_keys(keys[here]), _bytes_of(counts[here])))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows))
    names = ["block", "slot", "super", "kind", "keys", "counts"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _counts_of(table: pa.Table) -> pa.Table:
    """Distinct keys of one part of the tables with their counts."""
    keys, counts = _summed([
        (_unpacked_keys(k), _numbers_of(c, np.int64))
        for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist())
    ])
    kind = np.full(len(keys), table["kind"][0].as_py(), np.int32)
    return pa.table({"kind": pa.array(kind), "key": pa.array(keys), "n": pa.array(counts)})


def _values_of(lists: pa.Table, values: pa.Table) -> pa.Table:
    """The blocks' lists of one part with the values of their keys (0 where there is none)."""
    keys, value = values["key"].to_numpy(), values["value"].to_numpy()
    order = np.argsort(keys)
    keys, value = keys[order], value[order]
    out = []
    for packed in lists["keys"].to_pylist():
        asked = _unpacked_keys(packed)
        got = np.zeros(len(asked))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            got = np.where(keys[at] == asked, value[at], 0.0)
        out.append(_bytes_of(got))
    return pa.table({
        "block": lists["block"].cast(pa.int64()), "kind": lists["kind"].cast(pa.int32()), "keys": lists["keys"],
        "vals": pa.array(out, pa.binary()),
    })


class _Table:
    """Values by key for keys that are all present: buckets of about a quarter of a key each."""

    def __init__(self, rows: list[tuple[bytes, bytes]]):
        keys = np.concatenate([_unpacked_keys(k) for k, _ in rows] or [np.zeros(0, np.int64)])
        values = np.concatenate([_numbers_of(v, np.float64) for _, v in rows] or [np.zeros(0)])
        self.shift = np.uint64(64 - max(8, (4 * len(keys)).bit_length()))
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        self.keys, self.values = keys[order], values[order]
        counts = np.bincount(bucket, minlength=1 << (64 - int(self.shift)))
        self.starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.starts[self._bucket(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        while len(missed):
            at[missed] += 1
            missed = missed[self.keys[at[missed]] != keys[missed]]
        return self.values[at]


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def _scores_of(docs: pa.Table, lists: pa.Table, order: int, total: int, distinct: int) -> pa.Table:
    """Scores of a block's documents from the values of its own keys."""
    rows = {GRAM: [], WORD: []}
    for kind, keys, vals in zip(*(lists[c].to_pylist() for c in ("kind", "keys", "vals"))):
        rows[kind].append((keys, vals))
    logs, counts = _Table(rows[GRAM]), _Table(rows[WORD])
    words = WordHashes()
    known, base, score, sizes = [], [], [], []
    for text in docs["text"]:
        text = text.as_py().lower()
        tokens = text.split()
        tokens.append(END_WORD)
        codes = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens)).view(np.int64)
        c = counts(codes)
        sizes.append(len(tokens))
        known.append(int((c > 0).sum()))
        base.append(float(np.log10((c + 1) / (total + distinct + 1)).sum()))
        score.append(sum(float(logs(ngram_keys(text, order, at, to)).sum()) for at, to in _steps(text)))
    return pa.table({
        "doc_id": docs["doc_id"].cast(pa.int64()), "held_out": docs["held"], "n_tokens": pa.array(sizes, pa.int64()),
        "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([total] * len(sizes), pa.int64()),
        "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
    })


def _suffix(key: Column, k: int) -> Column:
    """An n-gram without the bytes before its last k + 1."""
    return key.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1).cast("bigint"))


def _context(key: Column) -> Column:
    return F.shiftright(key, 8)


def trie(counts: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tables by order 0 to `order`: n-grams (key, c) and their contexts (ctx, n, d, e).

    n: symbols counted after the context, d: distinct ones, e: what the symbols
    seen after it count in the next shorter context, where they are excluded.
    """
    grams = [
        materialised(
            counts.groupBy(_suffix(F.col("key"), k).alias("key")).agg(F.sum("n").alias("c")), f"grams{k}"
        )
        for k in range(order + 1)
    ]
    contexts = []
    for k, table in enumerate(grams):
        if k:
            shorter = grams[k - 1].select(F.col("key").alias("_s"), F.col("c").alias("_c"))
            table = table.join(shorter, _suffix(F.col("key"), k - 1) == F.col("_s"))
        else:
            table = table.withColumn("_c", F.lit(0).cast("bigint"))
        contexts.append(
            table.groupBy(_context(F.col("key")).alias("ctx")).agg(
                F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"), F.sum("_c").alias("e")
            )
        )
    return grams, contexts


def log_probabilities(grams: list[DataFrame], contexts: list[DataFrame], asked: DataFrame) -> DataFrame:
    """key and value, the log10 probability of its symbol after its context, for every asked n-gram.

    From the longest context down: a seen symbol settles the value; otherwise the
    escape is added and the symbols of the node are excluded in the next one. A
    context never seen, or whose symbols are all excluded, is passed over. Below
    the empty context the symbols left share evenly.
    """
    zero = F.lit(0).cast("bigint")
    state = asked.select(
        "key", F.lit(0.0).alias("value"), F.lit(False).alias("done"), zero.alias("_n"), zero.alias("_d")
    )
    for k in range(len(grams) - 1, -1, -1):
        seen = grams[k].select(F.col("key").alias("_g"), "c")
        here = contexts[k].select(F.col("ctx").alias("_x"), "n", "d", "e")
        part = _suffix(F.col("key"), k)
        joined = state.join(seen, part == F.col("_g"), "left").join(here, _context(part) == F.col("_x"), "left")
        n, d = F.col("n") - F.col("_n"), F.col("d") - F.col("_d")
        live = ~F.col("done") & F.col("n").isNotNull() & (d > 0)
        step = F.when(live, F.log10(F.coalesce("c", d) / (n + d))).otherwise(0.0)
        state = joined.select(
            "key", (F.col("value") + step).alias("value"),
            (F.col("done") | (live & F.col("c").isNotNull())).alias("done"),
            F.coalesce("e", zero).alias("_n"), F.coalesce("d", zero).alias("_d"),
        )
    rest = F.lit(SYMBOLS) - F.col("_d")
    return state.select("key", F.when(F.col("done"), F.col("value")).otherwise(F.col("value") - F.log10(rest)).alias("value"))


def score_documents(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 4,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Texts are lower-cased (A-Z). The models learn from documents that are not held
    out. score: log10 probability of the text's bytes and its end under the trie;
    base_score: that of its words and one end token under add-one word counts. Words are
    told apart by 64-bit hashes. A null text is empty: it has the end only. Rows
    without id count as any other; repeated rows are learnt and scored each; other
    columns are not looked at; an empty table gives an empty result. Without
    training texts every symbol is equally likely.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held"), text_bytes(text_col).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // block_bytes))
    place = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.xxhash64("text")), F.lit(blocks).cast("bigint"))
    rows = rows.withColumn("block", place)
    lists = materialised(
        rows.groupBy("block").applyInArrow(lambda t: _lists_of(t, order), LISTS), "lists"
    )
    parts = lists.groupBy("kind", "slot", "super").applyInArrow(_counts_of, "kind int, key bigint, n bigint")
    counts = materialised(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    seen = counts.where(f"kind = {GRAM} AND n > 0")
    grams, contexts = trie(seen, order)
    whole = grams[order].join(contexts[order], _context(F.col("key")) == F.col("ctx"))
    certain = whole.select("key", F.log10(F.col("c") / (F.col("n") + F.col("d"))).alias("value"))
    unseen = log_probabilities(grams, contexts, counts.where(f"kind = {GRAM} AND n = 0").select("key"))
    total, distinct = counts.where(f"kind = {WORD} AND n > 0").agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    known = counts.where(f"kind = {WORD} AND n > 0").select("key", F.col("n").cast("double").alias("value"))
    values = certain.unionByName(unseen).withColumn("kind", F.lit(GRAM)).unionByName(
        known.withColumn("kind", F.lit(WORD))
    ).withColumn("slot", _slot("kind", "key"))
    supers = F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // TOGETHER)).cast("array<bigint>"))
    sent = values.withColumn("super", supers)
    keys = ["kind", "slot", "super"]
    back = materialised(
        lists.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
            _values_of, "block bigint, kind int, keys binary, vals binary"
        ),
        "values",
    )
    discarded(lists, counts, *grams)
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        lambda d, v: _scores_of(d, v, order, total, distinct), SCORES
    )
