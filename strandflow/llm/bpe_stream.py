"""Byte-pair encoding and decoding as streaming transducers with constant memory.

Encoding: a merge reaches only a bounded number of units to its right before it
is settled whether it takes place; the bound follows from the merge list. Units
are buffered up to that lookahead and one token more, merged, and all tokens
that end far enough from the buffer's end are emitted: nothing that may follow
can change them. Decoding: a state machine turns token ids into bytes and bytes
into text, holding at most the bytes of one unfinished character.
"""

import json
import unicodedata
from bisect import bisect_left
from codecs import getincrementaldecoder
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import map_batches, text_bytes

#: White space as the tokenizer's patterns see it (fixed value).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Words remembered in a generation; characters of a text looked at together; the longest word remembered.
REMEMBERED, WINDOW, LONG = 200_000, 1 << 16, 64


def word_pattern(without: str = "") -> regex.Pattern:
    """Words of the tokenizer; characters in `without` are no letters or digits."""
    letter, digit = (rf"[{kind}--[{without}]]" if without else kind for kind in (r"\p{L}", r"\p{N}"))
    rest = rf"(?:[^{SPACE}\p{{L}}\p{{N}}]" + (f"|[{without}])+" if without else ")+")
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|{rest}")


@lru_cache(maxsize=1)
def _newer() -> tuple[frozenset, regex.Pattern]:
    """A pattern of letters and digits that only the newest Unicode tables know, and words without them."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    known = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
    return frozenset(known), word_pattern(known)


WORD = word_pattern()


def words_of(text: str) -> list[str]:
    if not text.isascii():
        newer, older = _newer()
        if not newer.isdisjoint(text):
            return older.findall(text)
    return WORD.findall(text)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """A byte-pair vocabulary with word ends, its lookahead, and the encoder and decoder on it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        characters = byte_characters()
        self.inside = [vocab[c] for c in characters]
        self.last = [vocab[c + self.end] for c in characters]
        self.byte = {c: b for b, c in enumerate(characters)}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rules[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.lookahead, self.longest = lookahead(self.rules, {*self.inside, *self.last})
        self.special = (
            regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)))
            if self.added else None
        )
        self.words: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.raw = Decoder(self, raw=True)

    def merged(self, units: list[int]) -> list[int]:
        """All merges on a list of units: lowest rank first, from left to right."""
        rule = self.rules.get
        units = list(units)
        pairs = [rule(p) for p in zip(units, units[1:])]
        while (best := min(filter(None, pairs), default=None)) is not None:
            at = pairs.index(best)
            while at >= 0:
                units[at : at + 2] = (best[1],)
                del pairs[at]
                if at:
                    pairs[at - 1] = rule((units[at - 1], best[1]))
                if at < len(pairs):
                    pairs[at] = rule((best[1], units[at + 1]))
                at = pairs.index(best, at) if best in pairs[at:] else -1
        return units

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Token ids of one word, given as bytes, emitted as soon as they are stable.

        The buffer never holds more than the lookahead, the longest token and one
        step of units.
        """
        keep = self.lookahead
        full = keep + self.longest + 64
        units: list[int] = []
        before = None
        for byte in data:
            if before is not None:
                units.append(self.inside[before])
            before = byte
            if len(units) >= full:
                at, done = 0, 0
                for token in self.merged(units):
                    at += self.length(token)
                    if at > len(units) - keep:
                        break
                    done = at
                    yield token
                units = units[done:]
        if before is not None:
            units.append(self.last[before])
            yield from self.merged(units)

    def length(self, token: int) -> int:
        """Units of a token: the characters that stand for its bytes."""
        return len(self.tokens[token].removesuffix(self.end))

    def normal(self, text: str) -> str:
        """Composed and lower-cased, each character by itself."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is an added token, text) in order; only added tokens are never normalised."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield False, text[at : m.start()]
            yield True, m[0]
            at = m.end()
        yield False, text[at:]

    def encode(self, text: str) -> Iterator[int]:
        """Token ids of a text."""
        for added, part in self.pieces(text):
            if added:
                yield self.added[part]
            else:
                for word in words_of(self.normal(part)):
                    yield from self.stream(word.encode())

    def known(self, word: str) -> tuple[str, str]:
        """Ids and token texts of a short word, each joined by spaces, remembered in two generations.

        When the younger one is full it becomes the older one, whose words come back when
        they are met: words in use are never all forgotten at once.
        """
        found = self.older.get(word)
        if found is None:
            ids = [self.added[word]] if word in self.added else list(self.stream(word.encode()))
            found = " ".join(map(str, ids)), " ".join(map(self.raw.push, ids))
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}
        self.words[word] = found
        return found

    def both(self, text: str) -> Iterator[tuple[list[str], list[str]]]:
        """Parts of a text's ids, and of what they decode to as the vocabulary spells it, in order.

        The text passes in windows that end at a space, which no word spans; words longer
        than `LONG` leave the encoder token by token.
        """
        memo, known = self.words.get, self.known
        start = 0
        while start < len(text):
            stop = text.find(" ", start + WINDOW)
            window = text[start:] if stop < 0 else text[start:stop]
            start = len(text) if stop < 0 else stop
            words = []
            for added, part in self.pieces(window) if self.special and "<|" in window else ((False, window),):
                words += [part] if added else words_of(self.normal(part))
            if max(map(len, words), default=0) <= LONG:
                found = [memo(w) or known(w) for w in words]
                memo = self.words.get
                yield [f[0] for f in found], [f[1] for f in found]
                continue
            for word in words:
                if len(word) <= LONG:
                    one, two = known(word)
                    yield [one], [two]
                    continue
                ids = self.stream(word.encode())
                while part := list(islice(ids, WINDOW)):
                    yield list(map(str, part)), list(map(self.raw.push, part))
            memo = self.words.get

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of them joined by spaces, and sha256 of the decoded text in UTF-8."""
        count, digests, gap = 0, (sha256(), sha256()), ""
        for parts in self.both(text):
            if not parts[0]:
                continue
            for digest, part in zip(digests, parts):
                joined = " ".join(part)
                digest.update((gap + joined).encode())
                if part is parts[0]:
                    count += joined.count(" ") + 1
            gap = " "
        return count, digests[0].hexdigest(), digests[1].hexdigest()


class Decoder:
    """Token ids to text, one id at a time.

    raw: the tokens as the vocabulary spells them, which is what the file's own
    decoder (none) gives, joined by single spaces by the caller. Otherwise the
    bytes they stand for, word ends as spaces; the state is the start of a
    character whose other bytes have not come yet.
    """

    def __init__(self, bpe: Bpe, raw: bool = False):
        self.bpe, self.raw = bpe, raw
        self.state = getincrementaldecoder("utf-8")(errors="replace")

    def push(self, token: int) -> str:
        spelt = self.bpe.tokens[token]
        if self.raw:
            return spelt
        if spelt in self.bpe.added:
            return self.state.decode(b"", final=True) + spelt
        ended = bool(self.bpe.end) and spelt.endswith(self.bpe.end)
        body = spelt.removesuffix(self.bpe.end) if ended else spelt
        return self.state.decode(bytes(self.bpe.byte[c] for c in body), final=ended) + " " * ended

    def close(self) -> str:
        return self.state.decode(b"", final=True)

    def all(self, ids: Iterable[int]) -> Iterator[str]:
        for token in ids:
            yield self.push(token)
        if not self.raw:
            yield self.close()


def lookahead(rules: dict[tuple[int, int], tuple[int, int]], base: set[int]) -> tuple[int, int]:
    """Units to the right that settle whether a merge takes place, and the longest token's units.

    Rule k = (u, v) takes place between u and v unless v is not formed. The first
    thing that can keep v from forming reaches over v's right end: an earlier rule
    (a, b) whose left part a is v itself or stands on the right edge of v's own
    merges, before a is merged there. So k needs v and what the farthest reaching
    such rule needs from v's end on. Rules are taken in order, so those values are
    known. It is required that every token is made by one rule, after its parts.
    """
    length = dict.fromkeys(base, 1)
    made: dict[int, tuple[int, int]] = {}  # token: rank of its rule, its right part
    by_left: dict[int, tuple[list[int], list[int]]] = {}  # token: ranks and farthest reach so far
    most = 0
    for (left, right), (rank, token) in sorted(rules.items(), key=lambda r: r[1][0]):
        if token in length or left not in length or right not in length:
            raise ValueError("the merge list makes a token twice or before its parts")
        reach, edge, taken = 0, right, rank
        while True:
            ranks, far = by_left.get(edge, ((), ()))
            k = bisect_left(ranks, taken)
            if k:
                reach = max(reach, far[k - 1])
            if edge not in made:
                break
            taken, edge = made[edge]
        reach += length[right]
        length[token] = length[left] + length[right]
        made[token] = (rank, right)
        ranks, far = by_left.setdefault(left, ([], []))
        ranks.append(rank)
        far.append(max(reach, far[-1]) if far else reach)
        most = max(most, reach)
    return most, max(length.values())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def round_trip(docs: DataFrame, path: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded.

    Digests of the decimal ids joined by single spaces and of the decoded text in
    UTF-8. A null text is empty and has no tokens. Rows stay in place and pass one
    by one, window by window, into running digests; words met before are looked up. Repeated rows, rows without id and other
    columns of any name change nothing; an empty table gives an empty result.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = vocabulary(path)
        rows = [bpe.digests(text.decode()) for text in batch.column(1).to_pylist()]
        count, first, second = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(count, pa.int64()), pa.array(first), pa.array(second)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    return map_batches(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
