"""Secrets in texts: patterns, and candidates confirmed by what they decode to.

Patterns find assignments, access key ids and long hex runs. Beside them, base64
and hex candidates are decoded and reported only if their bytes are a key: one
DER element whose nested lengths fit exactly and whose children are those of a
key encoding, an SSH blob whose length-prefixed parts fill it, or a signed token
whose header and claims are JSON.
"""

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .texts import map_batches, packed

#: Kinds in the order in which spans with one start are listed; the first three come from patterns.
KINDS = ["assign", "access", "hex", "jwt", "pem", "der", "ssh"]
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

# Single line breaks, real or escaped, with the indentation after them, do not end a candidate.
BREAK = r"(?:(?:\r?\n|(?:\\r)?\\n)[ \t]*)"
LETTER, DIGIT = "[A-Za-z0-9+/_-]", "[0-9A-Fa-f]"
# A DER sequence begins with byte 0x30: `M` and `A` to `P` in base64, `30` in hex. Any place may be a start.
DER_TEXT = re.compile(rf"(?=M[A-P](?:{BREAK}?{LETTER}){{30}})")
DER_HEX = re.compile(rf"(?=30(?:{BREAK}?{DIGIT}){{46}})")
# An SSH file begins with its name; a blob with a length below 256 and `ssh`, `sk` or `ec`.
SSH_TEXT = re.compile(r"(?=b3BlbnNzaC1rZXktdjEA|AAAA[A-Z](?:[HXn3]N[zr]|[GWm2]Vj))")
SSH_HEX = re.compile(r"(?=6f70656e7373682d|000000[0-9a-f]{2}(?:7373|736b|6563))", re.I)
TEXT_RUN = re.compile(rf"{LETTER}+(?:{BREAK}{LETTER}+)*")
HEX_RUN = re.compile(rf"{DIGIT}+(?:{BREAK}{DIGIT}+)*")
PIECE = {TEXT_RUN: re.compile(rf"{LETTER}+"), HEX_RUN: re.compile(rf"{DIGIT}+")}
LINE_BREAK = re.compile(BREAK)
PADDING = re.compile("={0,2}")
# Parts joined by dots; each run of token letters is met once. `{` is `e` and one of sixteen letters in base64.
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")
OBJECT = re.compile(r"e[w-z0-9_-]")
MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,40})-----")
PEM_BREAK = re.compile(r"\\[nr]|[\r\n]")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s]*")
PEM_HEADER = re.compile(r"[A-Za-z-]+:(?: .*)?", re.S)
# Digest algorithms: with octets they are a digest, not an encrypted key.
DIGESTS = (b"\x60\x86\x48\x01\x65\x03\x04\x02", b"\x2b\x0e\x03\x02\x1a", b"\x2a\x86\x48\x86\xf7\x0d\x02")

SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER elements that fill data[start:end] exactly, else None."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, size = data[start], data[start + 1]
        start += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or end - start < width:
                return None
            size = int.from_bytes(data[start : start + width], "big")
            start += width
        if end - start < size:
            return None
        items.append((tag, start, start + size))
        start += size
    return items


def is_key(data: bytes) -> bool:
    """Whether data is one DER element laid out as a private or public key.

    Accepted: RSA (nine integers), DSA (six), EC (integer, octets, tagged
    parameters), wrapped private keys (integer, algorithm, octets), encrypted ones
    (algorithm that is no digest, octets), wrapped public keys (algorithm, bits)
    and RSA public keys (a long integer and a short one, both odd).
    """
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = der_items(data, top[0][1], top[0][2])
    if not inner:
        return False
    tags = [tag for tag, _, _ in inner]

    def algorithm(item: tuple[int, int, int]) -> bool:
        parts = der_items(data, item[1], item[2]) if item[0] == 0x30 else None
        return bool(parts) and parts[0][0] == 0x06

    if tags[:9] == [0x02] * 9 or tags == [0x02] * 6:
        return True
    if tags == [0x02, 0x02]:  # a signature has two long numbers; an exponent is short and odd
        (_, n, m), (_, e, f) = inner
        return m - n >= 64 and data[m - 1] % 2 == 1 and 0 < f - e <= 8 and data[f - 1] % 2 == 1
    if tags[:2] == [0x02, 0x04]:
        return len(tags) == 2 or all(tag in (0xA0, 0xA1) for tag in tags[2:])
    if tags[:1] == [0x02] and tags[2:3] == [0x04]:
        return algorithm(inner[1])
    if tags == [0x30, 0x04] and algorithm(inner[0]):
        _, start, end = der_items(data, inner[0][1], inner[0][2])[0]
        return not data[start:end].startswith(DIGESTS)
    return tags == [0x30, 0x03] and algorithm(inner[0])


def is_ssh(data: bytes) -> bool:
    """Whether data is an SSH key file's bytes or a public key blob, by its nested lengths."""
    magic = b"openssh-key-v1\0"

    def strings(at: int, most: int) -> tuple[list[bytes], int] | None:
        found = []
        while at < len(data) and len(found) < most:
            size = int.from_bytes(data[at : at + 4], "big")
            if at + 4 + size > len(data):
                return None
            found.append(data[at + 4 : at + 4 + size])
            at += 4 + size
        return found, at

    if data.startswith(magic):
        head = strings(len(magic), 3)
        if head is None or len(head[0]) < 3 or len(data) < head[1] + 4:
            return False
        keys = int.from_bytes(data[head[1] : head[1] + 4], "big")
        rest = strings(head[1] + 4, keys + 1) if 0 < keys < 100 else None
        return rest is not None and len(rest[0]) == keys + 1 and rest[1] == len(data)
    parts = strings(0, 12)
    return (
        parts is not None and parts[1] == len(data) and len(parts[0]) >= 2
        and re.fullmatch(rb"(?:sk-)?(?:ssh|ecdsa)-[a-z0-9@.-]{2,60}", parts[0][0]) is not None
    )


def from_base64(text: str) -> bytes | None:
    """Bytes of a base64 text, either alphabet, padding optional; None where it is none."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _object(part: str) -> dict | None:
    """The JSON object that a token's part encodes, else None."""
    if not OBJECT.match(part):
        return None
    try:
        parsed = json.loads(from_base64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return parsed if isinstance(parsed, dict) else None


def token_parts(parts: list[str], at: int) -> int:
    """How many parts from `at` on are a signed (three) or encrypted (five) token; 0 for none.

    The header is an object that names its algorithm. A signed token has claims, an
    object, and a signature, empty only for algorithm `none`. An encrypted one names its
    encryption; key, vector, text and tag follow, of which the key may be empty.
    """
    head = _object(parts[at])
    if head is None or not isinstance(head.get("alg"), str):
        return 0
    rest = parts[at + 1 : at + 5]
    if isinstance(head.get("enc"), str) and len(rest) == 4 and all(rest[1:]) and None not in map(from_base64, rest):
        return 5
    if len(rest) < 2 or _object(rest[0]) is None or from_base64(rest[1]) is None:
        return 0
    return 3 if rest[1] or head["alg"].lower() == "none" else 0


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of tokens among parts joined by dots; every part is decoded twice at most."""
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        at, k = m.start(), 0
        while k < len(parts):
            size = token_parts(parts, k) if OBJECT.match(parts[k]) else 0
            width = sum(map(len, parts[k : k + max(size, 1)])) + max(size, 1)
            if size:
                yield at, at + width - 1
            at, k = at + width, k + max(size, 1)


class Run:
    """Letters of a base64 or hex run without its line breaks, and where they stand in the text."""

    def __init__(self, text: str, at: int, pattern: re.Pattern):
        self.end = pattern.match(text, at).end()
        self.hex = pattern is HEX_RUN
        self.starts, self.places, pieces, size = [], [], [], 0
        while at < self.end:
            m = PIECE[pattern].match(text, at)
            self.starts.append(at)
            self.places.append(size)
            pieces.append(m[0])
            size += len(m[0])
            gap = LINE_BREAK.match(text, m.end())
            at = gap.end() if gap and gap.end() < self.end else self.end
        self.code = "".join(pieces)
        self.edges = {*self.places, size}

    def place(self, at: int) -> int:
        """Number of the letter at a position of the text."""
        k = bisect_right(self.starts, at) - 1
        return self.places[k] + at - self.starts[k]

    def after(self, place: int) -> int:
        """Position in the text behind the letter before `place`."""
        k = bisect_left(self.places, place) - 1
        return self.starts[k] + place - self.places[k]

    def letters(self, size: int) -> int:
        return 2 * size if self.hex else (4 * size + 2) // 3

    def read(self, place: int, start: int, end: int) -> bytes:
        """Bytes [start, end) of what the letters from `place` on decode to; fewer at the end."""
        if self.hex:
            part = self.code[place + 2 * start : place + 2 * end]
            return bytes.fromhex(part[: len(part) // 2 * 2])
        first = start // 3
        part = self.code[place + 4 * first : place + self.letters(end)]
        if len(part) % 4 == 1:
            part = part[:-1]
        return (from_base64(part) or b"")[start - 3 * first : end - 3 * first]


def _der_sizes(read: Callable[[int, int], bytes]) -> Iterator[int]:
    """Size that the first bytes of a DER sequence give it."""
    head = read(0, 6)
    if len(head) < 2 or head[0] != 0x30:
        return
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if width <= 4 and (width or head[1] < 0x80) and len(head) >= 2 + width:
        yield 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])


def _ssh_sizes(read: Callable[[int, int], bytes]) -> Iterator[int]:
    """Sizes at which the length-prefixed parts of an SSH file or blob may end, largest first."""
    at, most, sizes = 0, 12, []
    if read(0, 15) == b"openssh-key-v1\0":
        at = 15
        for _ in range(3):
            at += 4 + int.from_bytes(read(at, at + 4), "big")
        most = int.from_bytes(read(at, at + 4), "big") + 1
        at += 4
        if not 1 < most <= 100:
            return
    for _ in range(most):
        size = read(at, at + 4)
        if len(size) < 4:
            break
        at += 4 + int.from_bytes(size, "big")
        sizes.append(at)
    yield from reversed(sizes)


def _keys(text: str, starts: re.Pattern, pattern: re.Pattern, sizes: Callable, fits: Callable) -> Iterator[tuple[int, int]]:
    """Spans of keys, by the size that their own first bytes give and the letters that follow.

    A key may start anywhere in a run but ends where a line or the run ends. After
    a candidate that is no key the search goes on at the next start; one that is a
    whole DER element of another kind is passed over.
    """
    run, past = None, 0
    for m in starts.finditer(text):
        at = m.start()
        if at < past:
            continue
        if run is None or at >= run.end:
            run = Run(text, at, pattern)
        place = run.place(at)
        for size in sizes(lambda a, b: run.read(place, a, b)):
            last = place + run.letters(size)
            if size < 24 or last > len(run.code) or last not in run.edges and run.code[last : last + 2] != "--":
                continue
            data = run.read(place, 0, size)
            end = run.after(last)
            if fits(data):
                if not run.hex:
                    end += len(PADDING.match(text, end)[0])
                past = end
                yield at, end
                break
            top = der_items(data, 0, len(data)) if fits is is_key else None
            if top and der_items(data, top[0][1], top[0][2]):
                past = end


def _pem(text: str) -> Iterator[tuple[int, int]]:
    """Spans from BEGIN to the next END of the same label whose lines are headers or body and hold a key."""
    begun: dict[str, re.Match] = {}
    for m in MARKER.finditer(text):
        if m[1] == "BEGIN":
            begun[m[2]] = m
            continue
        begin = begun.pop(m[2], None)
        if begin is None:
            continue
        body, heads = [], [m[2]]
        for line in PEM_BREAK.split(text[begin.end() : m.start()]):
            line = line.strip()
            if PEM_BODY.fullmatch(line):
                body += line.split()
            elif PEM_HEADER.fullmatch(line):
                heads.append(line)
            else:
                break
        else:
            data = from_base64("".join(body))
            # An encrypted body may have no readable structure; its headers or label say so.
            encrypted = "KEY" in m[2] and any("ENCRYPTED" in h for h in heads)
            if data and (is_key(data) or is_ssh(data) or encrypted):
                yield begin.start(), m.end()


def _confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _tokens(text):
        yield "jwt", start, end
    blocks = sorted(_pem(text)) if "-----BEGIN " in text else []
    for start, end in blocks:
        yield "pem", start, end
    for kind, starts, pattern, sizes, fits in (
        ("der", DER_TEXT, TEXT_RUN, _der_sizes, is_key), ("ssh", SSH_TEXT, TEXT_RUN, _ssh_sizes, is_ssh),
        ("der", DER_HEX, HEX_RUN, _der_sizes, is_key), ("ssh", SSH_HEX, HEX_RUN, _ssh_sizes, is_ssh),
    ):
        for start, end in _keys(text, starts, pattern, sizes, fits):
            block = bisect_right(blocks, (start, len(text))) - 1
            if block < 0 or blocks[block][1] < end:
                yield kind, start, end


def found_in(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) in code points, by start, then kind."""
    spans = [
        ("assign", m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12
    ]
    spans += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    spans += [(kind, start, end, start) for kind, start, end in _confirmed(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[tuple[str, int, int, int]], mask: str) -> str:
    """The text with every secret replaced once by the mask, overlapping ones as one."""
    out, at = [], 0
    for _, _, end, start in sorted(spans, key=lambda s: (s[3], -s[2])):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def secret_spans(docs: DataFrame, text_col: str = "text", mask: str | None = None) -> DataFrame:
    """row (all columns of docs) and `spans` (kind, start, end); with a mask also `clean`, the redacted text.

    Positions are code points, the end exclusive. Whole texts are scanned, one
    row at a time, in place: nothing is shuffled. A null text counts as empty and
    gives no spans (and stays null in `clean`). Repeated rows, rows without id
    and other columns of any name pass through `row`; an empty table gives an
    empty result.
    """
    rows, _ = packed(docs, text_col)
    place = docs.columns.index(text_col)
    schema = T.StructType().add("row", docs.schema).add("spans", T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long")))
    if mask is not None:
        schema = schema.add("clean", "string")

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).field(place).to_pylist()
        found = [found_in(t) if t else [] for t in values]
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e, _ in row] for row in found]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        columns = [batch.column(0), pa.array(spans, pa.list_(kind))]
        if mask is not None:
            columns.append(
                pa.array([redacted(t, s, mask) if s else t for t, s in zip(values, found)], pa.string())
            )
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(rows.select("row"), scan, schema)


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(BASE))
