"""Secret scans with structural confirmation.

Three plain patterns give the base spans. Longer base64 and hex candidates are then decoded, and reported only if their structure
proves them: key encodings whose nested lengths fit to the byte, packed key blobs, and signed tokens whose header names an algorithm.
An encoded key may be wrapped: its lines are joined over line breaks, also escaped ones (``\\n``, ``\\r\\n``), with indentation. The length
that its first bytes state says at which line it ends, and its span goes from its first line to its last.

Not looked at: keys that follow a slash or another character of their alphabet directly, and lines that a program joins by quotes and plus
signs.

The scan is one narrow pass over Arrow batches: no shuffle, and memory for one batch of texts.

Edge cases: a null text is empty and has no span; equal texts have equal spans; a text of any length is scanned whole; an empty table
gives an empty result. Spans are in code points, end exclusive. Input columns other than the id aren't returned, so clashing names
can't arise.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flankspark.llm.common import batched

#: Order of kinds among spans with one start.
KINDS = ("assign", "access", "hex", "token", "key")
# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
#: Where a key may start (DER sequences and packed keys, in base64 of either alphabet, and in hex), and dotted runs that may be signed tokens.
ENCODED = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nr])|(?<=-----))(?:M[A-P]|b3Bl)")
HEXED = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70)")
#: A run of three pieces may begin at any piece of a longer one, so they are looked ahead at; an object starts with a brace or white space.
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])(?=[eCDI])(?=([A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*))")
#: Lines of an encoding (the dashes before and after a key are none), and what stands between two.
LINE, HEX_LINE = re.compile(r"(?:[A-Za-z0-9+/_]|-(?!----))+"), re.compile(r"[0-9A-Fa-f]+")
BREAK = re.compile(r"[ \t]*(?:\r\n?|\n|\\+r(?:\\+n)?|\\+n)[ \t]*")
PADDING = re.compile(r"={0,2}")
#: Bytes of the shortest encoding that is looked at, by the size of its alphabet.
LEAST_64, LEAST_16 = 30, 32
SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, confirmed array<struct<kind:string,start:long,end:long,what:string>>"


def decode(run: str) -> bytes | None:
    """Bytes of a base64 run in the common or the URL alphabet, padded or not."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_size(data: bytes, at: int) -> tuple[int, int] | None:
    """(start, end) of the content of the DER element at a place, if its length is well formed and fits."""
    if at + 2 > len(data):
        return None
    first = data[at + 1]
    if first < 0x80:
        start, size = at + 2, first
    else:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + 2 + n > len(data):
            return None
        size = int.from_bytes(data[at + 2 : at + 2 + n], "big")
        if size < 0x80 or n > 1 and data[at + 2] == 0:
            return None
        start = at + 2 + n
    return (start, start + size) if start + size <= len(data) else None


def outer_size(data: bytes) -> int | None:
    """Bytes of the DER element that data starts with, header and all."""
    n = data[1] & 0x7F if len(data) > 1 and data[1] >= 0x80 else 0
    if len(data) < 2 + n or n > 4 or data[1] == 0x80:
        return None
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def der_key(data: bytes) -> str | None:
    """What key a DER sequence holds: every length inside it must fill its parent exactly."""
    if not data or data[0] != 0x30 or (outer := der_size(data, 0)) is None or outer[1] != len(data):
        return None
    tags, at = [], outer[0]
    while at < outer[1]:
        if (inner := der_size(data, at)) is None or inner[1] > outer[1]:
            return None
        if data[at] == 0x30 and not _fills(data, *inner):
            return None
        tags.append((data[at], inner[1] - inner[0]))
        at = inner[1]
    kinds = [t for t, _ in tags]
    if len(kinds) >= 9 and set(kinds[:9]) == {0x02}:
        return "rsa private key"
    if kinds[:2] == [0x02, 0x04] and tags[1][1] in (20, 28, 32, 48, 66):
        return "ec private key"
    if kinds[:3] == [0x02, 0x30, 0x04]:
        return "pkcs8 private key"
    return None


def _fills(data: bytes, at: int, end: int) -> bool:
    while at < end:
        if (inner := der_size(data, at)) is None or inner[1] > end:
            return False
        at = inner[1]
    return at == end


def packed_size(data: bytes) -> tuple[int, bool]:
    """(bytes that are needed, whether those are all): of a whole packed key, three fields, the public keys by number, and the private part."""
    at = len(b"openssh-key-v1\0")
    for _ in range(3):
        if at + 4 > len(data):
            return at + 4, False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data):
        return at + 4, False
    left, at = int.from_bytes(data[at : at + 4], "big") + 1, at + 4
    while left:
        if at + 4 > len(data):
            return at + 4, False
        at, left = at + 4 + int.from_bytes(data[at : at + 4], "big"), left - 1
    return at, True


def packed_key(data: bytes) -> str | None:
    """What private key a length-prefixed blob holds."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return None
    at, fields = len(magic), 0
    while fields < 3:
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    return "packed private key" if at + 4 <= len(data) else None


def signed_token(run: str) -> str | None:
    """The algorithm of a signed token: its header and claims must be JSON objects and the header must name one."""
    head, claims, _ = run.split(".", 2)
    parts = []
    for piece in (head, claims):
        raw = decode(piece)
        try:
            parts.append(json.loads(raw.decode("utf-8")) if raw else None)
        except (ValueError, RecursionError):
            return None
    if all(isinstance(x, dict) for x in parts) and isinstance(parts[0].get("alg"), str):
        return parts[0]["alg"]
    return None


class Block:
    """Lines of an encoding that follow each other from a place on: where each starts and ends, and how many characters end with it."""

    def __init__(self, text: str, at: int, line: re.Pattern):
        self.text, self.starts, self.ends, self.sizes = text, [], [], [0]
        while m := line.match(text, at):
            self.starts.append(m.start())
            self.ends.append(m.end())
            self.sizes.append(self.sizes[-1] + m.end() - m.start())
            # Padding ends an encoding, so no line follows it.
            if not (gap := BREAK.match(text, m.end())):
                break
            at = gap.end()

    def chars(self, first: int, n: int) -> str:
        """At most n characters of the lines from one on."""
        out = []
        for k in range(first, len(self.starts)):
            if n <= 0:
                break
            a, b = self.starts[k], self.ends[k]
            out.append(self.text[a : min(b, a + n)])
            n -= b - a
        return "".join(out)

    def last(self, first: int, n: int) -> int | None:
        """The line with which the n characters from one on end exactly."""
        k = bisect_left(self.sizes, self.sizes[first] + n)
        return k - 1 if first < k < len(self.sizes) and self.sizes[k] == self.sizes[first] + n else None


def from_hex(run: str) -> bytes | None:
    return bytes.fromhex(run[: len(run) // 2 * 2])


def from_64(run: str) -> bytes | None:
    return decode(run[:-1] if len(run) % 4 == 1 else run)


def key_spans(text: str, start: re.Pattern, line: re.Pattern, read: Callable[[str], bytes | None], chars: Callable[[int], int], least: int) -> list[tuple[str, int, int, str]]:
    """Keys of one encoding; read decodes characters, chars says how many encode so many bytes, without padding."""
    found: list = []
    block, done = None, 0
    for m in start.finditer(text):
        if m.start() < done:
            continue
        # A line of the last block starts here, or else a new block.
        first = bisect_left(block.starts, m.start()) if block else 0
        if not block or first == len(block.starts) or block.starts[first] != m.start():
            block, first = Block(text, m.start(), line), 0
        if not block.starts or not (head := read(block.chars(first, 40))):
            continue
        if head.startswith(b"openssh-key-v1\0"):
            # Lengths say how much to read on, so lines that aren't the key's are left alone.
            there, raw = block.sizes[-1] - block.sizes[first], head
            size, whole = packed_size(raw)
            while not whole and chars(size) <= there:
                raw = read(block.chars(first, chars(size))) or b""
                if len(raw) < size:
                    break
                size, whole = packed_size(raw)
            what = packed_key(raw)
            last = block.last(first, chars(size)) if whole and chars(size) <= there else None
            if what and last is None:
                # Broken off: its lines are those as long as the first.
                last = first
                while last + 1 < len(block.starts) and block.ends[last + 1] - block.starts[last + 1] == block.ends[first] - block.starts[first]:
                    last += 1
        else:
            # The header alone states the size; the rest needn't be there yet.
            size = outer_size(head) if head[0] == 0x30 else None
            last = block.last(first, chars(size)) if size and size >= least else None
            what = der_key(read(block.chars(first, chars(size))) or b"") if last is not None else None
        if what and last is not None:
            done = PADDING.match(text, block.ends[last]).end() if line is LINE else block.ends[last]
            found.append(("key", m.start(), done, what))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of each base kind that don't overlap; a match that is too short is used up, then dropped."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of hex digits is always matched whole, so asking for 24 of them at once finds the same runs.
    found += [("hex", m.start(), m.end()) for m in HEX_LONG.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Candidates whose decoded structure proves them."""
    found = key_spans(text, ENCODED, LINE, from_64, lambda n: -(-4 * n // 3), LEAST_64)
    found += key_spans(text, HEXED, HEX_LINE, from_hex, lambda n: 2 * n, LEAST_16)
    if "." in text:
        done = 0
        for m in DOTTED.finditer(text):
            if m.start() >= done and (alg := signed_token(m[1])):
                done = m.end(1)
                found.append(("token", m.start(), done, alg))
    return found


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted({x[:3] for x in spans}, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def scan(text: str | None) -> dict:
    base = base_spans(text := text or "")
    more = confirmed_spans(text)
    count = {k: sum(x[0] == k for x in base) for k in KINDS[:3]}
    return {
        "n_assign": count["assign"], "n_access": count["access"], "n_hex": count["hex"],
        "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(base + more),
        "confirmed": [dict(zip(("kind", "start", "end", "what"), x, strict=True)) for x in more],
    }


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: its id, the counts of base spans, their digest, all spans, and what confirmed the added ones."""
    batched(docs.sparkSession)
    slim = docs.select(F.col(id_col), F.col(text).cast("string").alias("__text"))
    kind = slim.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("what", pa.string())]))
        for batch in batches:
            rows = [scan(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in ("n_assign", "n_access", "n_hex")]
            columns += [pa.array([r[k] for r in rows], pa.string()) for k in ("base_sha256", "spans")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array([r["confirmed"] for r in rows], spans)],
                names=[id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "confirmed"],
            )

    return slim.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
