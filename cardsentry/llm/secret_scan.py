"""Secret scans with a recursive decoding worklist.

A text is scanned with the three base patterns. Its encoded parts are then unwrapped: words with URL escapes, words
with Unicode escapes, and base64 runs, read from each of their first four characters, as characters in front of one
shift it. What a run decodes or unfolds to is read as UTF-8, or else byte by byte (all patterns and escapes are ASCII), and
its stretches of ASCII in UTF-16 apart; control characters do not matter. A layer without a stretch of LEAST_TEXT ASCII
characters cannot hold a find or an encoded part and is left out. Every unwrapped layer is scanned and searched for encoded parts in turn, until nothing new appears; a layer already met at the same place ends its branch
(cycle detection). Words with escapes are unwrapped both alone and together with the words around them, as a key, its
sign and its value may stand in three words. Base64 lines of equal length (but for the first and last) are unwrapped both
alone and as one run; gzip and zlib data is unfolded member after member. Each character of a layer knows the stretch of the original text that it came from, so that finds
are reported as spans of the original text. Finds of deeper layers are added; those of the text itself stay.

Defined cases: null text is empty and has no spans; texts are scanned whole; equal spans of a kind count once;
repeated rows are scanned one by one; an empty table gives no rows; only the id and text columns are read.
Compressed parts are unfolded in pieces of MAX_DECODED bytes, so that memory does not depend on what they unfold to.
A part of more than one piece is marked `exhausted`: every piece is scanned and searched like a layer, with the end of
the piece before, but what crosses more than that overlap may be lost, so redaction replaces the whole encoded part.
All other parts of the document are scanned as ever.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import html
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
_KEYS = ("passw", "secret", "token", "api")

MAX_DECODED = 1 << 26  # bytes of a compressed part that are one layer
OVERLAP = 4096  # characters of a piece that are scanned again with the next

_URL = re.compile(r"%[0-9A-Fa-f]{2}")
_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|(&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}={0,2}")
_BASE64_URL = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*[_-])[A-Za-z0-9_-]{16,}={0,2}")
_BREAK = re.compile(r"[ \t]*(?:\r\n?|\n)[ \t]*")
#: Lines of wrapped base64, and a last line too short to be one.
_LINES = tuple((re.compile(rf"(?<![{x}])[{x}]{{16,}}={{0,2}}"), re.compile(rf"[ \t]*(?:\r\n?|\n)[ \t]*([{x}]{{1,15}}={{0,2}})(?![={x}])")) for x in ("A-Za-z0-9+/", "A-Za-z0-9+/_-"))
_WORD = re.compile(r"\S+")
_AROUND = 2  # words on each side: a match of three words holds an unwrapped one
LEAST_TEXT = 8  # any match, escape with its value, or base64 run is longer
_SPOKEN = re.compile(r"[\x09\x0a\x0d\x20-\x7e]{%d}" % LEAST_TEXT)
_WIDE = tuple((re.compile(p % LEAST_TEXT, re.S), at) for p, at in ((rb"(?:[\x09\x0a\x0d\x20-\x7e]\x00){%d,}", 0), (rb"(?:\x00[\x09\x0a\x0d\x20-\x7e]){%d,}", 1)))
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns, leftmost and non-overlapping within a kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A text whose character i came from [starts[i], ends[i]) of the original, or from `whole`; neither: the original."""

    def __init__(self, text: str, starts: array | None = None, ends: array | None = None, whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.whole = text, starts, ends, whole

    def place(self, a: int, b: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        return (a, b) if self.starts is None else (min(self.starts[a:b]), max(self.ends[a:b]))


Part = tuple[str, int, int | None]  # text from [a, b) of a layer, or from there on character by character (None)


def _spread(parts: Iterable[Part], layer: Layer) -> Layer:
    """A layer of decoded parts of `layer`."""
    if layer.whole:
        return Layer("".join(piece for piece, _, _ in parts), whole=layer.whole)
    text, starts, ends = [], array("q"), array("q")
    for piece, a, b in parts:
        text.append(piece)
        if b is not None:
            lo, hi = layer.place(a, b)
            starts.extend([lo] * len(piece))
            ends.extend([hi] * len(piece))
        elif layer.starts is None:
            starts.extend(range(a, a + len(piece)))
            ends.extend(range(a + 1, a + len(piece) + 1))
        else:
            starts.extend(layer.starts[a : a + len(piece)])
            ends.extend(layer.ends[a : a + len(piece)])
    return Layer("".join(text), starts, ends)


def _from_url(layer: Layer, a: int, b: int) -> Layer:
    def parts() -> Iterator[Part]:
        at = a
        for m in _URL_RUN.finditer(layer.text, a, b):
            yield layer.text[at : m.start()], at, None
            raw = bytes.fromhex(m[0].replace("%", ""))
            read = 0
            for c in raw.decode("utf-8", "replace"):
                n = len(c.encode()) if c != "\ufffd" else 1
                yield c, m.start() + 3 * read, min(m.start() + 3 * (read + n), m.end())
                read = min(read + n, len(raw) - 1)
            at = m.end()
        yield layer.text[at:b], at, None

    return _spread(parts(), layer)


def _from_escapes(layer: Layer, a: int, b: int) -> Layer:
    def parts() -> Iterator[Part]:
        at = a
        for m in _ESCAPE.finditer(layer.text, a, b):
            yield layer.text[at : m.start()], at, None
            code = m[1] or m[2] or m[3] or m[4]
            value = int(code, 16) if code else None
            yield (html.unescape(m[5]) if m[5] else chr(value) if value < 0x110000 and not 0xD800 <= value < 0xE000 else "\ufffd"), m.start(), m.end()
            at = m.end()
        yield layer.text[at:b], at, None

    return _spread(parts(), layer)


def _regions(text: str, escape: re.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of the words with an escape, and of stretches of them with the words around."""
    before: deque[int] = deque(maxlen=_AROUND)
    start, end, left = -1, 0, 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        if escape.search(text, a, b):
            yield a, b
            start = start if start >= 0 else before[0] if before else a
            end, left = b, _AROUND
        elif left:
            end, left = b, left - 1
        elif start >= 0:
            yield start, end
            start = -1
        before.append(a)
    if start >= 0:
        yield start, end


def _texts_of(raw: bytes) -> Iterator[tuple[str, int, int]]:
    """(text, first byte, bytes a character; 0: as UTF-8 has it) of what `raw` may say."""
    try:
        text, width = raw.decode(), 0
    except UnicodeDecodeError:
        text, width = raw.decode("latin-1"), 1
    if _SPOKEN.search(text):
        yield text, 0, width
    for wide, at in _WIDE:
        for m in wide.finditer(raw):
            yield m[0][at::2].decode("ascii"), m.start(), 2


def _unfolded(raw: bytes, most: int, used: list[int], start: int = 0) -> Iterator[bytes]:
    """What gzip or zlib data from `start` on, member after member, unfolds to, in pieces of at most `most` bytes;
    nothing if it is neither. Where it ends, and its last whole member does, is added to `used` before the last piece.
    """
    data, at, held, good = memoryview(raw), start, bytearray(), start
    while len(raw) - at > 2 and (raw[at : at + 2] == b"\x1f\x8b" or raw[at] & 15 == 8 and (raw[at] << 8 | raw[at + 1]) % 31 == 0):
        unfold, out = zlib.decompressobj(47), b""
        while not unfold.eof and (at < len(raw) or out):
            fed = data[at : at + (1 << 16)]
            try:
                out = unfold.decompress(fed, most)
            except zlib.error:
                at = len(raw)
                break
            at += len(fed) - len(unfold.unconsumed_tail) - len(unfold.unused_data)
            held += out
            while len(held) > most:
                yield bytes(held[:most])
                del held[:most]
        if unfold.eof:
            good = at
    used += [at, good]
    if held:
        yield bytes(held)


def _text_pieces(pieces: Iterator[bytes]) -> Iterator[tuple[str, bool]]:
    """Texts of the pieces, each after the end of the one before, and whether it is but a piece of the whole."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    before, later, piece = "", False, next(pieces, None)
    while piece is not None:
        after = next(pieces, None)
        part = later or after is not None
        if decoder:
            try:
                text = decoder.decode(piece, after is None)
            except UnicodeDecodeError:  # from here on byte by byte
                decoder = None
        if not decoder:
            text = piece.decode("latin-1")
        told = _SPOKEN.search(text) is not None
        if told or part:
            yield (before + text if told else ""), part
        for wide, at in _WIDE:
            for m in wide.finditer(piece):
                yield m[0][at::2].decode("ascii"), part
        before = (before + text)[-OVERLAP:]
        piece, later = after, True


def _wrapped(text: str, line: re.Pattern, tail: re.Pattern) -> Iterator[list[tuple[int, int]]]:
    """Spans of the lines of base64 runs that go over several lines of equal length; the first may differ, the last be shorter."""

    def closed(lines: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        short = tail.match(text, lines[-1][1]) if lines and text[lines[-1][1] - 1] != "=" else None
        for run in [lines, [*lines, short.span(1)]] if short else [lines]:
            if len(run) > 1:
                yield run
            if len(run) > 2 and run[0][1] - run[0][0] != run[1][1] - run[1][0]:
                yield run[1:]

    lines: list[tuple[int, int]] = []
    for m in line.finditer(text):
        a, b = m.span()
        joins = bool(lines) and text[lines[-1][1] - 1] != "=" and _BREAK.fullmatch(text, lines[-1][1], a)
        if joins and len(lines) == 1:
            lines.append((a, b))
            if b - a < lines[0][1] - lines[0][0]:
                yield lines[:]
        elif joins and lines[-1][1] - lines[-1][0] == lines[1][1] - lines[1][0] >= b - a:
            lines.append((a, b))
        else:
            yield from closed(lines)
            lines = [(a, b)]
    yield from closed(lines)


def _from_base64(layer: Layer, lines: Sequence[tuple[int, int]], most: int) -> Iterator[tuple[Layer, bool]]:
    """Layers of a base64 run of one or more lines, read from each of its first four characters, and whether each is
    but a piece of what the run unfolds to."""
    whole = "".join([layer.text[a:b] for a, b in lines]).rstrip("=").replace("-", "+").replace("_", "/")
    first = [0, *accumulate(b - a for a, b in lines)]

    def spot(i: int) -> int:
        j = bisect_right(first, i, hi=len(lines)) - 1
        return lines[j][0] + i - first[j]

    for skipped in range(4):
        run = whole[skipped:]
        if len(run) % 4 == 1:
            run = run[:-1]
        try:
            raw = base64.b64decode(run + "=" * (-len(run) % 4))
        except binascii.Error:
            continue

        def place(a: int, b: int) -> tuple[int, int]:
            """Where the bytes [a, b) stand in the layer."""
            return spot(skipped + a * 4 // 3), spot(min(first[-1], skipped - (-b * 4 // 3)) - 1) + 1

        # compressed data from the first byte on, and wherever else its usual first bytes stand
        at = 0
        while True:
            used: list[int] = []
            for text, part in _text_pieces(_unfolded(raw, most, used, at)):
                to = used[0] if used else len(raw)
                last = lines[bisect_right(first, skipped - (-to * 4 // 3) - 1, hi=len(lines)) - 1]  # later lines are not of it
                yield Layer(text, whole=layer.place(place(at, at + 1)[0], last[1])), part
            packed = _PACKED.search(raw, max(at + 1, used[1] if used else 0))
            if not packed:
                break
            at = packed.start()

        for text, start, width in _texts_of(raw):
            def parts() -> Iterator[Part]:
                at = start
                for c in text:
                    n = width or len(c.encode())
                    yield c, *place(at, at + n)
                    at += n

            yield _spread(parts(), layer), False


def _inner(layer: Layer, most: int) -> Iterator[tuple[Layer, bool]]:
    """Layers unwrapped from `layer`, one at a time."""
    if "%" in layer.text and _URL.search(layer.text):
        yield from ((_from_url(layer, a, b), False) for a, b in _regions(layer.text, _URL))
    if ("\\" in layer.text or "&#" in layer.text) and _ESCAPE.search(layer.text):
        yield from ((_from_escapes(layer, a, b), False) for a, b in _regions(layer.text, _ESCAPE))
    for pattern in (_BASE64, _BASE64_URL) if "-" in layer.text or "_" in layer.text else (_BASE64,):
        for m in pattern.finditer(layer.text):
            yield from _from_base64(layer, [m.span()], most)
    if "\n" in layer.text or "\r" in layer.text:
        for line, tail in _LINES if "-" in layer.text or "_" in layer.text else _LINES[:1]:
            for lines in _wrapped(layer.text, line, tail):
                yield from _from_base64(layer, lines, most)


def unwrapped(text: str, most: int = MAX_DECODED) -> tuple[list[Span], list[Span], set[tuple[int, int]]]:
    """Base spans, spans added from unwrapped layers, both in order, and the parts that did not fit one layer."""
    base = base_spans(text)
    added: set[Span] = set()
    seen: set[tuple[int, int, bytes]] = set()
    pieced: set[tuple[int, int]] = set()
    todo = [_inner(Layer(text), most)]  # depth first: one layer of each depth is held
    while todo:
        new, part = next(todo[-1], (None, False))
        if new is None:
            todo.pop()
            continue
        if part:
            pieced.add(new.whole)
        if not new.text:
            continue
        key = (*new.place(0, len(new.text)), hashlib.blake2b(new.text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        if key in seen:
            continue
        seen.add(key)
        added.update((kind, *new.place(a, b)) for kind, a, b in base_spans(new.text))
        todo.append(_inner(new, most))
    rank = {k: i for i, k in enumerate(KINDS)}
    in_order = lambda spans: sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))
    return in_order(base), in_order(added - set(base)), pieced


def scan(text: str, most: int = MAX_DECODED) -> tuple[list[Span], list[Span], bool]:
    """Base spans, spans added from unwrapped layers, both in order, and whether a part did not fit one layer."""
    base, added, pieced = unwrapped(text, most)
    return base, added, bool(pieced)


_SPANS = "array<struct<kind:string,start:long,end:long>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _rows(spans: Sequence[Span]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def find_secrets(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, base (spans of the text itself), added (spans of unwrapped layers) and exhausted."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [scan(x or "") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_rows(f[0]) for f in found], _ARROW), pa.array([_rows(f[1]) for f in found], _ARROW),
                     pa.array([f[2] for f in found], pa.bool_())], ["id", "base", "added", "exhausted"])

    out = docs.select(id_column, text_column).mapInArrow(run, f"id {kind}, base {_SPANS}, added {_SPANS}, exhausted boolean")
    return out.withColumnRenamed("id", id_column)


def redacted(text: str, most: int = MAX_DECODED) -> str:
    """`text` with every found span replaced by its kind, parts that did not fit one layer by `encoded`; overlapping spans become one."""
    base, added, pieced = unwrapped(text, most)
    out, at = [], 0
    for kind, a, b in sorted([*base, *added, *(("encoded", *p) for p in sorted(pieced))], key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """`docs` with the secrets in `text_column` replaced, all rows and columns kept; null texts stay null."""
    spot = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text = pa.array([None if x is None else redacted(x) for x in part.column(spot).to_pylist()], pa.string())
                yield part.set_column(spot, part.schema.field(spot).with_type(pa.string()), text)

    return docs.mapInArrow(run, docs.schema)
