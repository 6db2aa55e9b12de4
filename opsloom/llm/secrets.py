"""Secrets in texts and in what is wrapped in them.

A worklist unwraps a text layer by layer: URL escapes, Unicode escapes, base64 and compressed
content. Every layer is scanned and unwrapped again until nothing new appears; layers met before
are not met again, so cycles end. Each layer carries, for every character, the span of the
document that it came from, so what is found deep inside is reported where it lies in the text.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import id_and_text, id_type, released, slices, strings, text_slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE, MIN_ACCESS = 8, 16

# the shortest secret has 14 bytes (token:12345678): 19 digits
DIGITS = 19
LONG = re.compile(r"(?<!\S)\S{%d,}" % DIGITS)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % DIGITS)
# words of digits that follow each other over line breaks, quoted or indented ones too
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t>#*]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\([nrt/\"])"
)
SHORT_ESCAPES = {"n": "\n", "r": "\r", "t": "\t"}
# what may hold a secret of 14 characters in data that is not clean text: ASCII of one or two bytes a character
PRINTABLE = (
    (re.compile(rb"[\t\n\r\x20-\x7e]{14,}"), 1),
    (re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){14,}[\t\n\r\x20-\x7e]?|(?:\x00[\t\n\r\x20-\x7e]){14,}"), 2),
)
OPENERS = ((b"\x1f\x8b", "gzip"), (b"BZh", "bz2"), (b"\xfd7zXZ\x00", "xz"))
WINDOW, CHUNK_BYTES = 64 << 20, 1 << 20
TOTAL_BYTES = 4 << 30
SPACES = re.compile(r"\x20{2,}")


def found(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the plain patterns, in characters."""
    out = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                if len(m[0]) >= MIN_ACCESS]
    for word in LONG.finditer(text):
        out += [("hex", word.start() + m.start(), word.start() + m.end())
                for m in HEX.finditer(word[0])]
    return out


class Layer:
    """Text with the span of the document behind each of its characters."""

    def __init__(self, text: str, begins: np.ndarray, ends: np.ndarray):
        self.text, self.begins, self.ends = text, begins, ends

    def span(self, start: int, end: int) -> tuple[int, int]:
        return int(self.begins[start:end].min()), int(self.ends[start:end].max())


def rewritten(layer: Layer, pattern: re.Pattern, replace) -> Layer | None:
    """The layer with every match replaced by the pieces (text, from, to) that ``replace`` gives."""
    parts, begins, ends, at, changed = [], [], [], 0, False

    def keep(end: int) -> None:
        parts.append(layer.text[at:end])
        begins.append(layer.begins[at:end])
        ends.append(layer.ends[at:end])

    for match in pattern.finditer(layer.text):
        pieces = replace(match)
        if pieces is None:
            continue
        keep(match.start())
        for text, start, end in pieces:
            first, last = layer.span(match.start() + start, match.start() + end)
            parts.append(text)
            begins.append(np.full(len(text), first))
            ends.append(np.full(len(text), last))
        at, changed = match.end(), True
    if not changed:
        return None
    keep(len(layer.text))
    return Layer("".join(parts), np.concatenate(begins), np.concatenate(ends))


def url_pieces(match: re.Match) -> list[tuple[str, int, int]]:
    data = bytes.fromhex(match[0].replace("%", ""))
    out, at = [], 0
    while at < len(data):
        for size in range(1, 5):
            try:
                out.append((data[at:at + size].decode(), 3 * at, 3 * (at + size)))
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append(("\ufffd", 3 * at, 3 * at + 3))
        at += size
    return out


def unicode_pieces(match: re.Match) -> list[tuple[str, int, int]] | None:
    if match[5]:
        return [(SHORT_ESCAPES.get(match[5], match[5]), 0, 2)]
    point = int(next(g for g in match.groups() if g), 16)
    if point > 0x10FFFF or 0xD800 <= point < 0xE000:
        return None
    return [(chr(point), 0, len(match[0]))]


def unpacked(data: bytes) -> Iterator[bytes | None]:
    """Content of gzip, bzip2, xz or zlib data in chunks, as far as it can be read; None at a good end."""
    kind = next((name for opener, name in OPENERS if data.startswith(opener)), None)
    if kind is None and len(data) > 2 and data[0] == 0x78 and int.from_bytes(data[:2], "big") % 31 == 0:
        kind = "zlib"
    while kind:
        make = {"gzip": lambda: zlib.decompressobj(31), "bz2": bz2.BZ2Decompressor,
                "xz": lzma.LZMADecompressor, "zlib": zlib.decompressobj}
        packed, rest = make[kind](), data
        try:
            while not packed.eof:
                chunk = packed.decompress(rest, CHUNK_BYTES)
                rest = getattr(packed, "unconsumed_tail", b"")
                if chunk:
                    yield chunk
                elif not rest and getattr(packed, "needs_input", True) and not packed.eof:
                    return      # the data ends early
        except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError):
            return
        yield None
        data = packed.unused_data.lstrip(b"\0")      # more members may follow
        kind = next((name for opener, name in OPENERS if data.startswith(opener)), None)


class Scan:
    """What is found in a document: spans, layers met, bytes that may still be unpacked."""

    def __init__(self, left: int, most: int | None, window: int):
        self.every, self.met, self.left, self.complete = set(), set(), left, True
        self.most, self.window, self.whole = most, window, False

    def counted(self, chunks: Iterator[bytes | None]) -> Iterator[bytes]:
        self.whole = False
        for chunk in chunks:
            self.whole = chunk is None
            if chunk is None:
                continue
            if self.left < len(chunk):
                self.complete = False
                return
            self.left -= len(chunk)
            yield chunk

    def small(self, chunks: Iterator[bytes]) -> Iterator[bytes]:
        """The chunks, none if they are more than a caller allows."""
        held, size = [], 0
        for chunk in chunks:
            held.append(chunk)
            size += len(chunk)
            if size > self.most:
                self.complete = False
                return
        yield from held

    def windows(self, chunks: Iterator[bytes | None]) -> Iterator[tuple[str, bool]]:
        """Texts of at most ``window`` characters, each with the latter half of the one before.

        The second value tells whether there are several. Runs of spaces count as one there, so that
        no pattern is longer than half a window but for unbroken words: such are not decoded
        whole, and the scan is marked incomplete.
        """
        decoder, most, half = codecs.getincrementaldecoder("utf-8")("replace"), self.window, self.window // 2
        parts, size, several, fresh = [], 0, False, False
        read = self.counted(chunks)
        for chunk in read if self.most is None else self.small(read):
            parts.append(decoder.decode(chunk))
            size += len(parts[-1])
            fresh = True
            if size <= most:
                continue
            text = SPACES.sub(" ", "".join(parts))
            while len(text) > most:
                several = True
                self.judge(text[:most], half)
                yield text[:most], True
                text = text[half:]
            parts, size = [text], len(text)
        parts.append(decoder.decode(b"", True))
        text = "".join(parts)
        if fresh:
            if several:
                self.judge(text, half)
            yield text, several

    def judge(self, text: str, half: int) -> None:
        for pattern in (re.compile(r"\S+"), WRAPPED):
            if any(m.end() - m.start() > half for m in pattern.finditer(text)):
                self.complete = False

    def explore(self, layer: Layer) -> None:
        waiting = deque([layer])
        while waiting:
            for inner, several in deeper(waiting.popleft(), self):
                name = (hashlib.sha256(inner.text.encode(errors="replace")).digest(),
                        *(inner.span(0, len(inner.text)) if inner.text else ()))
                if name in self.met or not inner.text:
                    continue
                self.met.add(name)
                self.every |= {(kind, *inner.span(a, b)) for kind, a, b in found(inner.text)}
                if several:     # done before the next window is unpacked
                    self.explore(inner)
                else:
                    waiting.append(inner)


def readable(data: bytes) -> str | None:
    """Text of UTF-8 data, None if it is none or holds control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return None if re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else text


def printable_parts(data: bytes) -> Iterator[tuple[str, np.ndarray, int]]:
    """Runs of printable ASCII in binary data: text, the place of each character, bytes a character.

    Secrets are ASCII, so data in Latin-1, UTF-16 or with stray control characters loses none.
    """
    for pattern, width in PRINTABLE:
        for run in pattern.finditer(data):
            content = run[0][run[0].startswith(b"\0")::width]
            yield content.decode("ascii"), run.start() + width * np.arange(len(content)), width


def wrapped_runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Spans of the lines of base64 that is wrapped over two or more lines.

    All lines are equally long, but for a shorter last one. A short word after the last full line
    may be no part of it, so the full lines are given alone too, and a first line may be short
    where something stands before it.
    """
    for match in WRAPPED.finditer(text):
        if match.end() - match.start() < DIGITS:
            continue
        lines = [(match.start() + m.start(), match.start() + m.end()) for m in LINE.finditer(match[0])]
        sizes = [b - a for a, b in lines]
        at = 0
        while at < len(lines):
            end = at + 1
            while end < len(lines) and sizes[end] == sizes[at]:
                end += 1
            shorter = end < len(lines) and sizes[end] < sizes[at]
            for first in {at, max(at - 1, 0)}:
                if first < at and sizes[first] > sizes[at]:
                    continue
                for last in (end + 1, end) if shorter else (end,):
                    if last - first > 1:
                        yield lines[first:last]
            at = end


def base64_runs(text: str) -> Iterator[tuple[str, np.ndarray, int]]:
    """(digits, their places, end with padding) of what may be base64."""
    if "\n" in text or "\r" in text:
        for lines in wrapped_runs(text):
            digits = "".join([text[a:b] for a, b in lines])
            if len(digits) >= DIGITS:
                end = lines[-1][1]
                padding = len(text[end:end + 2]) - len(text[end:end + 2].lstrip("="))
                yield digits, np.concatenate([np.arange(a, b) for a, b in lines]), end + padding
    for word in LONG.finditer(text):
        for match in BASE64.finditer(word[0]):
            start, digits = word.start() + match.start(), match[0].rstrip("=")
            yield digits, np.arange(start, start + len(digits)), word.start() + match.end()


def base64_layers(layer: Layer, scan: Scan) -> Iterator[tuple[Layer, bool]]:
    taken: list[tuple[int, int]] = []       # parts of what unpacked whole are nothing by themselves
    for digits, places, stop in base64_runs(layer.text):
        at = bisect_right(taken, (int(places[0]), len(layer.text)))
        if at and taken[at - 1][1] >= stop:
            continue
        plain = digits.translate(str.maketrans("-_", "+/"))
        try:
            data = base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        first, last = layer.span(places[0], stop)
        whole = False
        for text, several in scan.windows(unpacked(data)):
            whole = scan.whole      # set by the last window; inner layers change it later
            yield Layer(text, np.broadcast_to(first, len(text)), np.broadcast_to(last, len(text))), several
        if whole:
            insort(taken, (int(places[0]), stop))
            continue
        # three bytes come from four digits
        def placed(text: str, at: np.ndarray, end: np.ndarray) -> Layer:
            last = np.minimum(-(-end * 4 // 3), len(digits)) - 1
            return Layer(text, layer.begins[places[at * 4 // 3]], layer.ends[places[last]])  # noqa: B023

        text = readable(data)
        if text is None:
            for text, at, width in printable_parts(data):
                yield placed(text, at, at + width), False
            continue
        sizes = np.array([len(c.encode()) for c in text], dtype=np.int64)
        end = np.cumsum(sizes)
        yield placed(text, end - sizes, end), False


def deeper(layer: Layer, scan: Scan) -> Iterator[tuple[Layer, bool]]:
    if "%" in layer.text and (inner := rewritten(layer, PERCENT, url_pieces)):
        yield inner, False
    if "\\" in layer.text and (inner := rewritten(layer, UNICODE, unicode_pieces)):
        yield inner, False
    yield from base64_layers(layer, scan)


def scan_text(
    text: str, most: int | None = None, total: int = TOTAL_BYTES, window: int = WINDOW
) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], bool]:
    """Spans of the plain text and of the text with all its layers, and whether all was scanned.

    Both are in reading order. A layer that unpacks to more than ``window`` is scanned in windows.
    ``total`` bounds what one document unpacks to, as a guard against bombs. Given ``most``, layers
    that unpack to more bytes are left out.
    """
    plain, scan = found(text), Scan(total, most, window)
    if LONG.search(text) or "%" in text or "\\" in text or WRAPPED.search(text):
        places = np.arange(len(text))
        scan.explore(Layer(text, places, places + 1))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(plain, key=order), sorted(scan.every | set(plain), key=order), scan.complete


def all_spans(
    text: str, most: int | None = None
) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the plain text, and of the text with all its layers; both in reading order."""
    return scan_text(text, most)[:2]


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for kind, start, end in spans])


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span of secrets replaced by a mark that names its kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append(f"[{kind}]")
        at = end
    return "".join([*out, text[at:]])


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int | None = None,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: its plain spans, all its spans, with ``with_text`` the masked text, and
    whether it was fully scanned.

    Spans are (kind, start, end) in code points of the document, the end exclusive, ordered by start,
    kind and end. A null or empty text has none. Repeated rows give repeated rows; other columns
    are not read. A layer that unpacks to more than 64 MiB is scanned in windows. ``complete`` is
    false where a document unpacks to more than 4 GiB, where such a layer holds an unbroken word
    of over half a window, and where a layer is left out because it unpacks to more than ``most``.
    Base64 data that is not clean UTF-8 text is searched in its runs of printable ASCII, of one byte or
    two bytes a character; JSON escapes are undone like Unicode ones.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = [id_col, "plain", "spans", "masked", "complete"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = strings(part.column("text"))
                both = [scan_text(text, most) for text in texts]
                lists = [
                    pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[i]] for row in both], span)
                    for i in (0, 1)
                ]
                masks = [masked(t, row[1]) if with_text else None for t, row in zip(texts, both)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *lists, pa.array(masks, pa.string()),
                     pa.array([row[2] for row in both], pa.bool_())], names=names
                )

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return id_and_text(docs, id_col, text_col).mapInArrow(
        scan, f"`{id_col}` {id_type(docs, id_col)}, plain {spans}, spans {spans}, masked string, complete boolean"
    )


def mask_secrets(text: Column, most: int | None = None) -> Column:
    """Texts with every span of secrets, wrapped ones too, replaced by a mark; null stays null."""
    def masks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in text_slices(batches):
            yield pa.array(
                [None if t is None else masked(t, all_spans(t, most)[1]) for t in part.to_pylist()], pa.string()
            )

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from masks(batches)
        released()

    return mask(text)
