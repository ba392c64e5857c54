"""Secret scans through nested encodings.

Every whole text is scanned by three patterns.  Then a worklist unwraps it: percent
escapes, Unicode escapes and base64 runs, whose bytes may themselves be compressed,
become further layers, each scanned and unwrapped again until nothing new appears.
A base64 run is in either alphabet, may be wrapped into lines (of 16 or more characters)
and may be glued to a path or a name; of bytes that are no text the readable runs are scanned.
Compressed bytes may also be written with percent, Unicode or byte escapes, and have several members.
A layer already seen in the document is not entered twice, which also ends cycles.
Each layer knows, for every character, which characters of the original text it came
from, so a secret found deep inside is reported at the place of its wrapping.

Each unwrapped layer is shorter than what it was cut from, but for compressed data:
one layer may expand to ``max_layer_bytes``, and what a document unwraps in all to
``max_document_bytes``; a document that meets a limit keeps the spans found so far and
has ``complete`` false.  These limits bound a task's memory against bombs.

Defined results: NULL and empty texts have no spans; equal spans of one kind count
once; repeated rows and extra or clashing columns make no difference, as only the text
is read and the result's columns are fixed.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.text import documents

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|[\\%]u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\[0-3][0-7]{2}")
#: Escapes of single bytes; those of characters may come with the usual letters.
_PERCENT_BYTE = re.compile(r"%[0-9A-Fa-f]{2}")
_CHARACTER_BYTE = re.compile(r"""\\[0-3][0-7]{2}|\\x[0-9A-Fa-f]{2}|(?:[\\%]u|\\U0000)00[0-9A-Fa-f]{2}|\\u\{0*[0-9A-Fa-f]{1,2}\}|\\[abfnrtv0'"\\]""")
_LETTERS = dict(zip("abfnrtv0'\"\\", b"\a\b\f\n\r\t\v\0'\"\\", strict=True))
#: Either alphabet, over line breaks.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: No secret and no encoding of one is without so many ASCII characters in a row.
_ASCII = re.compile(rb"[\t-\r\x20-\x7e]{16}")
_ISLAND = re.compile(rb"[\t-\r\x20-\x7e]{16,}")
#: How gzip, zstandard, bzip2 and xz data begin; zlib has but two bytes that must go together.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00")
#: Of data that only look like zlib, so much is read for 16 ASCII characters in a row.
_PROBE = 65_536

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


@dataclass(frozen=True)
class Settings:
    max_layer_bytes: int = 16_000_000
    max_document_bytes: int = 64_000_000


def scan(text: str) -> list[Span]:
    """Base spans: leftmost non-overlapping by kind, those too short dropped."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return spans


class Layer:
    """A text with the range of the original text behind each character (none: itself)."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> None:
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))

    def rewritten(self, pieces: list[tuple[int, int, str]]) -> Layer:
        """The layer with each (start, end) replaced; the new characters come from that range."""
        n = len(self.text)
        starts = np.arange(n) if self.starts is None else self.starts
        ends = np.arange(1, n + 1) if self.ends is None else self.ends
        text, left, right, at = [], [], [], 0
        for start, end, new in pieces:
            text += [self.text[at:start], new]
            left += [starts[at:start], np.full(len(new), starts[start])]
            right += [ends[at:start], np.full(len(new), ends[end - 1])]
            at = end
        return Layer("".join([*text, self.text[at:]]), np.concatenate([*left, starts[at:]]), np.concatenate([*right, ends[at:]]))

    def within(self, start: int, end: int, new: str) -> Layer:
        """A layer of its own, all of it from one range."""
        a, b = self.origin(start, end)
        return Layer(new, np.broadcast_to(np.int64(a), len(new)), np.broadcast_to(np.int64(b), len(new)))


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _islands(raw: bytes) -> str:
    """The bytes as text, or what is readable in them; nothing that is looked for goes over a zero character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "\0".join(x[0].decode() for x in _ISLAND.finditer(raw))


def _clean(raw: bytes) -> bool:
    """Whether the bytes are text and nothing else."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return False
    return not any(x < " " and x not in "\t\n\r\f\v" or x == "\x7f" for x in text)


class _Zlib:
    """A zlib or gzip stream; input that is not used up stays with it."""

    def __init__(self) -> None:
        self.coder, self.tail = zlib.decompressobj(47), b""

    eof = property(lambda self: self.coder.eof)
    unused_data = property(lambda self: self.coder.unused_data)
    needs_input = property(lambda self: not self.coder.unconsumed_tail)

    def decompress(self, raw: bytes, most: int) -> bytes:
        return self.coder.decompress(self.coder.unconsumed_tail + raw, most)


class _Zstd:
    """A zstandard frame, read like the other formats; a few input bytes at a time, so that no call gives much."""

    def __init__(self) -> None:
        self.coder, self.rest = zstandard.ZstdDecompressor().decompressobj(), b""

    eof = property(lambda self: self.coder.eof)
    unused_data = property(lambda self: self.coder.unused_data + self.rest if self.coder.eof else b"")
    needs_input = property(lambda self: not self.rest)

    def decompress(self, raw: bytes, most: int) -> bytes:
        self.rest, out, at, total = self.rest + raw, [], 0, 0
        while at < len(self.rest) and not self.coder.eof and total < most:
            out.append(self.coder.decompress(self.rest[at : at + 256]))
            total += len(out[-1])
            at += 256
        self.rest = self.rest[at:]
        return b"".join(out)


def _coder(head: bytes):
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return _Zstd()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:1] == b"\xfd":
        return lzma.LZMADecompressor(memlimit=256_000_000)
    return _Zlib()


def _member(raw: bytes, start: int, limit: int, follows: bool = False) -> tuple[bytes, int, bool] | None:
    """Bytes of the stream that begins here, cut behind the limit, where it ends, and whether it has an end; None if there is none.

    Input goes in by pieces, so bytes that are no stream cost a piece.  The two bytes of
    zlib are met by chance in any binary data: such a stream counts if its checksum is
    right, if its first part holds readable text or if it ``follows`` one that counts.
    """
    view, coder, parts, size, at, step = memoryview(raw), _coder(raw[start : start + 4]), [], 0, start, 512
    weak = isinstance(coder, _Zlib) and raw[start] != 0x1F and not follows
    try:
        while size <= limit and not coder.eof and at < len(raw):
            chunk = bytes(view[at : at + step])
            at += len(chunk)
            step = min(4 * step, 1 << 20)
            parts.append(coder.decompress(chunk, limit + 1 - size))
            size += len(parts[-1])
            while size <= limit and not coder.eof and not coder.needs_input:
                parts.append(coder.decompress(b"", limit + 1 - size))
                size += len(parts[-1])
                if not parts[-1]:
                    break
            if weak and size >= _PROBE and not coder.eof:
                if not _ASCII.search(b"".join(parts)[:_PROBE]):
                    return None
                weak = False
    except (zlib.error, zstandard.ZstdError, OSError, EOFError, lzma.LZMAError, ValueError):
        # what a broken stream gave before is worth reading only if it can be read
        found = b"".join(parts)
        return (found, at, False) if _ASCII.search(found) else None
    found = b"".join(parts)
    if weak and not coder.eof and not _ASCII.search(found):
        return None
    return found, at - len(coder.unused_data) if coder.eof else at, coder.eof


def _expanded(raw: bytes, start: int, limit: int) -> tuple[bytes, int, bool] | None:
    """Decompressed bytes of all members, cut behind the limit, where they end, and whether they have an end."""
    parts, size, at, ended = [], 0, start, False
    while size <= limit and (found := _member(raw, at, limit - size, ended)) is not None:
        inner, at, ended = found
        parts.append(inner)
        size += len(inner)
        # members of one file follow one another, at most with zeros between
        following = at + len(raw[at : at + 4096]) - len(raw[at : at + 4096].lstrip(b"\0"))
        if not ended or raw[following : following + 3] != raw[start : start + 3]:
            break
        at = following
    return (b"".join(parts), at, ended) if size else None


def _starts(raw: bytes) -> list[int]:
    """Where compressed data may begin: two bytes are a zlib header if they divide by 31, and name no dictionary."""
    data = np.frombuffer(raw, np.uint8)
    first, second = data[:-1], data[1:]
    zlib_heads = np.flatnonzero((first & 0x8F) == 8)
    pairs = first[zlib_heads].astype(np.int64) * 256 + second[zlib_heads]
    zlib_heads = zlib_heads[(pairs % 31 == 0) & (second[zlib_heads] & 32 == 0)]
    return sorted({*zlib_heads.tolist(), *(m.start() for m in _MAGIC.finditer(raw))})


class Budget:
    """What a document may still expand to."""

    def __init__(self, settings: Settings) -> None:
        self.layer, self.left = settings.max_layer_bytes, settings.max_document_bytes


def _streams(raw: bytes, budget: Budget) -> Iterator[tuple[int, int, bytes | None]]:
    """(start, end, expanded bytes) of the compressed data in the bytes, also in what they expand to; None where a limit was met."""
    work = [(raw, None)]
    while work:
        data, place = work.pop()
        after = 0
        for start in _starts(data):
            if start < after:
                continue
            if (found := _expanded(data, start, min(budget.layer, max(0, budget.left)))) is None:
                continue
            inner, end, ended = found
            after = end if ended else 0
            budget.left -= len(inner)
            a, b = place or (start, end)
            if len(inner) > budget.layer or budget.left < 0:
                yield a, b, None
            else:
                yield a, b, inner
                work.append((inner, (a, b)))


def _percent(m: re.Match[str]) -> str:
    return _text(bytes.fromhex(m[0].replace("%", "")))


def _bytes_of(layer: Layer, escapes: re.Pattern[str], budget: Budget) -> Iterator[Layer | None]:
    """What compressed bytes written with these escapes, between characters that stand for themselves, expand to."""
    pieces = [(m.start(), m.end(), chr(_byte(m[0]))) for m in escapes.finditer(layer.text)]
    written = [layer.rewritten(pieces)]
    if escapes is _PERCENT_BYTE and "+" in layer.text:  # a form's blanks
        written.append(layer.rewritten(sorted([*pieces, *((m.start(), m.end(), " ") for m in re.finditer(r"\+", layer.text))])))
    for own in written:
        for m in re.finditer(r"[\x00-\xff]+", own.text):
            for a, b, inner in _streams(m[0].encode("latin-1"), budget):
                if inner is None:
                    yield None
                elif _ASCII.search(inner):
                    yield own.within(m.start() + a, m.start() + b, _islands(inner))


def _byte(escape: str) -> int:
    if escape[0] == "\\" and escape[1:].isdigit() and len(escape) == 4:
        return int(escape[1:], 8)
    return _LETTERS[escape[1]] if escape[0] == "\\" and escape[1] in _LETTERS else int(escape.lstrip("%\\xuU{").rstrip("}"), 16)


def _point(escape: str) -> int:
    return int(escape[1:], 8) if escape[1].isdigit() else int(escape[2:].strip("{}"), 16)


def _base64(layer: Layer, start: int, run: str, budget: Budget) -> Iterator[Layer | None]:
    """The layers of one run, which may be wrapped and may have anything of its alphabet before or behind the encoding.

    The encoding may begin at any character, so unless the run is text or compressed as a whole
    it is decoded from each of the first four.
    """
    lines = [(m.start(), m[0]) for m in re.finditer(r"[^\s=]+", run)]
    body = "".join(x for _, x in lines).translate({45: 43, 95: 47})
    firsts = list(accumulate((len(x) for _, x in lines), initial=0))

    def place(i: int) -> int:
        line = bisect_right(firsts, i, 0, len(lines)) - 1
        return start + lines[line][0] + i - firsts[line]

    begins = None
    for phase in range(4):
        part = body[phase:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        raw = base64.b64decode(part + "=" * (-len(part) % 4))
        whole = phase == 0 and _clean(raw)
        found = [(at.start(), len(raw), raw)] if (at := _ASCII.search(raw)) else []
        if not whole:
            if begins is None:
                begins = sorted({0, *firsts[:-1], *(m.end() for m in re.finditer("[/_-]", "".join(x for _, x in lines)))})
            found = chain(found, _streams(raw, budget))
        own = [x for x in begins or [0] if x % 4 == phase]
        for a, b, inner in found:
            if inner is None:
                yield None
                continue
            whole |= phase == 0 and a == 0 and b == len(raw) and inner is not raw
            if _ASCII.search(inner):
                first = phase + a * 4 // 3
                before = bisect_right(own, first)
                last = start + len(run) if b == len(raw) else place(min(len(body) - 1, phase + -(-b * 4 // 3) - 1)) + 1
                yield layer.within(place(own[before - 1] if before else first), last, _islands(inner))
        if whole:
            return


def unwrap(layer: Layer, settings: Settings, budget: Budget) -> Iterator[Layer | None]:
    """The layers directly below; None for one that met a limit."""
    text = layer.text
    if "%" in text and (pieces := [(m.start(), m.end(), _percent(m)) for m in _PERCENT.finditer(text)]):
        yield layer.rewritten(pieces)
        yield from _bytes_of(layer, _PERCENT_BYTE, budget)
    if "\\" in text or "%u" in text:
        points = [(m.start(), m.end(), _point(m[0])) for m in _UNICODE.finditer(text)]
        if pieces := [(a, b, chr(x)) for a, b, x in points if x < 0xD800 or 0xDFFF < x <= 0x10FFFF]:
            yield layer.rewritten(pieces)
            yield from _bytes_of(layer, _CHARACTER_BYTE, budget)
    for m in _BASE64.finditer(text):
        if "\n" in m[0]:
            for line in _LINE.finditer(m[0]):
                if len(line[0].rstrip("=")) >= 16:
                    yield from _base64(layer, m.start() + line.start(), line[0], budget)
        yield from _base64(layer, m.start(), m[0], budget)


def deep_scan(text: str, settings: Settings = Settings()) -> tuple[list[Span], list[Span], bool]:
    """Base spans, all spans, and whether every layer was entered; sorted by start, kind, end."""
    base = scan(text)
    found, work, seen, total, complete = set(base), [Layer(text)], {text}, 0, True
    budget = Budget(settings)
    while work:
        for layer in unwrap(work.pop(), settings, budget):
            if layer is None or total + len(layer.text) > settings.max_document_bytes:
                complete = False
            elif layer.text not in seen:
                seen.add(layer.text)
                total += len(layer.text)
                for start, kind, end in scan(layer.text):
                    a, b = layer.origin(start, end)
                    found.add((a, kind, b))
                work.append(layer)
    return sorted(base), sorted(found), complete


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, counts of base spans by kind, base (base spans), spans (all spans) and complete for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [deep_scan(x or "", settings) for x in batch.column(1).to_pylist()]
            counts = [[sum(kind == k for _, kind, _ in base) for base, _, _ in rows] for k in range(3)]
            texts = [[listed(x[i]) for x in rows] for i in (0, 1)]
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in counts), *(pa.array(x, pa.string()) for x in texts)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[2] for x in rows], pa.bool_())], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base string, spans string, complete boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op3_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.encode("base", "utf-8"), 256).alias("base_sha256"), "spans", "complete")
