"""Secret scans through nested encodings.

Base scan: three kinds of secrets in the text itself. Recursive scan: every layer that can be
unwrapped (URL escapes, Unicode escapes, base64, compressed data in base64) goes on a
worklist, is scanned again, and is unwrapped in turn until nothing new appears. A layer that
was seen before at the same place isn't followed again, so cycles end. Spans found in a layer
are mapped back to the code points of the text that it came from.

Every decoded layer is scanned, whatever its bytes: all three kinds and all escapes are ASCII, so
bytes are read as Latin-1, where ASCII stands as in UTF-8 and the one-byte code pages, and runs of
ASCII in UTF-16 or UTF-32 (either byte order, at any place) are unwrapped as layers of their own.

Defined cases: null and empty texts have no spans. A match that fails its kind's length is
dropped and not tried at a later start, as for any leftmost scan without overlap. Spans that
occur both in the text and in a layer are listed once.

Base64: runs of 16 characters or more of either alphabet, in all four alignments, so text glued on
before or behind does no harm; lines that follow each other are joined as well. Compressed: gzip,
zlib, bz2, xz and lzma streams wherever they begin in the decoded bytes, with all members, entries
of zip archives, and deflate without a header that begins and ends with a run, a line or a piece
between ``/ + - _``, or is the whole content of another stream. A layer is unwrapped whole and held in memory; deflate makes it about a thousand times
the text that holds it at most, bz2 and xz more. Not unwrapped: shorter base64 runs, base64 lines
parted by anything but one line end with blanks or ``>`` around it, base32, base85,
quoted-printable, HTML entities, hex, zip entries that are encrypted or use lzma, streams with a
preset dictionary, and xz or lzma streams that ask for more than ``LZMA_BYTES`` of memory.
"""

from __future__ import annotations

import binascii
import bisect
import bz2
import contextlib
import hashlib
import itertools
import lzma
import re
import string
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter maximal run can't hold a match
HINTS = ("passw", "secret", "token", "api")

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
MIN_BASE64 = 16
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_BASE64},}}={{0,2}}")
#: A base64 run over several lines; a line may be indented, quoted, or end in an escape (JSON).
WRAPPED = re.compile(
    r"[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r?\n|\r|(?:\\r)?\\n|\\r)[ \t>]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
LINE_END = re.compile(r"\n|\r|\\[nr]")
LETTERS = frozenset(string.ascii_letters + string.digits + "+/_-")
#: The letter of an escape isn't the run's.
LINE = re.compile(r"(?:(?<=\\n)|(?<=\\r)|(?<!\\))[A-Za-z0-9+/_-]+={0,2}")
PLAIN = str.maketrans("-_", "+/")
SPLIT = re.compile(r"[+/]")

#: Header bytes: zlib's are all pairs that its check sum allows, without a preset dictionary.
ZLIB = b"|".join(
    re.escape(bytes([a])) + b"[" + b"".join(re.escape(bytes([b])) for b in range(256) if (a << 8 | b) % 31 == 0 and not b & 32) + b"]"
    for a in range(0x08, 0x79, 0x10)
)
MAGIC = re.compile(
    rb"(?=(?P<gzip>\x1f\x8b\x08)|(?P<bz2>BZh[1-9](?:1AY&SY|\x17rE8P\x90))|(?P<xz>\xfd7zXZ\0)|(?P<lzma>\x5d\0\0)"
    rb"|(?P<zip>PK\x03\x04)|(?P<zlib>" + ZLIB + rb"))", re.S
)
#: Largest dictionary of an xz or lzma stream.
LZMA_BYTES = 256 << 20
FORMATS = {
    "gzip": lambda: zlib.decompressobj(31), "zlib": lambda: zlib.decompressobj(15), "bare": lambda: zlib.decompressobj(-15),
    "bz2": bz2.BZ2Decompressor, "xz": lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ, LZMA_BYTES),
    "lzma": lambda: lzma.LZMADecompressor(lzma.FORMAT_ALONE, LZMA_BYTES),
}
#: Formats whose streams in a row are one content.
SERIAL = ("gzip", "bz2", "xz")
BROKEN = (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError)
FIRST_PIECE = 256

#: Fewest characters that a secret of any kind has.
LEAST = 12
#: Runs of wide ASCII: pattern, place of the character in its unit, and size of the unit.
WIDE = tuple(
    (re.compile(f"(?:{unit}){{{LEAST},}}"), first, step)
    for unit, first, step in (
        (r"[\x01-\x7f]\0", 0, 2), (r"\0[\x01-\x7f]", 1, 2),
        (r"[\x01-\x7f]\0\0\0", 0, 4), (r"\0\0\0[\x01-\x7f]", 3, 4),
    )
)

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    lowered = text.lower()
    if any(hint in lowered for hint in HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class Layer:
    """A text and, for each of its code points, where it starts and ends in the document."""

    def __init__(self, text: str, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    def place(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def rewritten(layer: Layer, pieces: list[tuple[int, int, str]]) -> Layer:
    """The layer with some ranges replaced; what replaces a range is mapped to all of it."""
    text, starts, ends, at = [], [], [], 0
    for start, end, new in pieces:
        text += [layer.text[at:start], new]
        starts += layer.starts[at:start]
        ends += layer.ends[at:start]
        low, high = layer.place(start, end)
        starts += [low] * len(new)
        ends += [high] * len(new)
        at = end
    text.append(layer.text[at:])
    starts += layer.starts[at:]
    ends += layer.ends[at:]
    return Layer("".join(text), starts, ends)


def url_pieces(layer: Layer) -> list[tuple[int, int, str]]:
    pieces = []
    for m in URL.finditer(layer.text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        at = 0
        while at < len(raw):  # one code point at a time, so that spans stay exact
            for size in (1, 2, 3, 4):
                try:
                    new = raw[at : at + size].decode("utf-8")
                    break
                except UnicodeDecodeError:
                    continue
            else:
                at += 1
                continue
            pieces.append((m.start() + 3 * at, m.start() + 3 * (at + size), new))
            at += size
    return pieces


def escape_pieces(layer: Layer) -> list[tuple[int, int, str]]:
    pieces = []
    for run in ESCAPE.finditer(layer.text):
        units = [(m.start(), m.end(), int(next(g for g in m.groups() if g), 16)) for m in
                 ONE_ESCAPE.finditer(layer.text, run.start(), run.end())]
        i = 0
        while i < len(units):
            start, end, code = units[i]
            if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][2] < 0xE000:
                code = 0x10000 + ((code - 0xD800) << 10) + units[i + 1][2] - 0xDC00
                end = units[i + 1][1]
                i += 1
            if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
                pieces.append((start, end, chr(code)))
            i += 1
    return pieces


def wide_layers(layer: Layer) -> Iterator[Layer]:
    """ASCII runs that are written with one or three NULs to each character (UTF-16, UTF-32)."""
    if "\0" not in layer.text:
        return
    for pattern, first, step in WIDE:
        for m in pattern.finditer(layer.text):
            at = range(m.start() + first, m.end(), step)
            places = [layer.place(i - first, i - first + step) for i in at]
            yield Layer("".join(layer.text[i] for i in at), [p[0] for p in places], [p[1] for p in places])


def inflated(raw: bytes, at: int, make: Callable, magic: bytes) -> tuple[bytes, list[int]]:
    """What the stream at ``at`` and those of its kind right behind it hold, and where each ends.

    A cut stream counts as far as it goes, a damaged one up to the damage.
    """
    out: list[bytes] = []
    ends: list[int] = []
    while True:
        stream, start, size = make(), at, FIRST_PIECE
        while at < len(raw) and not stream.eof:
            mark = len(out)
            try:
                out.append(stream.decompress(raw[at : at + size]))
            except BROKEN:
                stream = make()  # once more, the last piece byte by byte
                with contextlib.suppress(*BROKEN):
                    stream.decompress(raw[start:at])
                    for i in range(at, min(at + size, len(raw))):
                        out.append(stream.decompress(raw[i : i + 1]))
                return b"".join(out), [*ends, at] if mark or any(out) else ends
            at += size
            size = min(size * 4, 1 << 20)
        at = min(at, len(raw)) - len(stream.unused_data)
        ends.append(at)
        if not stream.eof or not magic:
            return b"".join(out), ends
        while raw[at : at + 1] == b"\0":
            at += 1
        if not raw.startswith(magic, at):
            return b"".join(out), ends


def bare_content(raw: bytes, at: int) -> tuple[bytes, int] | None:
    """The content of a deflate stream without a header, and its end; None if it doesn't come to one."""
    stream, out, size = zlib.decompressobj(-15), [], 64
    try:
        while at < len(raw) and not stream.eof:
            out.append(stream.decompress(raw[at : at + size]))
            at += size
            size = min(size * 4, 1 << 20)
    except zlib.error:
        return None
    return (b"".join(out), min(at, len(raw)) - len(stream.unused_data)) if stream.eof else None


def streams(raw: bytes, bare: Iterable[int], may_end: Callable[[int], bool]) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, content) of the compressed streams in ``raw``.

    Deflate without a header has no mark of its own, and chance bytes often read as some: it is
    looked for at the places ``bare`` only, and must end where ``may_end`` holds.
    """
    known: set[int] = set()
    for m in MAGIC.finditer(raw):
        at, kind = m.start(), m.lastgroup
        if kind == "zip":  # the data of the entry begins behind its name and extra field
            name, extra = int.from_bytes(raw[at + 26 : at + 28], "little"), int.from_bytes(raw[at + 28 : at + 30], "little")
            at += 30 + name + extra
            kind = "bare" if raw[m.start() + 8 : m.start() + 10] == b"\x08\0" else None
        if kind and at not in known:
            content, ends = inflated(raw, at, FORMATS[kind], m[kind][:3] if kind in SERIAL else b"")
            known.update(ends[:-1])
            if content:
                yield at, ends[-1], content
    for at in bare:
        # deflate: no block of the third type, a stored block repeats its length inverted
        kind = raw[at] >> 1 & 3 if len(raw) - at > 4 else 3
        if kind == 3 or (kind == 0 and any(raw[at + i] ^ raw[at + 2 + i] != 255 for i in (1, 2))):
            continue
        found = bare_content(raw, at)
        if found and len(found[0]) >= LEAST and may_end(found[1]):
            yield at, found[1], found[0]


def runs_of(text: str) -> Iterator[list[tuple[int, int]]]:
    """Lines of each base64 run: first the runs without a line end, then those over several lines."""
    for m in BASE64.finditer(text):
        yield [(m.start(), m.end())]
    at = 0
    for m in LINE_END.finditer(text):
        end = m.start()
        while end > at and text[end - 1] in " \t\r":
            end -= 1
        if end <= at or text[end - 1] not in LETTERS:
            continue
        start = end
        while start > at and text[start - 1] in LETTERS:
            start -= 1
        if run := WRAPPED.match(text, start):
            at = run.end()
            lines = [(x.start(), x.end()) for x in LINE.finditer(text, start, at)]
            if sum(e - s for s, e in lines) >= MIN_BASE64:
                yield lines


def base64_layers(layer: Layer, seen: set[bytes]) -> Iterator[Layer]:
    """Each run in its four alignments, and the compressed streams in them.

    What a layer shows is mapped to the lines of the run that hold it.
    """
    for lines in runs_of(layer.text):
        token = "".join(layer.text[s:e] for s, e in lines).rstrip("=").translate(PLAIN)
        starts = [0, *itertools.accumulate(e - s for s, e in lines)][:-1]
        splits = [0, *starts[1:], *(m.end() for m in SPLIT.finditer(token))]
        stops = {len(token), *starts[1:], *(m.start() for m in SPLIT.finditer(token))}

        def place(low: int, high: int, shift: int) -> tuple[int, int]:
            first = lines[bisect.bisect_right(starts, shift + low * 8 // 6) - 1]
            last = lines[bisect.bisect_right(starts, shift + (high * 8 - 1) // 6) - 1]
            return layer.place(first[0], first[1])[0], layer.place(last[0], last[1])[1]

        for shift in range(4):
            size = len(token) - shift
            size -= size % 4 == 1
            raw = binascii.a2b_base64(token[shift : shift + size] + "=" * (-size % 4))
            if len(raw) >= LEAST:
                if len(lines) == 1:
                    places = [place(0, len(raw), shift)] * len(raw)
                else:
                    places = [place(i, i + 1, shift) for i in range(len(raw))]
                yield Layer(raw.decode("latin-1"), [x[0] for x in places], [x[1] for x in places])
            begins = [(at - shift) * 3 // 4 for at in splits if at >= shift and (at - shift) % 4 == 0]
            work = [(raw, begins, lambda end, shift=shift: shift + (end * 4 + 2) // 3 in stops, None)]
            while work:
                packed, bare, may_end, where = work.pop()
                for low, high, content in streams(packed, bare, may_end):
                    at = where or place(low, max(high, low + 1), shift)
                    if new_in(seen, content, at):
                        work.append((content, [0], len(content).__eq__, at))
                        yield Layer(content.decode("latin-1"), [at[0]] * len(content), [at[1]] * len(content))


def new_in(seen: set[bytes], content: bytes, at: tuple[int, int]) -> bool:
    key = hashlib.blake2b(content, digest_size=16)
    key.update(f":{at[0]}:{at[1]}:{len(content)}".encode())
    found = key.digest() not in seen
    seen.add(key.digest())
    return found


def may_unwrap(text: str) -> bool:
    return "\0" in text or bool(("%" in text and URL.search(text)) or ("\\" in text and ESCAPE.search(text)) or next(runs_of(text), None))


def layer_spans(text: str) -> set[Span]:
    """Spans that only layers show, mapped to the text."""
    found: set[Span] = set()
    if not may_unwrap(text):
        return found
    whole = range(len(text))
    work = [Layer(text, list(whole), [i + 1 for i in whole])]
    seen: set[bytes] = set()
    unpacked: set[bytes] = set()
    while work:
        layer = work.pop()
        pieces = [p for p in (url_pieces(layer), escape_pieces(layer)) if p]
        for inner in [*(rewritten(layer, p) for p in pieces), *wide_layers(layer), *base64_layers(layer, unpacked)]:
            if not inner.text or not new_in(
                    seen, inner.text.encode("utf-8", "surrogatepass"), (inner.starts[0], inner.ends[-1])):
                continue
            for start, kind, end in base_spans(inner.text):
                low, high = inner.place(start, end)
                found.add((low, kind, high))
            work.append(inner)
    return found


def scan(text) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of one text, each in order of start, kind and end."""
    if not isinstance(text, str) or not text:
        return [], []
    base = base_spans(text)
    return base, sorted({*base, *layer_spans(text)})


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base spans, and all spans."""

    @F.pandas_udf("struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string>")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        both = [scan(t) for t in texts]
        n = [[sum(s[1] == k for s in base) for base, _ in both] for k in range(3)]
        return pd.DataFrame({
            "n_assign": n[0], "n_access": n[1], "n_hex": n[2],
            "base_sha256": [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in both],
            "spans": [written(every) for _, every in both],
        })

    return docs.select(F.col(id_column), scanned(F.col(text)).alias("r")).select(id_column, "r.*")


def masked(text, spans: list[Span], mask: str) -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``mask``; null texts stay null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: masked(t, scan(t)[1], mask) if isinstance(t, str) else None)

    return docs.withColumn(text, clean(F.col(text)))
