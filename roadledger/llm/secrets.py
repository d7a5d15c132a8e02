"""Secret scans with a recursive decoding worklist.

Three kinds are looked for in a whole text: ``assign`` (a key word, ``:`` or ``=``, and a value of 8 or more),
``access`` (``AKIA`` keys of 16 or more) and ``hex`` (runs of 32 or more), each leftmost and non-overlapping. Then a
worklist unwraps layers until nothing new comes: percent escapes and ``\\u``/``\\x``/character-reference escapes (the
whole layer decoded in place), base64 runs in either alphabet (also across line breaks, and from every
place after a ``+``, ``/``, ``-`` or ``_``), and zlib or gzip members inside them. Every layer is scanned again, text or not (bytes are read one character each, as all that is looked for is ASCII); a digest of each layer seen stops cycles. What is found in a layer is mapped back through all layers to
code points of the original text: in-place escapes map character by character, base64 by its groups of four, compressed
data to the whole run from its start on.

Defined results: null text is empty and has no spans; equal spans of a kind count once; spans of the text itself always
stay; repeated rows give repeated results; a null id stays null; an empty table gives no rows; other columns are
neither read nor returned. Compressed data may grow to ``room`` (64 MiB and 1100 times the text); a run that grows
beyond is reported as a span of kind ``unread`` instead of being dropped.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from roadledger.llm.common import ADDRESS, FILE, ROW, addressed, text_of
from roadledger.llm.shingles import slices

KINDS = ("assign", "access", "hex", "unread")
# What counts as a secret.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
#: Shorter runs are words; every run is decoded and scanned, whatever its bytes are.
LEAST_RUN = 16
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % LEAST_RUN, re.A)
#: Runs parted by nothing but a line break and indentation are read as one as well.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+(?:\r\n?+|\n)[\x20\t]*+[A-Za-z0-9+/_-]++)++"
                     r"(?:(?:[\x20\t]*+(?:\r\n?+|\n)[\x20\t]*+)?=){0,2}", re.A)
LINE = re.compile(r"[A-Za-z0-9+/_=-]+", re.A)
#: A payload can begin after any of these; in text, the four places of a start modulo 4 show all of them.
SEPARATOR = re.compile(r"[+/_-]")
#: How base64 of a gzip or zlib head begins.
PACKED = re.compile("H4sI|e[A-P]")
# Prefilters over an Arrow column; a text that none of them hits has no layers and no spans.
HINTS = {"assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": "[0-9a-f]{32}",
         "percent": "%[0-9A-Fa-f]{2}", "escape": r"\\[uUx][0-9A-Fa-f]{2}|&#[0-9xX]", "base64": r"(?:[A-Za-z0-9+/_-](?:[\x20\t]*(?:\r\n?|\n)[\x20\t]*)?){%d}" % LEAST_RUN}
# The same over decoded bytes. All that is looked for is ASCII, so bytes of any kind are read one character each.
ANY = re.compile("|".join(pattern.removeprefix("(?i)").join(("(?i:", ")") if pattern.startswith("(?i)") else ("(?:", ")"))
                          for pattern in HINTS.values()).encode())
ROOM, GROWTH = 64 << 20, 1100


def base_spans(text: str, kinds=("assign", "access", "hex")) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets in a text as it stands."""
    found = []
    if "assign" in kinds:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "access" in kinds and "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if "hex" in kinds:
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return ordered(found)


def ordered(spans) -> list[tuple[int, int, str]]:
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


class Layer:
    """A decoded text with the places its characters come from.

    ``cuts`` are (first character, source start, source step): characters from a cut to the next come from the source
    one by one (step 1), or each from all of the cut's source span (step 0).
    """

    def __init__(self, text: str, parent: Layer | None, cuts: list[tuple[int, int, int, int]]):
        self.text, self.parent, self.cuts = text, parent, cuts
        self.firsts = [c[0] for c in cuts]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Span of the original text that holds the source of characters start to end (end exclusive)."""
        if self.parent is None:
            return start, end
        first, low, high, step = self.cuts[bisect_right(self.firsts, start) - 1]
        left = low + (start - first) if step else low
        first, low, high, step = self.cuts[bisect_right(self.firsts, end - 1) - 1]
        right = low + (end - first) if step else high
        return self.parent.source(left, right)


class Run:
    """A base64 run: its characters without line breaks, and for every line its first character and place in the text."""

    def __init__(self, chars: str, lines: list[tuple[int, int]]):
        self.chars, self.lines = chars, lines
        self.firsts = [first for first, _ in lines]
        self.digits = chars.rstrip("=").translate({45: 43, 95: 47})

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Span of the text that holds characters start to end (end exclusive)."""
        left, right = (self.lines[bisect_right(self.firsts, at) - 1] for at in (start, min(end, len(self.chars)) - 1))
        return left[1] + start - left[0], right[1] + min(end, len(self.chars)) - right[0]

    def data(self, start: int, most: int | None = None) -> bytes:
        """The bytes of the characters (at most so many) from a place on; an odd last one holds none."""
        size = min(len(self.digits) - start, most or len(self.digits))
        size -= size % 4 == 1
        return base64.b64decode(self.digits[start:start + size] + "=" * (-size % 4))


def _runs(text: str) -> Iterator[Run]:
    for match in BASE64.finditer(text):
        yield Run(match[0], [(0, match.start())])
    for match in WRAPPED.finditer(text):
        lines, parts, size = [], [], 0
        for line in LINE.finditer(text, match.start(), match.end()):
            lines.append((size, line.start()))
            parts.append(line[0])
            size += len(line[0])
        run = Run("".join(parts), lines)
        if len(run.digits) >= LEAST_RUN:
            yield run


class Decoded(Layer):
    """The bytes of a base64 run from a place on, one character each; their places go by groups of four of the run."""

    def __init__(self, data: bytes, parent: Layer, run: Run, first: int):
        super().__init__(data.decode("latin-1"), parent, [])
        self.run, self.first = run, first

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.parent.source(*self.run.source(self.first + start // 3 * 4, self.first + -(-end // 3) * 4))


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match that decodes written out; None where none does."""
    parts, cuts, at, size, changed = [], [], 0, 0, False
    for match in pattern.finditer(layer.text):
        plain = decode(match)
        if plain is None:
            continue
        if match.start() > at:
            cuts.append((size, at, match.start(), 1))
            parts.append(layer.text[at:match.start()])
            size += match.start() - at
        for char, low, high in plain:
            cuts.append((size, match.start() + low, match.start() + high, 0))
            parts.append(char)
            size += 1
        at, changed = match.end(), True
    if not changed:
        return None
    if at < len(layer.text):
        cuts.append((size, at, len(layer.text), 1))
        parts.append(layer.text[at:])
    return Layer("".join(parts), layer, cuts)


def _percent(match: re.Match) -> list[tuple[str, int, int]] | None:
    raw = bytes.fromhex(match[0].replace("%", ""))
    out, at = [], 0
    for char in raw.decode("utf-8", "replace"):
        size = 1 if char == "�" and raw[at:at + 3] != b"\xef\xbf\xbd" else len(char.encode())
        out.append((char, 3 * at, 3 * (at + size)))
        at += size
    return out if at == len(raw) else None


def _escape(match: re.Match) -> list[tuple[str, int, int]] | None:
    code = int(match[4]) if match[4] else int(next(g for g in (match[1], match[2], match[3], match[5]) if g), 16)
    return None if code > 0x10FFFF or 0xD800 <= code < 0xE000 else [(chr(code), 0, len(match[0]))]


def _member(data: bytes, room: int) -> tuple[bytearray, bytes]:
    """What a zlib or gzip stream holds, as far as it can be read, and the data after it."""
    tool, out, step = zlib.decompressobj(47), bytearray(), 4096
    for at in range(0, len(data), step):
        before = tool.copy()
        try:
            out += tool.decompress(data[at:at + step], room + 1 - len(out))
        except zlib.error:
            try:
                for k in range(at, at + step):  # up to the fault
                    out += before.decompress(data[k:k + 1], room + 1 - len(out))
                    if len(out) > room:
                        break
            except zlib.error:
                pass
            if len(out) > room:
                raise MemoryError
            return out, b""
        if len(out) > room:
            raise MemoryError
        if tool.eof:
            return out, tool.unused_data + data[at + step:]
    return out, b""


def _headed(data: bytes) -> bool:
    """True for bytes that begin like a gzip or zlib member."""
    return data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 5 and (data[0] << 8 | data[1]) % 31 == 0


def _unpacked(data: bytes, room: int) -> tuple[bytearray, int] | None:
    """Data out of the zlib or gzip members that some bytes begin with, and how many bytes those are; None if there are
    none. MemoryError if it grows beyond the room."""
    out, rest = bytearray(), data
    while _headed(rest):
        part, left = _member(rest, room)
        room -= len(part)
        out = out + part if out else part
        rest = left.lstrip(b"\0")  # padding
    return (out, len(data) - len(rest)) if out else None


def _base64(layer: Layer, room: list[int]) -> Iterator[Layer | tuple[int, int]]:
    """Layers for what base64 runs hold, straight and unpacked; a span for one that grows too large."""
    for run in _runs(layer.text):
        starts = sorted({0, *run.firsts, *(m.end() for m in SEPARATOR.finditer(run.chars))})
        for start in {start % 4: start for start in reversed(starts)}.values():
            data = run.data(start)
            if ANY.search(data):
                yield Decoded(data, layer, run, start)
        for start in starts:
            if not PACKED.match(run.digits, start) or not _headed(run.data(start, 8)):
                continue
            data, span = run.data(start), None
            try:
                while (unpacked := _unpacked(data, room[0])) is not None:
                    data, size = unpacked
                    span = span or run.source(start, start + -(-size // 3) * 4)
                    room[0] -= len(data)
                    if ANY.search(data):
                        yield Layer(data.decode("latin-1"), layer, [(0, *span, 0)])
            except MemoryError:
                yield span or run.source(start, len(run.chars))


def _children(layer: Layer, possible, room: list[int]) -> Iterator[Layer | tuple[int, int] | None]:
    if "percent" in possible:
        yield _replaced(layer, PERCENT, _percent)
    if "escape" in possible:
        yield _replaced(layer, ESCAPE, _escape)
    if "base64" in possible:
        yield from _base64(layer, room)


def _digest(text: str, place: tuple[int, int], step: int = 1 << 20) -> bytes:
    """Of a text and its place, a part at a time."""
    tool = blake2b(repr(place).encode(), digest_size=16)
    for at in range(0, len(text), step):
        tool.update(text[at:at + step].encode("utf-8", "surrogatepass"))
    return tool.digest()


def all_spans(text: str, kinds=("assign", "access", "hex"), layers=("percent", "escape", "base64")) -> tuple[list, list]:
    """Spans of the text itself, and of all its layers. ``kinds`` and ``layers`` name what a prefilter left possible.

    The worklist holds layers half done, innermost last: a layer is decoded when its turn comes, so that only those
    around the present one are in memory, not their neighbours.
    """
    base = base_spans(text, kinds)
    found, room = list(base), [ROOM + GROWTH * len(text)]
    digests = {_digest(text, (0, len(text)))}
    top = Layer(text, None, [])
    work = [(top, _children(top, layers, room))]
    while work:
        layer, children = work[-1]
        child = next(children, work)
        if child is work:
            work.pop()
        elif isinstance(child, tuple):
            found.append((*layer.source(*child), "unread"))
        elif child is not None and child.text:
            # The place counts too: one payload at two places is two findings.
            key = _digest(child.text, child.source(0, len(child.text)))
            if key not in digests:
                digests.add(key)
                found += [(*child.source(start, end), kind) for start, end, kind in base_spans(child.text)]
                work.append((child, _children(child, ("percent", "escape", "base64"), room)))
        child = None
    return base, ordered(found)


_SPAN = "array<struct<start:bigint,end:bigint,kind:string>>"
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = part.column("text")
        hints = [pc.match_substring_regex(texts, pattern).to_pylist() for pattern in HINTS.values()]
        both = []
        for text, *hits in zip(texts.to_pylist(), *hints):
            names = {name for name, hit in zip(HINTS, hits) if hit}
            both.append(all_spans(text, names, names) if names else ([], []))
        spans = [pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in row[i]] for row in both], _ARROW_SPAN) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column(FILE), part.column(ROW), *spans],
                                         names=["id", FILE, ROW, "base", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, address, ``base`` and ``spans`` (arrays of start, end, kind, in order)."""
    rows = addressed(docs, "documents")
    return rows.select(rows[id_col].alias("id"), *ADDRESS, text_of(rows, text_col).alias("text")).mapInArrow(
        _scan, f"id {docs.schema[id_col].dataType.simpleString()}, {FILE} bigint, {ROW} bigint, base {_SPAN}, spans {_SPAN}"
    ).withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
