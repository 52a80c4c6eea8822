"""Secret scans with a recursive decoding worklist.

Each text is the first layer. A layer is scanned, and what looks encoded in it (percent escapes,
Unicode escapes, base64, and gzip or zlib data inside these) is decoded to further layers until no
new one appears. Every layer carries, for each of its characters, where it comes from in the text,
so that a secret found in any depth is reported as a span of the text. A layer whose content was
seen at the same place before is not opened again, which ends cycles.
"""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
#: Decoded characters and bytes of one text, at most; what would pass it is counted as unopened.
MAX_DECODED = 64 << 20
PIECE = 1 << 16

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*"
                           r"(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)?={0,2}")
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_BASE64_PART = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")

Span = tuple[int, int]


class Layer:
    """Characters with the span of the text each comes from; `starts` is None for the text itself.

    A layer that is not `sure` is bytes read as if they were text.
    """

    def __init__(self, text: str, starts=None, ends=None, depth: int = 0, sure: bool = True):
        self.text, self.starts, self.ends, self.depth, self.sure = text, starts, ends, depth, sure

    def span(self, a: int, b: int) -> Span:
        if self.starts is None:
            return a, b
        return int(self.starts[a:b].min()), int(self.ends[a:b].max())

    def places(self, a: int, b: int):
        """Starts and ends in the text of the characters from a to b."""
        if self.starts is None:
            at = np.arange(a, b)
            return at, at + 1
        return self.starts[a:b], self.ends[a:b]


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """The base spans of one layer: leftmost, non-overlapping for each kind."""
    lowered = text.lower()
    if any(n in lowered for n in _NAMES):
        for m in _ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _holds_any(text: str) -> bool:
    """Whether a scan finds something in the text, or there is more to decode."""
    return (next(scan(text), None) is not None
            or any(p.search(text) for p in (_PERCENT, _UNICODE, _BASE64)))


def _text_of(data: bytes, starts, ends, depth: int) -> Iterator[Layer]:
    """The layers of bytes: UTF-8, or else Latin-1; where there are zero bytes, UTF-16 too.

    What does not look like text is a layer only if it holds anything. Of UTF-16 either order is
    read, as from an odd place the characters of one are those of the other as far as they are ASCII.
    """
    raw = np.frombuffer(data, np.uint8)
    try:
        text, first = data.decode("utf-8"), np.flatnonzero((raw & 0xC0) != 0x80)
        sure = sum(not (c.isprintable() or c in "\t\r\n") for c in text) * 10 <= len(text)
    except UnicodeDecodeError:
        text, first, sure = data.decode("latin-1"), np.arange(len(data)), False
    if text and (sure or _holds_any(text)):
        yield Layer(text, np.minimum.reduceat(starts, first), np.maximum.reduceat(ends, first), depth, sure)
    if b"\0" not in data:
        return
    for odd in (0, 1):
        units = np.frombuffer(data[odd:] + b"\0" * ((len(data) - odd) % 2), "<u2").copy()
        units[(units >= 0xD800) & (units < 0xE000)] = 0xFFFD
        text, first = units.astype("<u2").tobytes().decode("utf-16-le"), odd + 2 * np.arange(len(units))
        if len(units) and _holds_any(text):
            last = np.minimum(first + 1, len(data) - 1)
            yield Layer(text, np.minimum(starts[first], starts[last]), np.maximum(ends[first], ends[last]), depth, False)


def _unpacked(data: bytes, limit: int) -> bytes | None:
    """The content of gzip or zlib data; None if it is neither; OverflowError beyond `limit`."""
    if data[:2] == b"\x1f\x8b":
        mode = 31
    elif len(data) > 6 and data[0] & 0x0F == 8 and data[0] >> 4 <= 7 and (data[0] << 8 | data[1]) % 31 == 0:
        mode = 15
    else:
        return None
    engine, out, size = zlib.decompressobj(mode), [], 0
    try:
        while data:
            part = engine.decompress(data, PIECE)
            data = engine.unconsumed_tail
            size += len(part)
            if size > limit:
                raise OverflowError("too large")
            out.append(part)
            if engine.eof:
                data = engine.unused_data
                if data[:2] != b"\x1f\x8b":
                    data = data.lstrip(b"\0")
                if data[:2] != b"\x1f\x8b":
                    break
                engine = zlib.decompressobj(31)
            elif not part and not data:
                break
    except zlib.error:
        if not out:
            return None
    # What follows the packed data is looked at as it is.
    rest = engine.unused_data.lstrip(b"\0") if engine.eof else b""
    if size + len(rest) > limit:
        raise OverflowError("too large")
    return b"".join([*out, rest]) or None


def _bytes_layers(data: bytes, starts, ends, depth: int, limit: int) -> Iterator[Layer | None]:
    """The text in `data`, unpacked as often as it is packed; None for what is too large.

    Data that unpacks to itself has no text.
    """
    met = set()
    while (mark := hashlib.sha256(data).digest()) not in met:
        met.add(mark)
        try:
            plain = _unpacked(data, limit)
        except OverflowError:
            yield None
            return
        if plain is None:
            break
        starts, ends, data = np.full(len(plain), starts.min()), np.full(len(plain), ends.max()), plain
    yield from _text_of(data, starts, ends, depth)


def _rewritten(layer: Layer, parts: list[tuple[str, np.ndarray, np.ndarray]]) -> Layer:
    """The layer of parts: characters with the places (first, end) in `layer` they come from."""
    low, high = layer.places(0, len(layer.text))
    first, end = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    return Layer("".join(p[0] for p in parts), low[first], high[end - 1], layer.depth + 1)


def _same(layer: Layer, a: int, b: int) -> tuple[str, np.ndarray, np.ndarray]:
    return layer.text[a:b], np.arange(a, b), np.arange(a, b) + 1


def _percent(layer: Layer, limit: int) -> Iterator[Layer]:
    """The layer with all its percent escapes decoded, and what is packed inside a run of them."""
    parts, at = [], 0
    for m in _PERCENT.finditer(layer.text):
        data = bytes.fromhex(m.group().replace("%", ""))
        first = m.start() + 3 * np.arange(len(data))
        if data[:2] == b"\x1f\x8b" or data[0] & 0x0F == 8:
            yield from _from_bytes(layer, *m.span(), data, np.stack([first, first + 3], axis=1), limit)
        try:
            text = data.decode("utf-8")
            lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        except UnicodeDecodeError:
            text, lead = data.decode("latin-1"), np.arange(len(data))
        parts += [_same(layer, at, m.start()), (text, first[lead], np.append(first[lead[1:]], m.end()))]
        at = m.end()
    if parts:
        yield _rewritten(layer, [*parts, _same(layer, at, len(layer.text))])


def _unicode(layer: Layer, limit: int) -> Iterator[Layer]:
    """The layer with all its Unicode escapes decoded; halves of a surrogate pair become one."""
    parts, at = [], 0
    found = [(int(next(filter(None, m.groups())), 16), *m.span()) for m in _UNICODE.finditer(layer.text)]
    k = 0
    while k < len(found):
        code, a, b = found[k]
        k += 1
        if 0xD800 <= code < 0xDC00 and k < len(found) and found[k][1] == b and 0xDC00 <= found[k][0] < 0xE000:
            code, b = 0x10000 + ((code - 0xD800) << 10) + found[k][0] - 0xDC00, found[k][2]
            k += 1
        char = "\ufffd" if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)
        parts += [_same(layer, at, a), (char, np.array([a]), np.array([b]))]
        at = b
    if parts:
        yield _rewritten(layer, [*parts, _same(layer, at, len(layer.text))])


def _from_bytes(layer: Layer, a: int, b: int, data: bytes, frm, limit: int) -> Iterator[Layer]:
    """Layers of bytes that come from the characters `frm` (first, end) of `layer`."""
    low, high = layer.places(a, b)
    yield from _bytes_layers(data, low[frm[:, 0] - a], high[frm[:, 1] - 1 - a], layer.depth + 1, limit)


def _decoded(layer: Layer, spans: list[Span], limit: int) -> Iterator[Layer]:
    """The layers of the base64 in the spans, taken as one run."""
    body = "".join(layer.text[a:b] for a, b in spans).rstrip("=")
    used = len(body) - (len(body) % 4 == 1)
    data = base64.b64decode(body[:used].translate(str.maketrans("-_", "+/")) + "=" * (-used % 4))
    at, place = np.arange(len(data)), np.concatenate([np.arange(a, b) for a, b in spans])
    frm = np.stack([place[at * 8 // 6], place[(at * 8 + 7) // 6] + 1], axis=1)
    yield from _from_bytes(layer, spans[0][0], spans[-1][1], data, frm, limit)


def _base64(layer: Layer, limit: int) -> Iterator[Layer]:
    """Each run of base64; where it is none as a whole, its parts between path and name marks.

    Runs that go on in the next lines are taken as one too, with and without the first line, which
    may be something else.
    """
    for m in _BASE64.finditer(layer.text):
        whole = list(_decoded(layer, [m.span()], limit))
        yield from whole
        if not any(x is None or x.sure for x in whole):
            for part in _BASE64_PART.finditer(layer.text, *m.span()):
                if part.span() != m.span():
                    yield from _decoded(layer, [part.span()], limit)
    if "\n" in layer.text:
        for m in _BASE64_LINES.finditer(layer.text):
            lines = [r.span() for r in _BASE64_RUN.finditer(layer.text, *m.span())]
            if len(lines) > 1:
                yield from _decoded(layer, lines, limit)
            if len(lines) > 2:
                yield from _decoded(layer, lines[1:], limit)


def layers(text: str, limit: int = MAX_DECODED) -> Iterator[tuple[Layer, int]]:
    """All layers of a text, itself first, each with the number of contents left unopened so far."""
    todo, seen, left, unopened = [Layer(text)], {(text, 0, len(text))}, limit, 0
    while todo:
        layer = todo.pop()
        for mark, decode in (("%", _percent), ("\\", _unicode), ("", _base64)):
            if mark not in layer.text or not layer.text:
                continue
            for inner in decode(layer, left):
                if inner is None or len(inner.text) > left:
                    unopened += 1
                    continue
                key = (inner.text, *inner.span(0, len(inner.text)))
                if key not in seen:
                    seen.add(key)
                    left -= len(inner.text)
                    todo.append(inner)
        yield layer, unopened


def find(text: str | None, limit: int = MAX_DECODED) -> tuple[list, list, int]:
    """Base spans, all spans (kind, start, end) in order, and the number of unopened contents."""
    base: list[tuple[str, int, int]] = []
    every: set[tuple[str, int, int]] = set()
    unopened = 0
    for layer, unopened in layers(text or "", limit):
        for kind, a, b in scan(layer.text):
            span = (kind, *layer.span(a, b))
            every.add(span)
            if layer.starts is None:
                base.append(span)

    def order(s):
        return s[1], KINDS.index(s[0]), s[2]
    return sorted(base, key=order), sorted(every, key=order), unopened


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with each span replaced by [kind]; spans that touch each other become one."""
    out, at, end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"[{kind}]"]
        end = at = max(end, b)
    return "".join(out) + text[at:]


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_column(text: Column, limit: int = MAX_DECODED) -> Column:
    """What `find` has, as a struct. A null text counts as empty."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_unopened long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                base, every, unopened = find(t, limit)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), unopened))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_unopened"])
    return run(text.cast("string"))


def redact_column(text: Column, limit: int = MAX_DECODED) -> Column:
    """The text with all its secrets replaced; null stays null."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([t if t is None else redact(t, find(t, limit)[1]) for t in batch], dtype=object)
    return run(text.cast("string"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   limit: int = MAX_DECODED) -> DataFrame:
    """One row per row of `docs`: its id and the columns of `scan_column`; other columns are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), scan_column(F.col(text_col), limit).alias("s")).select(
        "doc_id", "s.*")
