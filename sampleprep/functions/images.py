"""Pixels of PNG files, and whether PNG and JPEG files are whole.

Small functions of one file's bytes, for Arrow functions in tasks. A file that is not whole raises ImageError with the reason.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PNG_MAGIC, JPEG_MAGIC = b"\x89PNG\r\n\x1a\n", b"\xff\xd8"
#: Larger images are refused, as their pixels don't fit in a worker.
MOST_PIXELS = 178_956_970
#: Channels by PNG colour type, and the depths each may have. Fixed values of the format.
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
#: First column and row, and steps, of the seven passes of an interlaced PNG. Fixed values of the format.
_PASSES = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]


class ImageError(ValueError):
    """Why a file can't be decoded, in a few words that name no values."""


@dataclass(frozen=True)
class Header:
    width: int
    height: int
    depth: int
    colour: int
    interlaced: bool

    @property
    def mode(self) -> str:
        """The mode that a PNG opens in: 1, L, I;16, RGB, RGBA, LA or P."""
        if self.colour == 0:
            return "1" if self.depth == 1 else "I;16" if self.depth == 16 else "L"
        return {2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}[self.colour]

    def row_bytes(self, width: int) -> int:
        return (width * _CHANNELS[self.colour] * self.depth + 7) // 8

    def passes(self) -> list[tuple[int, int, int, int, int, int]]:
        """Width and height of each pass with pixels, and where they go: first column, row, steps."""
        if not self.interlaced:
            return [(self.width, self.height, 0, 0, 1, 1)]
        sizes = [(-(-(self.width - x) // dx), -(-(self.height - y) // dy), x, y, dx, dy) for x, y, dx, dy in _PASSES]
        return [p for p in sizes if p[0] > 0 and p[1] > 0]

    def inflated(self) -> int:
        return sum((self.row_bytes(w) + 1) * h for w, h, *_ in self.passes())


def png_chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, body) of each chunk up to the end chunk, with sound lengths and checksums."""
    if data[:8] != PNG_MAGIC:
        raise ImageError("not a PNG")
    at = 8
    while True:
        if at + 12 > len(data):
            raise ImageError("truncated")
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        if at + 12 + size > len(data):
            raise ImageError("truncated")
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(body, zlib.crc32(kind)) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ImageError("bad checksum")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + size


def png_header(body: bytes) -> Header:
    if len(body) != 13:
        raise ImageError("bad header")
    width, height, depth, colour, method, filters, interlace = struct.unpack(">IIBBBBB", body)
    if not width or not height or depth not in _DEPTHS.get(colour, ()) or method or filters or interlace > 1:
        raise ImageError("bad header")
    if width * height > MOST_PIXELS:
        raise ImageError("too large")
    return Header(width, height, depth, colour, bool(interlace))


def unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """The bytes of rows (filter byte first) with their filters undone; step: bytes from a pixel to the next.

    A byte needs its neighbours to the left and above, so all pixels of a diagonal are done at once.
    """
    kinds, height = rows[:, 0], len(rows)
    if kinds.max(initial=0) > 4:
        raise ImageError("bad filter")
    width = -(-(rows.shape[1] - 1) // step)
    padded = np.zeros((height, width * step), dtype=np.uint8)
    padded[:, : rows.shape[1] - 1] = rows[:, 1:]
    given = padded.reshape(height, width, step)
    out = np.zeros((height + 1, width + 1, step), dtype=np.uint8)
    if kinds.max(initial=0) <= 2:
        for y in range(height):  # nothing, the left byte, or the one above: whole rows at once
            row = np.cumsum(given[y], axis=0, dtype=np.uint8) if kinds[y] == 1 else given[y]
            out[y + 1, 1:] = row + out[y, 1:] if kinds[y] == 2 else row
    else:
        for d in range(height + width - 1):
            y = np.arange(max(0, d - width + 1), min(height, d + 1))
            x, kind = d - y, kinds[y][:, None]
            left, up, corner = (v.astype(np.int16) for v in (out[y + 1, x], out[y, x + 1], out[y, x]))
            guess = left + up - corner
            off_left, off_up, off_corner = (np.abs(guess - v) for v in (left, up, corner))
            paeth = np.where((off_left <= off_up) & (off_left <= off_corner), left, np.where(off_up <= off_corner, up, corner))
            by = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) // 2, paeth], 0)
            out[y + 1, x + 1] = given[y, x] + by.astype(np.uint8)
    return out[1:, 1:].reshape(height, width * step)[:, : rows.shape[1] - 1]


def _samples(rows: np.ndarray, width: int, header: Header) -> np.ndarray:
    """Rows of bytes as numbers: height, width, channels."""
    channels = _CHANNELS[header.colour]
    if header.depth == 8:
        return rows.reshape(len(rows), width, channels)
    if header.depth == 16:
        return rows.reshape(len(rows), width, channels, 2).astype(np.uint16) @ np.array([256, 1], dtype=np.uint16)
    bits = np.unpackbits(rows, axis=1).reshape(len(rows), -1, header.depth)
    return (bits @ (1 << np.arange(header.depth)[::-1])).astype(np.uint8)[:, :width, None]


@dataclass(frozen=True)
class Png:
    header: Header
    samples: np.ndarray  # height, width, channels, as stored
    palette: np.ndarray  # 256 rows of RGB; colours that the file doesn't give are black
    transparency: bytes | None


def open_png(data: bytes) -> tuple[Header, bytes, bytes | None, list[bytes]]:
    """Header, palette, transparency and compressed pixels; all chunks are read and checked."""
    header, palette, transparency, packed = None, b"", None, []
    for kind, body in png_chunks(data):
        if header is None:
            if kind != b"IHDR":
                raise ImageError("bad header")
            header = png_header(body)
        elif kind == b"PLTE":
            palette = body
        elif kind == b"tRNS":
            transparency = body
        elif kind == b"IDAT":
            packed.append(body)
    if header is None or not packed or (header.colour == 3 and not palette) or len(palette) % 3 or len(palette) > 768:
        raise ImageError("missing parts")
    return header, palette, transparency, packed


def inflated(packed: list[bytes], size: int, block: int = 1 << 20) -> Iterator[bytes]:
    """The first size bytes of the compressed pixels, in blocks."""
    stream, left = zlib.decompressobj(), size
    for part in packed:
        while part and left:
            try:
                made = stream.decompress(part, min(block, left))
            except zlib.error:
                raise ImageError("bad compression") from None
            part, left = stream.unconsumed_tail, left - len(made)
            yield made
    if left:
        raise ImageError("truncated")


def decode_png(data: bytes) -> Png:
    header, colours, transparency, packed = open_png(data)
    raw, at = np.frombuffer(b"".join(inflated(packed, header.inflated())), dtype=np.uint8), 0
    samples = np.zeros((header.height, header.width, _CHANNELS[header.colour]), dtype=np.uint16 if header.depth == 16 else np.uint8)
    step = max(1, _CHANNELS[header.colour] * header.depth // 8)
    for width, height, x, y, dx, dy in header.passes():
        size = (header.row_bytes(width) + 1) * height
        rows = unfiltered(raw[at : at + size].reshape(height, -1), step)
        samples[y::dy, x::dx] = _samples(rows, width, header)
        at += size
    palette = np.zeros((256, 3), dtype=np.uint8)
    palette[: len(colours) // 3] = np.frombuffer(colours, dtype=np.uint8).reshape(-1, 3)
    return Png(header, samples, palette, transparency)


def usual_pixels(image: Png) -> tuple[str, np.ndarray]:
    """(mode, pixels of 8 bits) of modes that any reader takes.

    Palettes become RGB, or RGBA if they have transparency; grey with alpha becomes RGBA; grey of 16 bits RGB, clipped at 255; other
    channels of 16 bits keep their high byte; grey of 1 bit is L with 0 and 255, and of 2 and 4 bits is spread over 8.
    """
    samples, depth, mode = image.samples, image.header.depth, image.header.mode
    if mode == "P":
        index = samples[:, :, 0]
        rgb = image.palette[index]
        if image.transparency is None:
            return "RGB", rgb
        alpha = np.full(256, 255, dtype=np.uint8)
        alpha[: len(image.transparency)] = np.frombuffer(image.transparency, dtype=np.uint8)[:256]
        return "RGBA", np.dstack([rgb, alpha[index]])
    if mode == "I;16":
        return "RGB", np.repeat(np.minimum(samples, 255).astype(np.uint8), 3, axis=2)
    if depth == 16:
        samples = (samples >> 8).astype(np.uint8)
    elif depth < 8:
        samples = samples * (255 // ((1 << depth) - 1))
    if mode == "LA":
        return "RGBA", np.dstack([samples[:, :, 0]] * 3 + [samples[:, :, 1]])
    return "L" if mode == "1" else mode, samples.astype(np.uint8)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def encode_png(pixels: np.ndarray, level: int = 6) -> bytes:
    """A PNG of pixels (height, width, 1 to 4 channels of 8 bits); each row gets the filter with the smallest differences."""
    height, width, channels = pixels.shape
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    stream, out = zlib.compressobj(level), []
    above = np.zeros(width * channels, dtype=np.uint8)
    for row in pixels.reshape(height, -1):
        left, corner = (np.append(np.zeros(channels, dtype=np.uint8), v[:-channels]).astype(np.int16) for v in (row, above))
        up = above.astype(np.int16)
        guess = left + up - corner
        off_left, off_up, off_corner = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
        paeth = np.where((off_left <= off_up) & (off_left <= off_corner), left, np.where(off_up <= off_corner, up, corner))
        tried = [row - by.astype(np.uint8) for by in (np.zeros_like(left), left, up, (left + up) // 2, paeth)]
        best = min(range(5), key=lambda k: int(np.abs(tried[k].view(np.int8).astype(np.int16)).sum()))
        out.append(stream.compress(bytes([best]) + tried[best].tobytes()))
        above = row
    packed = b"".join(out) + stream.flush()
    return PNG_MAGIC + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + _chunk(b"IDAT", packed) + _chunk(b"IEND", b"")


def usual_png(data: bytes) -> tuple[bytes, int, int]:
    """A PNG in a mode that any reader takes, its width and its height; the same bytes if it is in one."""
    image = decode_png(data)
    if image.header.mode in ("1", "L", "RGB", "RGBA"):
        return data, image.header.width, image.header.height
    return encode_png(usual_pixels(image)[1]), image.header.width, image.header.height


def check_png(data: bytes) -> None:
    """All chunks, then the pixels by blocks: as many as the header asks for, each row with a filter that exists."""
    header, _, _, packed = open_png(data)
    rows = [(header.row_bytes(w) + 1, (header.row_bytes(w) + 1) * h) for w, h, *_ in header.passes()]
    stride, end = rows.pop(0)
    at = begin = 0  # bytes so far, and where the pass began
    for made in inflated(packed, header.inflated()):
        block = np.frombuffer(made, dtype=np.uint8)
        while len(block):
            part = block[: end - at]
            if part[(begin - at) % stride :: stride].max(initial=0) > 4:
                raise ImageError("bad filter")
            at, block = at + len(part), block[len(part) :]
            if at == end and rows:
                begin, (stride, size) = at, rows.pop(0)
                end = at + size


def _check_tables(body: bytes) -> set[tuple[int, int]]:
    """(class, number) of a segment's Huffman tables."""
    found, at = set(), 0
    while at < len(body):
        counts = body[at + 1 : at + 17]
        codes, room = sum(counts), 0
        for k, n in enumerate(counts):
            room += n << (15 - k)
        if len(counts) < 16 or codes > 256 or room > 1 << 16 or at + 17 + codes > len(body) or body[at] >> 4 > 1 or body[at] & 15 > 3:
            raise ImageError("bad table")
        found.add((body[at] >> 4, body[at] & 15))
        at += 17 + codes
    return found


def check_jpeg(data: bytes) -> None:
    """Walk the segments and the coded data of every scan to the end marker; tables and components must be there before a scan uses them."""
    if data[:2] != JPEG_MAGIC:
        raise ImageError("not a JPEG")
    at, quantisers, components, scans, progressive, arithmetic = 2, set(), {}, 0, False, False
    tables = {(0, 0), (0, 1), (1, 0), (1, 1)}  # decoders have these by default
    while True:
        while data[at : at + 2] == b"\xff\xff":
            at += 1
        if at + 2 > len(data):
            raise ImageError("truncated")
        if data[at] != 0xFF:
            raise ImageError("bad marker")
        kind = data[at + 1]
        at += 2
        if kind == 0xD9:
            if not scans:
                raise ImageError("missing parts")
            return
        if kind == 0x01 or 0xD0 <= kind <= 0xD7:
            continue
        if at + 2 > len(data):
            raise ImageError("truncated")
        size = struct.unpack(">H", data[at : at + 2])[0]
        if size < 2:
            raise ImageError("bad marker")
        if at + size > len(data):
            raise ImageError("truncated")
        body = data[at + 2 : at + size]
        at += size
        if kind == 0xC4:
            tables |= _check_tables(body)
        elif kind == 0xDB:
            k = 0
            while k < len(body):
                if body[k] >> 4 > 1 or body[k] & 15 > 3 or k + 65 + 64 * (body[k] >> 4) > len(body):
                    raise ImageError("bad table")
                quantisers.add(body[k] & 15)
                k += 65 + 64 * (body[k] >> 4)
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            if components or len(body) < 6 or len(body) != 6 + 3 * body[5] or not body[5]:
                raise ImageError("bad header")
            height, width = struct.unpack(">HH", body[1:5])
            if not width or not height or kind in (0xC3, 0xC5, 0xC6, 0xC7, 0xCB, 0xCD, 0xCE, 0xCF):
                raise ImageError("bad header")
            if width * height > MOST_PIXELS:
                raise ImageError("too large")
            components = {body[6 + 3 * k]: body[8 + 3 * k] for k in range(body[5])}
            progressive, arithmetic = kind in (0xC2, 0xCA), kind >= 0xC9
        elif kind == 0xDA:
            n = body[0] if body else 0
            if not 1 <= n <= 4 or len(body) != 4 + 2 * n or not components:
                raise ImageError("bad scan")
            first, last, passes = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n]
            for k in range(n):
                part, used = body[1 + 2 * k], body[2 + 2 * k]
                needs = {(0, used >> 4)} if first == 0 and not (progressive and passes >> 4) else set()
                needs |= {(1, used & 15)} if last > 0 else set()
                if part not in components or components[part] not in quantisers or (not arithmetic and not needs <= tables):
                    raise ImageError("bad scan")
            at = _skip_coded(data, at)
            scans += 1


def _skip_coded(data: bytes, at: int) -> int:
    """The place of the marker behind coded data, in which FF is stuffed with 00 and restart markers count up."""
    begun, nth = at, None
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            raise ImageError("truncated")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind == 0:
            at += 2
        elif 0xD0 <= kind <= 0xD7:
            if nth is not None and kind - 0xD0 != (nth + 1) % 8:
                raise ImageError("bad restart")
            nth, at = kind - 0xD0, at + 2
        elif at == begun:
            raise ImageError("truncated")
        else:
            return at


def problem(data: bytes | None) -> str | None:
    """Why a file can't be decoded: "empty", "unknown format", or what is wrong with a PNG or JPEG; None if it is whole."""
    if not data:
        return "empty"
    try:
        if data[:8] == PNG_MAGIC:
            check_png(data)
        elif data[:2] == JPEG_MAGIC:
            check_jpeg(data)
        else:
            return "unknown format"
    except ImageError as e:
        return str(e)
    return None
