"""The PNG codec against files made here by other means, and the checks of whole PNG and JPEG files."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleprep.functions import binary, images

CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered(row, above, kind, step):
    """One row filtered byte by byte, as the format's text has it."""
    out = bytearray([kind])
    for k, v in enumerate(row):
        a, b, c = (row[k - step] if k >= step else 0), above[k], (above[k - step] if k >= step else 0)
        p = a + b - c
        near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out.append((v - (0, a, b, (a + b) // 2, near)[kind]) % 256)
    return bytes(out)


def packed_rows(values, depth, colour, kinds):
    """Rows of samples as filtered bytes."""
    width = values.shape[1] * CHANNELS[colour]
    above = bytes((width * depth + 7) // 8)
    out = b""
    for y, line in enumerate(values.reshape(len(values), width)):
        bits = "".join(format(int(v), f"0{depth}b") for v in line)
        row = int(bits.ljust(len(above) * 8, "0"), 2).to_bytes(len(above), "big")
        out += filtered(row, above, kinds[y % len(kinds)], max(1, CHANNELS[colour] * depth // 8))
        above = row
    return out


def png(values, depth, colour, kinds=(0, 1, 2, 3, 4), palette=None, transparency=None, interlaced=False, pieces=1):
    height, width = values.shape[:2]
    if interlaced:
        parts = [values[y::dy, x::dx] for x, y, dx, dy in ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))]
        raw = b"".join(packed_rows(p, depth, colour, kinds) for p in parts if p.size)
    else:
        raw = packed_rows(values, depth, colour, kinds)
    body = zlib.compress(raw)
    cut = -(-len(body) // pieces)
    made = images.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, interlaced))
    made += chunk(b"PLTE", palette) if palette else b""
    made += chunk(b"tRNS", transparency) if transparency else b""
    return made + b"".join(chunk(b"IDAT", body[k : k + cut]) for k in range(0, len(body), cut)) + chunk(b"IEND", b"")


def jpeg(width=640, height=480, restart=False, progressive=False):
    """A grey JPEG whose blocks are all zero."""
    blocks = -(-width // 8) * -(-height // 8)
    coded = b"\x00" * (-(-blocks * 2 // 8)) if not restart else b"\x3f\xff\xd0\x3f\xff\xd1\x3f\xff\x00"
    table = lambda k: b"\xff\xc4" + struct.pack(">H", 20) + bytes([k, 1]) + bytes(15) + b"\x00"
    head = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xdb\x00\x43\x00" + b"\x01" * 64
    frame = (b"\xff\xc2" if progressive else b"\xff\xc0") + b"\x00\x0b\x08" + struct.pack(">HH", height, width) + b"\x01\x01\x11\x00"
    scans = b"".join(b"\xff\xda\x00\x08\x01\x01\x00" + s + coded for s in ([b"\x00\x00\x00", b"\x01\x3f\x00"] if progressive else [b"\x00\x3f\x00"]))
    return head + frame + table(0) + table(16) + scans + b"\xff\xd9"


RNG = np.random.default_rng(4)
KINDS = [(d, c) for c, depths in images._DEPTHS.items() for d in depths]


@pytest.mark.parametrize("depth, colour", KINDS)
@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (9, 17), (16, 8)])
@pytest.mark.parametrize("interlaced", [False, True])
def test_decoded_samples(depth, colour, shape, interlaced):
    values = RNG.integers(0, 1 << depth, (*shape, CHANNELS[colour]))
    palette = RNG.integers(0, 256, 3 * (1 << min(depth, 8)), dtype=np.uint8).tobytes() if colour == 3 else None
    for kinds in ((0, 1, 2, 3, 4), (1, 2, 0), (4,)):
        data = png(values, depth, colour, kinds, palette, interlaced=interlaced, pieces=3)
        assert (images.decode_png(data).samples == values).all()
        assert images.problem(data) is None


def test_usual_pixels():
    grey = RNG.integers(0, 256, (4, 6, 1))
    palette = bytes(range(9))
    index = RNG.integers(0, 4, (4, 6, 1))
    rgb = np.array([[0, 1, 2], [3, 4, 5], [6, 7, 8], [0, 0, 0]])[index[:, :, 0]]
    seen = lambda data: (lambda m, p: (m, p.tolist()))(*images.usual_pixels(images.decode_png(data)))
    assert seen(png(index, 2, 3, palette=palette)) == ("RGB", rgb.tolist())
    alpha = np.array([7, 255, 255, 255])[index]
    assert seen(png(index, 8, 3, palette=palette, transparency=b"\x07")) == ("RGBA", np.dstack([rgb, alpha]).tolist())
    both = np.dstack([grey, 255 - grey])
    assert seen(png(both, 8, 4)) == ("RGBA", np.dstack([grey] * 3 + [255 - grey]).tolist())
    assert seen(png(both * 256 + 9, 16, 4)) == ("RGBA", np.dstack([grey] * 3 + [255 - grey]).tolist())
    deep = RNG.integers(0, 600, (4, 6, 1))
    assert seen(png(deep, 16, 0)) == ("RGB", np.dstack([np.minimum(deep, 255)] * 3).tolist())
    assert seen(png(index, 2, 0)) == ("L", (index * 85).tolist())
    assert seen(png(index % 2, 1, 0)) == ("L", (index % 2 * 255).tolist())
    assert seen(png(np.dstack([grey * 257] * 3), 16, 2)) == ("RGB", np.dstack([grey] * 3).tolist())


def test_usual_png_keeps_pixels_and_usual_files():
    for depth, colour, same in ((8, 2, True), (16, 2, True), (8, 6, True), (4, 0, True), (1, 0, True), (8, 4, False), (16, 4, False), (16, 0, False), (8, 3, False)):
        data = png(RNG.integers(0, 1 << depth, (11, 7, CHANNELS[colour])), depth, colour, palette=bytes(range(256)) * 3 if colour == 3 else None)
        made, width, height = images.usual_png(data)
        assert (width, height) == (7, 11) and (made == data) == same
        assert images.usual_pixels(images.decode_png(made))[1].tolist() == images.usual_pixels(images.decode_png(data))[1].tolist()


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_encoded_pixels_come_back(channels):
    for shape in ((1, 1), (5, 9), (40, 33)):
        pixels = RNG.integers(0, 256, (*shape, channels), dtype=np.uint8)
        assert (images.decode_png(images.encode_png(pixels)).samples == pixels).all()
    smooth = np.add.outer(np.arange(200), np.arange(300)).astype(np.uint8)[:, :, None].repeat(channels, axis=2)
    assert len(images.encode_png(smooth)) < smooth.size // 20


def test_large_images_are_quick():
    import time

    began = time.time()
    pixels = RNG.integers(0, 256, (1500, 1500, 3), dtype=np.uint8)
    raw = np.concatenate([np.full((1500, 1), 4, dtype=np.uint8), pixels.reshape(1500, -1)], axis=1)
    images.unfiltered(raw, 3)
    assert time.time() - began < 10


def test_defects_of_png():
    data = png(RNG.integers(0, 256, (20, 30, 3)), 8, 2)
    at = data.index(b"IDAT")
    flip = lambda k: data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :]
    assert images.problem(data) is None and images.problem(data + b"more") is None
    assert images.problem(None) == images.problem(b"") == "empty" and images.problem(b"GIF89a") == "unknown format"
    assert [images.problem(data[:k]) for k in (12, at, at + 50, len(data) - 13, len(data) - 1)] == ["truncated"] * 5
    assert [images.problem(flip(k)) for k in (17, at + 9, data.index(b"IEND") - 5)] == ["bad checksum"] * 3
    head = lambda *h: images.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", *h)) + data[data.index(b"IDAT") - 4 :]
    assert images.problem(head(30, 20, 8, 2, 0, 0, 0)) is None
    assert [images.problem(head(*h)) for h in ((0, 20, 8, 2, 0, 0, 0), (30, 20, 3, 2, 0, 0, 0), (30, 20, 8, 5, 0, 0, 0), (30, 20, 8, 2, 1, 0, 0))] == ["bad header"] * 4
    assert images.problem(head(30, 21, 8, 2, 0, 0, 0)) == "truncated" and images.problem(head(1 << 30, 1 << 30, 8, 2, 0, 0, 0)) == "too large"
    assert images.problem(head(30, 20, 8, 3, 0, 0, 0)) == "missing parts"
    body = lambda raw: data[: data.index(b"IDAT") - 4] + chunk(b"IDAT", raw) + chunk(b"IEND", b"")
    assert images.problem(body(b"no zlib stream")) == "bad compression"
    assert images.problem(body(zlib.compress(bytes([9]) + bytes(90) + bytes(91 * 19)))) == "bad filter"
    assert images.problem(body(zlib.compress(bytes(91 * 20) + b"more"))) is None


def test_rows_across_blocks(monkeypatch):
    """A filter byte is found wherever a block ends."""
    for bad in (0, 1, 7, 19):
        rows = np.zeros((20, 91), dtype=np.uint8)
        rows[bad, 0] = 5
        data = images.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", 30, 20, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")
        whole = images.inflated
        for block in (1, 90, 91, 92, 1000):
            monkeypatch.setattr(images, "inflated", lambda packed, size, block=block: whole(packed, size, block))
            assert images.problem(data) == "bad filter"
        monkeypatch.undo()


def test_defects_of_jpeg():
    data = jpeg()
    assert images.problem(data) is None and images.problem(jpeg(24, 8, restart=True)) is None and images.problem(jpeg(progressive=True)) is None
    assert images.problem(data + b"behind the end") is None
    scan = data.index(b"\xff\xda")
    assert [images.problem(data[:k]) for k in (3, 40, scan, scan + 5, scan + 40, len(data) - 2, len(data) - 1)] == ["truncated"] * 7
    assert images.problem(data[:scan] + b"\xff\xd9") == "missing parts"
    assert images.problem(data[: scan + 10] + b"\xff\xd9") == "truncated"
    assert images.problem(data.replace(b"\x01\x01\x11\x00", b"\x01\x01\x11\x02")) == "bad scan"
    assert images.problem(data.replace(b"\xff\xda\x00\x08\x01\x01\x00", b"\xff\xda\x00\x08\x01\x09\x00")) == "bad scan"
    assert images.problem(data.replace(struct.pack(">HH", 480, 640), struct.pack(">HH", 0, 640))) == "bad header"
    assert images.problem(data.replace(b"\xff\xc4\x00\x14\x00\x01", b"\xff\xc4\x00\x14\x00\x09")) == "bad table"
    assert images.problem(jpeg(24, 8, restart=True).replace(b"\xff\xd1", b"\xff\xd5")) == "bad restart"
    assert images.problem(data.replace(b"ab\xff\xdb", b"abX\xdb")) == "bad marker"


def test_columns(spark):
    odd = png(np.array([[[0], [1]], [[2], [0]]]), 8, 3, palette=bytes([9, 8, 7, 6, 5, 4, 3, 2, 1]), transparency=b"\x80")
    data = [odd, odd[:-20], jpeg(), jpeg()[:-9], b"BM raw", b"", None]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(data)], "k int, d binary")
    rows = df.select("k", binary.defect(F.col("d")).alias("defect"), binary.readable(F.col("d")).alias("readable"), binary.pixels(F.col("d")).alias("x"), binary.geometry(F.col("d")).alias("g")).orderBy("k").collect()
    assert [r.defect for r in rows] == [None, "truncated", None, "truncated", "unknown format", "empty", "empty"]
    assert [r.readable for r in rows] == [True, False, True, False, False, False, False]
    assert (rows[0].x.mode, rows[0].x.width, bytes(rows[0].x.pixels)) == ("RGBA", 2, bytes([9, 8, 7, 128, 6, 5, 4, 255, 3, 2, 1, 255, 9, 8, 7, 128]))
    assert [r.x for r in rows[1:]] == [None] * 6
    assert [r.g and (r.g.format, r.g.width, r.g.height) for r in rows] == [("image/png", 2, 2), ("image/png", -1, -1), ("image/jpeg", 640, 480), ("image/jpeg", 640, 480), ("image/jpeg", -1, -1), ("image/jpeg", -1, -1), None]
    assert images.decode_png(bytes(rows[0].g.payload)).header.mode == "RGBA" and bytes(rows[1].g.payload) == odd[:-20]
