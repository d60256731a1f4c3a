"""Image payloads: base64, shapes of image columns, headers of PNG and JPEG, re-encoding of odd PNGs, checks of whole files."""

from __future__ import annotations

import struct
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.functions import images

PNG, JPEG = "image/png", "image/jpeg"
IMAGE = "struct<format:string,width:int,height:int,payload:binary>"
PIXELS = "struct<mode:string,width:int,height:int,pixels:binary>"
_PNG_MAGIC, _JPEG_MAGIC = images.PNG_MAGIC, images.JPEG_MAGIC


def decode_base64(text: Column, data_url: bool = False) -> Column:
    """The bytes of a base64 string, other characters skipped; null where digits are left over.

    Padding that completes four places ends the data, whatever follows; other padding is skipped. data_url: an image data-URL's
    head is taken off first.
    """
    if data_url:
        text = F.regexp_replace(F.btrim(text), r"(?i)\Adata:image/[^;]+;base64,", "")
    digits = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    size, first = F.length(digits), F.instr(digits, "=")
    usual = (size % 4 == 0) & ((first == 0) | (first >= size - 1))
    # the digits stand between paddings; only these are walked
    parts = F.split(digits, "=")
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(0).alias("pads"), F.lit(False).alias("done"))

    def walk(state: Column, part: Column) -> Column:
        n = state["n"] + F.length(part)
        pads = F.when(n % 4 < 2, 0).otherwise(F.when(F.length(part) > 0, 1).otherwise(state["pads"] + 1))
        on = F.struct(n.alias("n"), (state["used"] + 1).alias("used"), pads.alias("pads"), (n % 4 + pads >= 4).alias("done"))
        return F.when(state["done"], state).otherwise(on)

    # behind the last part stands no padding
    ended = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, walk)
    rest = F.when(ended["done"], F.lit("")).otherwise(F.element_at(parts, -1))
    data = F.concat(F.array_join(F.slice(parts, 1, ended["used"]), ""), rest)
    over = F.length(data) % 4
    padded = F.when(ended["done"], F.concat(data, F.repeat(F.lit("="), 4 - over))).when(over == 0, data)
    return F.when(usual, F.try_to_binary(digits, F.lit("base64"))).otherwise(F.try_to_binary(padded, F.lit("base64")))


def payload(value: Column, kind: T.DataType, data_url: bool = False) -> Column:
    """The bytes of one image slot, by the column's type: binary, base64 string, or a struct with bytes; empty is null."""
    if isinstance(kind, T.StructType):
        return payload(value["bytes"], kind["bytes"].dataType, data_url) if "bytes" in kind.names else F.lit(None).cast("binary")
    if isinstance(kind, T.BinaryType):
        return F.when(F.octet_length(value) > 0, value)
    if isinstance(kind, T.StringType):
        return F.when(value != "", decode_base64(value, data_url))
    return F.lit(None).cast("binary")


def image_shape(images: Column, kind: T.DataType) -> tuple[Column, Column]:
    """(slots, shape): the type decides but for nulls and blanks."""
    zero = F.lit(0)
    if isinstance(kind, T.StringType):
        blank = images.isNull() | (F.btrim(images) == "")
        return F.when(blank, 0).otherwise(1), F.when(blank, "unsupported").otherwise("single_base64_string")
    if not isinstance(kind, T.ArrayType):
        return zero, F.lit("unsupported")
    names = {T.StructType: "list_of_dict", T.StringType: "list_of_base64_strings", T.BinaryType: "list_of_bytes"}
    shape = next((n for t, n in names.items() if isinstance(kind.elementType, t)), "list_mixed_or_unknown")
    first = F.when(F.get(images, 0).isNull(), "list_mixed_or_unknown").otherwise(shape)
    return F.coalesce(F.size(images), zero), F.when(images.isNull(), "unsupported").when(F.size(images) == 0, "empty_list").otherwise(first)


def _number(data: Column, at: int, n: int) -> Column:
    return F.conv(F.hex(F.substring(data, at, n)), 16, 10).cast("long")


def png_header(data: Column) -> Column:
    """Struct width, height, mode of a PNG, without decoding; null for other data. The mode is null if it can't pass as it is."""
    is_png = (F.substring(data, 1, 8) == F.lit(_PNG_MAGIC)) & (F.substring(data, 13, 4) == F.lit(b"IHDR"))
    depth, colour = _number(data, 25, 1), _number(data, 26, 1)
    mode = F.when((colour == 2) & depth.isin(8, 16), "RGB").when((colour == 6) & depth.isin(8, 16), "RGBA").when((colour == 0) & depth.isin(2, 4, 8), "L").when((colour == 0) & (depth == 1), "1")
    return F.when(is_png & (F.octet_length(data) >= 26), F.struct(_number(data, 17, 4).cast("int").alias("width"), _number(data, 21, 4).cast("int").alias("height"), mode.alias("mode")))


def jpeg_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) from the first frame header."""
    if not data or data[:2] != _JPEG_MAGIC:
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF or kind == 0x01 or 0xD0 <= kind <= 0xD8:
            at += 1 if kind == 0xFF else 2
            continue
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


#: For images that can't pass as they are: bytes to (bytes, MIME type, width, height); raises what it likes if it can't.
Encoder = Callable[[bytes], tuple[bytes, str, int, int]]


def _is_png(data: Column) -> Column:
    return F.substring(data, 1, 8) == F.lit(_PNG_MAGIC)


def _image_reader(encode: Encoder | None) -> Callable[[pa.Array], pa.Array]:
    kind = pa.list_(pa.struct([("format", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("payload", pa.binary())]))

    def image(data: bytes | None) -> dict | None:
        if data is None:
            return None
        size = jpeg_size(data)
        if size is not None:
            return {"width": size[0], "height": size[1]}
        try:
            if data[:8] == _PNG_MAGIC:
                made, *size = images.usual_png(data)
                return {"format": PNG, "width": size[0], "height": size[1], "payload": made}
        except images.ImageError:
            pass  # encode may know better
        try:
            if encode is not None:
                made, mime, *size = encode(data)
                return {"format": mime, "width": size[0], "height": size[1], "payload": made}
        except Exception:  # whatever an encoder raises, the bytes pass as they are
            pass
        return {"width": -1, "height": -1}

    def read(rows: pa.Array) -> pa.Array:
        return pa.array(([image(x.as_py()) for x in row.values] if row.is_valid else None for row in rows), kind, size=len(rows))

    return read


def encoded(payloads: Column, encode: Encoder | None = None) -> Column:
    """Array of format, width, height, payload for an array of payloads, null where there is none.

    JPEGs and PNGs of the usual modes pass as they are, by their headers. PNGs of other modes (palette, grey with alpha, grey of 16 bits)
    are written anew as RGB or RGBA. What is neither goes to encode; without one, or where it fails, the bytes pass with a size of -1.
    """
    usual = lambda p: F.coalesce(png_header(p)["mode"].isNotNull(), F.lit(False))
    asked = lambda p: ~usual(p) if encode is not None else (F.substring(p, 1, 2) == F.lit(_JPEG_MAGIC)) | (_is_png(p) & ~usual(p))
    read = F.arrow_udf(_image_reader(encode), f"array<{IMAGE}>")(F.transform(payloads, lambda p: F.when(asked(p), p)))

    def image(p: Column, r: Column) -> Column:
        png = png_header(p)
        sizes = [F.coalesce(r[k], F.when(png["mode"].isNotNull(), png[k]), F.lit(-1)).alias(k) for k in ("width", "height")]
        form = F.coalesce(r["format"], F.when(_is_png(p), PNG).otherwise(JPEG))
        return F.when(p.isNotNull(), F.struct(form.alias("format"), *sizes, F.coalesce(r["payload"], p).alias("payload")))

    return F.zip_with(payloads, read, image)


def geometry(data: Column) -> Column:
    """Struct format, width, height (and the payload) of an encoded image: PNG natively, JPEG by its frame header; -1 where unknown."""
    return F.get(encoded(F.array(data)), 0)


def defect(data: Column) -> Column:
    """Why a payload can't be decoded ("empty", "truncated", "bad checksum" and others); null if it is a whole PNG or JPEG.

    A PNG is inflated, with all checksums held; of a JPEG the tables and the coded data of all scans are walked to the end.
    """
    return F.arrow_udf(lambda rows: pa.array((images.problem(x.as_py()) for x in rows), pa.string(), size=len(rows)), "string")(data)


def readable(data: Column, decodes: Callable[[bytes], bool] | None = None) -> Column:
    """True if the payload is a whole PNG or JPEG, or if decodes, a caller's decoder for all formats, says so."""
    if decodes is None:
        return defect(data).isNull()

    def decode(rows: pa.Array) -> pa.Array:
        def fine(payload: bytes | None) -> bool:
            try:
                return bool(payload) and bool(decodes(payload))
            except Exception:  # a decoder may raise for what it can't read
                return False

        return pa.array((fine(x.as_py()) for x in rows), pa.bool_(), size=len(rows))

    return F.arrow_udf(decode, "boolean")(data)


def pixels(data: Column) -> Column:
    """Struct mode (L, RGB or RGBA), width, height and pixels (rows from the top, a byte for each channel) of a PNG; null if it can't be decoded."""
    kind = pa.struct([("mode", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary())])

    def one(payload: bytes | None) -> dict | None:
        try:
            mode, found = images.usual_pixels(images.decode_png(payload or b""))
        except images.ImageError:
            return None
        return {"mode": mode, "width": found.shape[1], "height": found.shape[0], "pixels": found.tobytes()}

    return F.arrow_udf(lambda rows: pa.array((one(x.as_py()) for x in rows), kind, size=len(rows)), PIXELS)(data)
