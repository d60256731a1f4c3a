"""Cameras and 3-D boxes: parsing, corners, projection, edges; all native expressions."""

from __future__ import annotations

import ast
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs of the eight corners in order, and the twelve edges between them.
CORNERS = ((-1, -1, -1), (1, -1, -1), (1, 1, -1), (-1, 1, -1), (-1, -1, 1), (1, -1, 1), (1, 1, 1), (-1, 1, 1))
EDGES = ((0, 1), (1, 2), (2, 3), (3, 0), (4, 5), (5, 6), (6, 7), (7, 4), (0, 4), (1, 5), (2, 6), (3, 7))
NEAR = 1e-4
_BOXES = "array<struct<label:string,bbox_3d:array<double>>>"


def camera(text: Column) -> Column:
    """Struct hfov, vfov, width, height from the first number after each name; null unless all are there."""
    # fixed value: names and forms of the numbers
    number = {"hfov": r"([0-9]+(?:\.[0-9]+)?)", "vfov": r"([0-9]+(?:\.[0-9]+)?)", "width": "([0-9]+)", "height": "([0-9]+)"}
    found = {k: F.regexp_extract(text, rf"(?i){k}\s*=\s*{p}", 1).try_cast("double") for k, p in number.items()}
    complete = [v.isNotNull() for v in found.values()]
    return F.when(complete[0] & complete[1] & complete[2] & complete[3], F.struct(*[v.alias(k) for k, v in found.items()]))


def _item(item: object) -> dict | None:
    """One box: its label and its first nine numbers."""
    values = item.get("bbox_3d") if isinstance(item, dict) else None
    if not isinstance(values, list) or len(values) < 9:
        return None
    try:
        return {"label": str(item.get("label") or "object"), "bbox_3d": [float(v) for v in values[:9]]}
    except (TypeError, ValueError, OverflowError):
        return None


def parse_boxes(text: str | None) -> list[dict]:
    """The boxes of a JSON or else a Python literal, each item judged alone."""
    try:
        made = json.loads(text or "")
    except (ValueError, RecursionError):
        try:
            made = ast.literal_eval(text or "")
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return []
    found = map(_item, [made] if isinstance(made, dict) else made if isinstance(made, list) else [])
    return [x for x in found if x is not None]


def boxes(text: Column, literals: bool = True) -> Column:
    """Array of label and the first nine numbers of each box; a lone object counts as a list; label object if none.

    Arrays of objects with labels in quotes and plain numbers are read natively. literals: the rest (Python literals, items that
    are no objects, other labels, numbers in quotes, true and null) goes to parse_boxes.
    """
    read = F.from_json(text, _BOXES.replace("double", "string"))
    parsed = F.transform(read, lambda b: F.struct(b["label"].alias("label"), F.transform(b["bbox_3d"], lambda v: v.try_cast("double")).alias("bbox_3d")))
    if literals:
        odd = F.rlike(text, F.lit(r'"label"\s*:\s*[^"\s]')) | F.rlike(text, F.lit(r'"bbox_3d"\s*:\s*\[[^\]]*[^-+0-9eE.,\s\]]')) | F.rlike(text, F.lit("[0-9]{300}"))
        left = F.when(parsed.isNull() | odd, text)
        parsed = F.when(left.isNotNull(), F.pandas_udf(lambda s: s.map(lambda x: None if x is None else parse_boxes(x)), _BOXES)(left)).otherwise(parsed)
    whole = F.filter(F.coalesce(parsed, F.array().cast(_BOXES)), lambda b: (F.size(b["bbox_3d"]) >= 9) & F.forall(F.slice(b["bbox_3d"], 1, 9), lambda v: v.isNotNull()))
    return F.transform(whole, lambda b: F.struct(F.coalesce(F.when(b["label"] != "", b["label"]), F.lit("object")).alias("label"), F.slice(b["bbox_3d"], 1, 9).alias("bbox_3d")))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once for the row."""
    return F.get(F.transform(F.array(value), body), 0)


def rotation(angles: Column) -> Column:
    """Ry(yaw) Rx(pitch) Rz(roll) as an array of rows, for a struct roll, pitch, yaw."""
    waves = F.struct(*[f(angles[n]).alias(f"{k}{a}") for k, f in (("c", F.cos), ("s", F.sin)) for a, n in (("x", "pitch"), ("y", "yaw"), ("z", "roll"))])

    def rows(w: Column) -> Column:
        cx, cy, cz, sx, sy, sz = (w[k] for k in ("cx", "cy", "cz", "sx", "sy", "sz"))
        return F.array(
            F.array(cy * cz + sy * sx * sz, sy * sx * cz - cy * sz, sy * cx),
            F.array(cx * sz, cx * cz, -sx),
            F.array(cy * sx * sz - sy * cz, sy * sz + cy * sx * cz, cy * cx),
        )

    return _let(waves, rows)


def corners(box: Column) -> Column:
    """The eight corners (x, y, z) of a box: centre, size, roll, pitch, yaw."""
    at = [F.get(box, i) for i in range(9)]
    signs = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in CORNERS])

    def turned(r: Column) -> Column:
        def corner(s: Column) -> Column:
            local = [at[3 + k] / 2 * F.get(s, k) for k in range(3)]
            moved = [at[i] + sum((F.get(F.get(r, i), k) * local[k] for k in range(1, 3)), F.get(F.get(r, i), 0) * local[0]) for i in range(3)]
            return F.struct(*[m.alias(n) for m, n in zip(moved, "xyz", strict=True)])

        return F.transform(signs, corner)

    return _let(rotation(F.struct(at[6].alias("roll"), at[7].alias("pitch"), at[8].alias("yaw"))), turned)


def project(point: Column, cam: Column) -> Column:
    """Struct u, v in the image; null at or behind the camera, or where it isn't finite."""
    half = {k: cam[size] / 2 for k, size in (("u", "width"), ("v", "height"))}
    focal = {k: half[k] / F.tan(F.radians(cam[fov]) / 2) for k, fov in (("u", "hfov"), ("v", "vfov"))}
    u, v = (focal[k] * F.try_divide(point[axis], point["z"]) + half[k] for k, axis in (("u", "x"), ("v", "y")))
    finite = ~(F.isnan(u) | F.isnan(v) | (F.abs(u) == float("inf")) | (F.abs(v) == float("inf")))
    return F.when((point["z"] > 1e-6) & finite, F.struct(u.alias("u"), v.alias("v")))


def clip(a: Column, b: Column, near: float = NEAR) -> Column:
    """Struct a, b: the part of a segment with z at least near; null if nothing is left."""
    inside_a, inside_b = a["z"] >= near, b["z"] >= near
    dz = b["z"] - a["z"]

    def cut(start: Column, end: Column) -> Column:
        t = F.try_divide(F.lit(near) - start["z"], end["z"] - start["z"])
        return F.struct(*[(start[k] + t * (end[k] - start[k])).alias(k) for k in "xy"], F.lit(near).alias("z"))

    pair = lambda p, q: F.struct(p.alias("a"), q.alias("b"))
    return F.when(inside_a & inside_b, pair(a, b)).when(~inside_a & ~inside_b, F.lit(None)).when(F.abs(dz) < 1e-12, F.lit(None)).when(~inside_a, pair(cut(a, b), b)).otherwise(pair(a, cut(b, a)))


def edge_segments(points: Column, cam: Column, near: float = NEAR) -> Column:
    """The visible edges as structs edge, a, b with image points, in the order of EDGES."""

    edges = F.array(*[F.struct(F.lit(k).alias("edge"), F.lit(i).alias("i"), F.lit(j).alias("j")) for k, (i, j) in enumerate(EDGES)])

    def edge(e: Column) -> Column:
        def shown(kept: Column) -> Column:
            a, b = project(kept["a"], cam), project(kept["b"], cam)
            return F.when(a.isNotNull() & b.isNotNull(), F.struct(e["edge"].alias("edge"), a.alias("a"), b.alias("b")))

        return _let(clip(F.get(points, e["i"]), F.get(points, e["j"]), near), shown)

    return F.filter(F.transform(edges, edge), lambda e: e.isNotNull())


def label_anchor(segments: Column, box: Column, cam: Column, near: float = NEAR) -> Column:
    """The middle of the first visible edge, else the projected centre."""
    first = F.get(segments, 0)
    centre = F.struct(F.get(box, 0).alias("x"), F.get(box, 1).alias("y"), F.greatest(F.get(box, 2), F.lit(near)).alias("z"))
    middle = F.struct(((first["a"]["u"] + first["b"]["u"]) / 2).alias("u"), ((first["a"]["v"] + first["b"]["v"]) / 2).alias("v"))
    return F.when(first.isNotNull(), middle).otherwise(project(centre, cam))


def overlay(user_text: Column, assistant_text: Column, literals: bool = True) -> Column:
    """Struct camera, boxes for a pair of turns that has both; else null."""
    cam, found = camera(user_text), boxes(assistant_text, literals)
    return F.when(cam.isNotNull() & (F.size(found) > 0), F.struct(cam.alias("camera"), found.alias("boxes")))


