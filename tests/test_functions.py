"""Expressions against plain Python on edge cases."""

import base64
import math
import re

import pytest
from pyspark.sql import functions as F

from sampleprep.functions import binary, classify, geom3d
from sampleprep.functions import text as t
from sampleprep.operators import nested, shards, stats

TOKEN = re.compile(r"\s*(?:<\|image(?:_pad)?\|>|<image(?:_pad)?(?:\s[^>]*)?>)\s*", re.IGNORECASE)
TEXTS = [
    "", "plain", "<image>", "a <image> b", "A<IMAGE>\n\nB", "<image_pad  x=1>q", "<|image|><|image_pad|>", "x <images> </image> y", "\xa0<image>\x1cz", "a\r\nb\rc \t d", "   lead",
    "t1 <image>  <|image|> t2", "<image> only after", "before <image>", "\x85x　", "line one \n  line two  \n\n", "v\x0bt\x0cf",
]


def values(spark, texts, *columns):
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def python_clean(x):
    lines = x.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return "\n".join(re.sub(r"[ \t\f\v]+", " ", line).strip() for line in lines).strip()


def test_token_expressions(spark):
    s = F.col("s")
    got = values(spark, TEXTS, t.normalise_question(s), t.strip_tokens(s), t.chunks(s), t.strip(s))
    want = [(re.sub(r"\s+", " ", TOKEN.sub(" ", x)).strip().lower(), python_clean(TOKEN.sub(" ", x)), TOKEN.split(x), x.strip()) for x in TEXTS]
    assert got == want


def test_layout(spark):
    def plain(x):
        parts = [c.strip() for c in TOKEN.split(x)]
        lead, between = len(parts) > 1 and bool(parts[0]), any(parts[1:-1])
        return (lead or between, len(parts) - 1, lead, between)

    assert [tuple(r) for r in values(spark, TEXTS, t.layout(F.col("s")))] == [plain(x) for x in TEXTS]


@pytest.mark.parametrize("raw, want", [("Matterpot 3D", "matterport3d"), ("ego_exo4d", "Ego-Exo4D"), ("  Own ", "Own"), ("", "unknown_source"), (None, "unknown_source"), ("  ", "unknown_source")])
def test_sources(spark, raw, want):
    assert values(spark, [raw], t.normalise_source(F.col("s"))) == [want]


@pytest.mark.parametrize("raw, want", [("a/b c", "a_b_c_07.png"), ("..x_", "x_07.png"), ("///", "sample_07.png")])
def test_member_names(spark, raw, want):
    assert values(spark, [raw], t.member_name(F.col("s"), F.lit(7), F.lit("image/png"))) == [want]
    assert values(spark, ["q"], t.member_name(F.col("s"), F.lit(123), F.lit("image/jpeg"))) == ["q_123.jpg"]


def test_id_sources(spark):
    assert values(spark, ["a__b", "foo___x", "none", "__x"], t.source_of_id(F.col("s"))) == ["a", "foo", "unknown_source", ""]


QUESTIONS = [
    ("Can you find the lamp from image 1 in image 2?", 2, "correspondence.multi_view"),
    ("If the lamp is left of the bed in image 1, what direction is the desk (visible in image 2) from the bed?", 2, "position.multi_view"),
    ("Create comprehensive spatial relationship descriptions that capture every observable detail in 100-200 words.", 1, "3d_scene_caption.single_view"),
    ("From the multi-view objects a, b, identify the one farthest from c.", 2, "distance.multi_view"),
    ("Given two different views, Is the cup bigger than the pan?", 2, "size.multi_view"),
    ("<image> Locate the 3D bounding volume for the cup present in the scene.", 1, "grounding_3d.single_view"),
    ("Sort the four objects by depth (from near to far).", 1, "depth.single_view"),
    ("How many cup(s) are there?", 1, "counting.single_view"),
    ("How many cups are there?", 1, "counting.single_view"),
    ("Is the cup bigger than the pan?", 1, "size.single_view"),
    ("What is the distance between the cup and the pan (in meters)?", 1, "distance.single_view"),
    ("What is the distance between the cup and the pan (in meters)?", 2, "distance.multi_view"),
    ("Which of cup and pan is closer to door?", 1, "distance.single_view"),
    ("Looking at the real-world 3D arrangement, which object is positioned lower?", 1, "position.single_view"),
    ("Is it on the left of the door?", 2, "position.multi_view"),
    ("Describe the camera movement.", 1, "camera_motion.multi_view"),
    ("Something else", 1, "position.single_view"),
    ("Something else", 2, "camera_motion.multi_view"),
    ("<image>", 1, "unknown.single_view"),
    ("", 2, "unknown.multi_view"),
]


def test_classification(spark):
    df = spark.createDataFrame([(q, n) for q, n, _ in QUESTIONS], "q string, n int")
    got = [r[0] for r in df.select(classify.infer_category(F.col("q"), F.col("n"))).collect()]
    assert got == [w for *_, w in QUESTIONS]


def test_every_template_finds_its_rule_or_an_earlier_one(spark):
    rules = classify.rules()
    assert len(rules) == 13
    asked = [(i, re.sub(r"\[[A-Z]\]", "thing", q)) for i, (_, _, qs) in enumerate(rules) for q in qs]
    patterns = [re.compile(p) for *_, p in classify.rule_patterns()]
    df = spark.createDataFrame(asked, "i int, q string")
    got = {(r.i, r.q): r[2] for r in df.select("i", "q", classify.infer_category(F.col("q"), F.lit(1))).collect()}
    for i, q in asked:
        first = next(k for k, p in enumerate(patterns) if p.search(" ".join(q.lower().split())))
        assert first <= i
        assert got[i, q].split(".")[0] == rules[first][0]


def test_category_resolution(spark):
    rows = [("", None, None), ("own", '{"task": "x"}', None), (None, '{"task": 5}', None), (None, '[1, {"a": 1}, {"label": "l", "task": "t"}]', None), (None, '{"category": "", "label": false}', None), (None, "nope", None)]
    df = spark.createDataFrame([(c, m) for c, m, _ in rows], "category string, meta_info string")
    got = [tuple(r) for r in df.select(*classify.resolve_category(df.columns, F.col("meta_info"), F.lit("guess"))).collect()]
    guess = ("inferred_subtask_from_prompt", "guess")
    assert got == [guess, ("category", "own"), ("meta_info.task", "5"), ("meta_info[].task", "t"), ("meta_info.label", "false"), guess]


@pytest.mark.parametrize(
    "turns, valid",
    [([], False), (None, False), (["human"], True), (["human", "gpt"], True), ([" Human ", "GPT", "human"], True), (["gpt"], False), (["human", "human"], False), (["human", "other"], False), ([None], False)],
)
def test_turns(spark, turns, valid):
    rows = [(None if turns is None else [(r, "v") for r in turns],)]
    df = spark.createDataFrame(rows, "c array<struct<from:string,value:string>>")
    assert df.select(nested.is_valid(F.col("c"))).first()[0] is valid


@pytest.mark.parametrize("w, h, mp, edge", [(0, 5, "unknown", "unknown"), (-1, -1, "unknown", "unknown"), (100, 499, "<0.05 MP", "<320 px"), (100, 500, "0.05–0.15 MP", "<320 px"), (1000, 1000, "1–2 MP", "768–1023 px"), (2000, 2000, "≥4 MP", "≥1024 px"), (480, 480, "0.15–0.5 MP", "480–639 px")])
def test_buckets(spark, w, h, mp, edge):
    df = spark.createDataFrame([(w, h)], "w int, h int")
    assert tuple(df.select(stats.megapixel_bucket(F.col("w"), F.col("h")), stats.short_edge_bucket(F.col("w"), F.col("h"))).first()) == (mp, edge)


def test_ratio_ties_to_even(spark):
    assert spark.range(1).select(stats.ratio(F.lit(1), F.lit(128)), stats.ratio(F.lit(0), F.lit(0))).first()[:] == (0.007812, 0.0)


def test_box_geometry(spark):
    box = [0.5, -0.2, 3.0, 1.0, 2.0, 0.5, 0.3, -0.7, 1.1]
    roll, pitch, yaw = box[6:]
    c, s = math.cos, math.sin
    mul = lambda a, b: [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    ry = [[c(yaw), 0, s(yaw)], [0, 1, 0], [-s(yaw), 0, c(yaw)]]
    rx = [[1, 0, 0], [0, c(pitch), -s(pitch)], [0, s(pitch), c(pitch)]]
    rz = [[c(roll), -s(roll), 0], [s(roll), c(roll), 0], [0, 0, 1]]
    r = mul(ry, mul(rx, rz))
    want = [[box[i] + sum(r[i][k] * sign[k] * box[3 + k] / 2 for k in range(3)) for i in range(3)] for sign in geom3d.CORNERS]
    df = spark.createDataFrame([(box,)], "b array<double>")
    got = df.select(geom3d.corners(F.col("b"))).first()[0]
    assert [[p.x, p.y, p.z] for p in got] == [pytest.approx(w) for w in want]


def test_clip_and_project(spark):
    point = lambda x, y, z: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z"))
    cam = F.struct(F.lit(90.0).alias("hfov"), F.lit(90.0).alias("vfov"), F.lit(200.0).alias("width"), F.lit(100.0).alias("height"))
    one = spark.range(1)
    seen = one.select(geom3d.project(point(1.0, 1.0, 2.0), cam), geom3d.project(point(1.0, 1.0, 0.0), cam)).first()
    assert (seen[0].u, seen[0].v) == pytest.approx((150.0, 75.0)) and seen[1] is None
    both, none, cut = one.select(
        geom3d.clip(point(0.0, 0.0, 1.0), point(0.0, 0.0, 2.0)), geom3d.clip(point(0.0, 0.0, -1.0), point(0.0, 0.0, -2.0)), geom3d.clip(point(0.0, 0.0, -1.0), point(2.0, 0.0, 1.0), 0.0)
    ).first()
    assert both.a.z == 1.0 and none is None and (cut.a.x, cut.a.z) == (1.0, 0.0)


def test_boxes(spark):
    nine = "[1,2,3,4,5,6,7,8,9]"
    texts = [f'[{{"label": "a", "bbox_3d": {nine}}}]', f"{{'bbox_3d': {nine}}}", '[{"bbox_3d": [1]}]', "nope", None, f"[{{'bbox_3d': {nine}, 'hidden': True, 'more': (1, 2)}}]"]
    got = values(spark, texts, geom3d.boxes(F.col("s"), literals=True))
    assert [[b.label for b in g] for g in got] == [["a"], ["object"], [], [], [], ["object"]]


def test_boxes_one_by_one(spark):
    nine = "[1,2,3,4,5,6,7,8,9]"
    texts = [
        f"[{{'label': 'bad', 'bbox_3d': [1, 'x', 3, 4, 5, 6, 7, 8, 9]}}, {{'label': 'good', 'bbox_3d': {nine}}}]", f'[{{"label": "ten", "bbox_3d": {nine[:-1]}, "no"]}}]',
        f'[{{"bbox_3d": {nine}, "hidden": true}}, 3]', f'[{{"label": 0, "bbox_3d": {nine}}}, {{"label": 1.50, "bbox_3d": {nine}}}, {{"label": "0", "bbox_3d": {nine}}}]',
        f'[{{"label": "t", "bbox_3d": [true, 2, 3, 4, 5, 6, 7, 8, 9]}}, {{"label": "n", "bbox_3d": [null, 2, 3, 4, 5, 6, 7, 8, 9]}}]', f'{{"label": "one", "bbox_3d": {nine}}}', f'["x", {{"bbox_3d": [" 1 ", "2e0", 3, 4, 5, 6, 7, 8, 9]}}]',
        f'[{{"label": "far", "bbox_3d": [1{"0" * 400}, 2, 3, 4, 5, 6, 7, 8, 9]}}]', "[" * 5000, '"text"', "7", f'[{{"label": "", "bbox_3d": {nine}}}]',
    ]
    got = [[(b.label, list(b.bbox_3d)) for b in g] for g in values(spark, texts, geom3d.boxes(F.col("s")))]
    count = [float(v) for v in range(1, 10)]
    assert got == [[(b["label"], b["bbox_3d"]) for b in geom3d.parse_boxes(x)] for x in texts]
    assert got[:7] == [[("good", count)], [("ten", count)], [("object", count)], [("object", count), ("1.5", count), ("0", count)], [("t", count)], [("one", count)], [("object", count)]]
    assert got[7:] == [[], [], [], [], [("object", count)]]


def test_base64_is_pythons(spark):
    import random

    rng = random.Random(3)
    texts = ["YWI=YWI=", "YWJj====", "====", "YW=Jj", "YW==", "YW=", "Y", "YWJ", "=YWJj", "Y=WJj", "YWI=!", "Y W\nI=", "YWJjYW==x", "YWJjYQ", "Ā=YQ==", "AAAA" * 5000 + "=A"]
    texts += ["".join(rng.choice("AQw=+/= !") for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts = [x for x in texts if x]

    def python(text):
        try:
            return base64.b64decode("".join(c for c in text if c.isascii()))
        except ValueError:
            return None

    assert [None if v is None else bytes(v) for v in values(spark, texts, binary.decode_base64(F.col("s")))] == [python(x) for x in texts]


def test_anchors_change_no_label(spark):
    """A question that meets a template has the word that stands for it; labels are those of the patterns alone, in order."""
    import random

    rng = random.Random(1)
    for (_, _, templates), picked in zip(classify.rules(), classify.anchors(), strict=True):
        assert sorted(t for ts in picked.values() for t in ts) == sorted(templates)
        for word, some in picked.items():
            assert all(word in re.sub(r"\[[a-z0-9]+\]", " ", x.lower()) for x in some)
    filled = [re.sub(r"\[[A-Za-z0-9]+\]", lambda m: rng.choice(["chair", "red box", "12", "?", ""]), x) for _, _, ts in classify.rules() for x in ts]
    words = sorted({w for x in filled for w in x.split()})
    asked = [*filled, *(x.replace("(s)", "") for x in filled), *(x[: rng.randrange(len(x))] for x in filled), *(f"well, {x.upper()} <image>" for x in filled), *(" ".join(rng.choices(words, k=9)) for _ in range(400)), ""]
    patterns = classify.rule_patterns()

    def label(q):
        q = " ".join(re.sub(TOKEN, " ", q).split()).lower()
        return "unknown.single_view" if q == "" else next((f"{task}.{'multi' if scope == 'multi' else 'single'}_view" for task, scope, p in patterns if re.search(p, q)), "position.single_view")

    assert values(spark, asked, classify.infer_category(F.col("s"), F.lit(1))) == [label(q) for q in asked]


def test_jpeg_sizes():
    assert binary.jpeg_size(b"\xff\xd8\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x01\x01\x11\x00") == (32, 16)
    assert [binary.jpeg_size(x) for x in (None, b"", b"\xff\xd8", b"\x89PNG")] == [None] * 4


@pytest.mark.parametrize("rows, size, counts", [(0, 4, {0: 0}), (3, 4, {0: 3}), (4, 4, {0: 4, 1: 0}), (5, 4, {0: 4, 1: 1}), (8, 4, {0: 4, 1: 4, 2: 0})])
def test_trailing_shards(spark, rows, size, counts):
    placed = shards.assign_shards(spark.range(rows).select(F.col("id").alias("ordinal")), size)
    assert {r.shard_id: r.n for r in shards.shard_counts(placed, size).collect()} == counts


def test_top_with_rest(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3), ("d", 2)], "key string, n long")
    assert {tuple(r) for r in stats.top_with_rest(df, 3).collect()} == {("a", 5), ("b", 4), ("others", 5)}
    assert {tuple(r) for r in stats.top_with_rest(df, 4).collect()} == {("a", 5), ("b", 4), ("c", 3), ("d", 2)}
