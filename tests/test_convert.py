"""The conversion from source files to shards, metadata and back."""

import base64
import json
import re
import struct
import tarfile
import zlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sampleprep.operators import shards, validate
from sampleprep.plans import convert
from sampleprep.sources import shards as files



def _chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _huffman(number):
    """A table with one code, of one bit, for zero."""
    return b"\xff\xc4\x00\x14" + bytes([number, 1]) + bytes(16)


#: Whole files: black pixels of 256 x 192, and grey blocks of 640 x 480 in two bits each.
PNG = b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", struct.pack(">IIBBBBB", 256, 192, 8, 2, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(bytes(769 * 192))) + _chunk(b"IEND", b"")
JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xdb\x00\x43\x00" + b"\x01" * 64 + b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 480, 640) + b"\x01\x01\x11\x00"
JPEG += _huffman(0) + _huffman(16) + b"\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00" + bytes(1200) + b"\xff\xd9"
SCHEMA = "id string, data_source string, type string, conversations array<struct<from:string,value:string>>, images array<struct<bytes:binary,path:string>>, meta_info string"
CAMERA = "Camera intrinsic parameters: hfov=62.26, and vertical fov, vfov=48.74. Image width=256 and height=192. "


def talk(*values, roles=("human", "gpt")):
    return [Row(**{"from": roles[i % 2], "value": v}) for i, v in enumerate(values)]


def row(id="x1", source="arkitscenes", turns=None, images=(JPEG,), meta='[{"width": 256}]'):
    return (id, source, "t", talk("<image>\nHow many chairs are there?", "two") if turns is None else turns, [(b, None) for b in images], meta)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    rows = [
        [row(), row("x2", "Matterpod 3D", talk("first <image> then <IMAGE> end", "a", "more <image>", None), (PNG, JPEG))],
        [
            row("x3", turns=talk("hello", "yes", roles=("gpt", "human"))),
            row("x4", turns=[]),
            row(None, None, talk("line1\nline2\n<image> line3", "ok"), (b"raw", None, b""), '{"task": "own"}'),
            row("x5", turns=talk(CAMERA + "Find the 3D bounding box that encapsulates the chair in this visual representation.", "[{'bbox_3d': [0, 0, 3, 1, 1, 1, 0, 0, 0]}]"), images=(PNG,)),
        ],
    ]
    for i, part in enumerate(rows):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(folder / f"p{i}"))
        next((folder / f"p{i}").glob("*.parquet")).rename(folder / f"{i}.parquet")
    out = tmp_path_factory.mktemp("out")
    document = convert.convert(spark, str(folder), str(out), shard_size=2)
    return folder, out, document


def samples(out):
    return [json.loads(line) for p in sorted((out / "jsonl").glob("data_*.jsonl")) for line in p.read_text().splitlines()]


def test_metadata(root):
    _, out, made = root
    assert (made["total_samples_seen"], made["converted_samples"], made["skipped_samples"]) == (6, 4, 2)
    assert made["category_distribution"]["counting.single_view"] == {"count": 1, "ratio": 0.166667}
    assert made["category_distribution"]["own"]["count"] == 1
    assert made["data_source_distribution"]["matterport3d"]["count"] == 1
    assert made["image_count_distribution"] == {"1": {"count": 4, "ratio": 0.666667}, "2": {"count": 1, "ratio": 0.166667}, "3": {"count": 1, "ratio": 0.166667}}
    geometry = made["resolution_stats"]
    assert (geometry["total_images"], geometry["unknown_geometry"]) == (5, 1)
    assert geometry["by_data_source"]["matterport3d"]["width_max"] == 640
    assert json.loads((out / "metadata.json").read_text())["resolution_stats"] == geometry


def test_metadata_keys(root):
    made = root[2]
    assert list(made) == [
        "dataset_name", "input_parquet_dir", "output_root", "workers", "parquet_files_scheduled", "dataset_total_samples", "stopped_by_max_samples", "requested_max_samples", "id_strategy",
        "image_placeholder_policy", "image_naming_policy", "total_samples_seen", "converted_samples", "skipped_samples", "category_field_detected", "has_category", "category_distribution",
        "data_source_distribution", "image_count_distribution", "resolution_stats",
    ]
    assert made["parquet_files_scheduled"] == 2


def test_census(spark, root):
    made = convert.census(spark, str(root[0]))
    assert (made["parquet_file_count"], made["total_rows_scanned"], made["total_source_images"], made["rows_images_unsupported_or_empty"]) == (2, 6, 9, 0)
    assert made["images_per_row_histogram"] == {"1": 4, "2": 1, "3": 1} and made["avg_images_per_row"] == 1.5
    assert made["rows_by_images_shape"] == {"list_of_dict": 6} and made["image_slots_by_images_shape"] == {"list_of_dict": 9}
    assert made["image_bytes_validation"] == {"slots_pil_ok": 6, "slots_decode_failed": 2, "slots_pil_invalid": 1, "slots_checked": 9}
    assert "image_bytes_validation" not in convert.census(spark, str(root[0]), validate=False)


@pytest.fixture
def encoder():
    # a local function, as workers can't import the tests
    def encode(data):
        if data == b"raw":
            return b"made", "image/jpeg", 3, 4
        raise OSError("no image")

    return encode


def test_encoder_and_stale_shards(spark, root, tmp_path, encoder):
    folder, out, _ = root
    made = convert.convert(spark, str(folder), str(tmp_path), shard_size=1, encode=encoder, dataset_name="own")
    assert made["dataset_name"] == "own" and made["resolution_stats"]["unknown_geometry"] == 0
    assert len(list((tmp_path / "images").glob("data_*.tar"))) == 5
    assert [s["id"] for s in samples(tmp_path)] == [s["id"] for s in samples(out)]
    members = {m.name: m.payload for m in files.read_members(spark, str(tmp_path), payload=True).collect()}
    assert members["unknown_source__sample_1000000002_00.jpg"] == b"made"
    convert.convert(spark, str(folder), str(tmp_path), shard_size=100)
    assert [p.name for p in sorted((tmp_path / "images").iterdir()) if not p.name.startswith(".")] == ["data_000000.tar"]
    assert [s["id"] for s in samples(tmp_path)] == [s["id"] for s in samples(out)]


def test_encoded(spark, encoder):
    from sampleprep.functions import binary

    odd = PNG[:25] + b"\x03" + PNG[26:]
    df = spark.createDataFrame([([JPEG, PNG, None, odd, b"raw", b"\xff\xd8cut"],), ([],), (None,)], "p array<binary>")
    plain, coded = (df.select(binary.encoded(F.col("p"), e)).collect() for e in (None, encoder))
    sizes = lambda rows: [x and (x["format"], x["width"], x["height"]) for x in rows[0][0]]
    assert sizes(plain) == [("image/jpeg", 640, 480), ("image/png", 256, 192), None, ("image/png", -1, -1), ("image/jpeg", -1, -1), ("image/jpeg", -1, -1)]
    assert sizes(coded) == [("image/jpeg", 640, 480), ("image/png", 256, 192), None, ("image/png", -1, -1), ("image/jpeg", 3, 4), ("image/jpeg", -1, -1)]
    assert [bytes(x["payload"]) for x in coded[0][0] if x] == [JPEG, PNG, odd, b"made", b"\xff\xd8cut"]
    assert [r[0] for r in plain[1:]] == [[], None]


def test_one_shuffle_of_payloads(spark, root):
    prepared = convert.prepare(convert.read_source(spark, str(root[0])))
    built = convert.build_samples(prepared)
    laid = shards.segments(built, "file_index", "row_in_file", 2)
    plan = shards.place(built, laid, "file_index", "row_in_file", 2)._jdf.queryExecution().optimizedPlan().toString()
    # neither the samples nor their place needs a window, an aggregate or a sort of rows that carry payloads
    assert "payload" not in laid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") - laid._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2


@pytest.mark.parametrize("text", [None, "", "{broken", "[1]", "3", b"\xff\xfe"])
def test_metadata_that_is_none(tmp_path, text):
    """A missing or broken document, or one that is no object, is an empty one, and is replaced by the next write."""
    if text is not None:
        (tmp_path / "metadata.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    assert convert.read_metadata(str(tmp_path)) == {}
    convert.write_metadata(str(tmp_path), {"a": 1})
    assert convert.read_metadata(str(tmp_path) + "/") == {"a": 1}


def test_own_normaliser(spark, root):
    """The caller's function names the sources of the geometry, in place of the library's."""
    _, out, made = root
    samples = files.read_samples(spark, str(out))
    own = convert.resolution_stats(samples, lambda source: F.concat(F.lit("own "), F.upper(F.substring(source, 1, 3))))
    assert sorted(own["by_data_source"]) == ["own ARK", "own MAT", "own UNK"]
    assert own["by_data_source"]["own MAT"] == made["resolution_stats"]["by_data_source"]["matterport3d"]
    assert own["total_images"] == made["resolution_stats"]["total_images"]


def test_audits_read_few_columns(spark, root):
    """The scan of an audit or of the counts reads no payload and none of the columns it doesn't use."""
    rows = convert.read_source(spark, str(root[0]))
    text = F.array_join(F.col("conversations.value"), "\n")
    read = lambda df: re.findall(r"ReadSchema: (.*)", df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))
    assert read(validate.layout_audit(rows, text)) == ["struct<conversations:array<struct<value:string>>>"]
    counted = read(convert.prepare(rows).groupBy("source", "category_", "valid").count())
    assert counted and not [x for x in counted if "bytes:binary" in x]
    assert "images" in counted[0]


def test_image_counts(spark):
    """Null lists, null slots, slots with nothing but bytes, lists of other kinds and no list at all."""
    slot = "struct<bytes:binary,path:string>"
    for kind, values, want in (
        (f"array<{slot}>", [None, [], [None], [(b"a", None), (None, None), None]], [0, 0, 1, 3]), ("array<struct<bytes:binary>>", [[(b"a",), None]], [2]),
        ("array<string>", [["a", None], None], [2, 0]), ("array<binary>", [[b"a"]], [1]), ("string", ["aGk="], [0]), (slot, [(b"a", "p")], [0]),
    ):
        rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, images {kind}")
        assert [r.n for r in rows.select("k", convert.image_count(rows).alias("n")).orderBy("k").collect()] == want
    assert spark.range(1).select(convert.image_count(spark.range(1)).alias("n")).first().n == 0


def test_samples(root):
    _, out, _ = root
    made = samples(out)
    assert [s["id"] for s in made] == ["arkitscenes__x1", "Matterpod 3D__x2", "unknown_source__sample_1000000002", "arkitscenes__x5"]
    assert all(s["meta_prompt"] == [""] for s in made)
    first = made[0]["data"][0]["content"]
    assert first[0] == {"type": "image", "image": {"type": "relative_path", "format": "image/jpeg", "relative_path": "arkitscenes__x1_00.jpg", "width": 640, "height": 480}}
    assert first[1] == {"type": "text", "text": {"type": "string", "format": "utf-8", "string": "How many chairs are there?"}}
    second = made[1]["data"]
    assert [p["type"] for p in second[0]["content"]] == ["text", "image", "text", "image", "text"]
    assert second[0]["content"][1]["image"]["relative_path"] == "Matterpod_3D__x2_00.png"
    assert second[2]["content"][0]["text"]["string"] == "more <image>"
    assert second[3]["content"][0]["text"]["string"] == ""
    third = made[2]["data"][0]["content"]
    assert [p["type"] for p in third] == ["image", "text", "text"] or [p["type"] for p in third] == ["text", "image", "text"]
    assert "line1\nline2" in "\n".join(p["text"]["string"] for p in third if p["type"] == "text")
    assert made[3]["category"] == "grounding_3d.single_view"


def test_archives_and_layout(root):
    _, out, _ = root
    with tarfile.open(out / "images/data_000000.tar") as f:
        assert f.getnames() == ["arkitscenes__x1_00.jpg", "Matterpod_3D__x2_00.png", "Matterpod_3D__x2_01.jpg"]
        assert f.extractfile("Matterpod_3D__x2_00.png").read() == PNG
    # 4 samples in shards of 2 leave an empty third shard
    assert [p.name for p in sorted((out / "jsonl").iterdir())] == [f"data_{i:06d}.jsonl" for i in range(3)]
    assert (out / "jsonl/data_000002.jsonl").read_text() == ""
    assert not [p for p in (out / "images").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_rescan_and_read(spark, root):
    _, out, made = root
    again = convert.rescan(spark, str(out))
    assert again["resolution_stats"] == made["resolution_stats"]
    checked = {"images_checked": 5, "missing_in_tar": 0, "empty_tar_payload": 0, "pil_decode_failed": 1, "abnormal_images": 1, "tar_members_indexed": 5, "tar_cache_size": 0, "workers_effective": 4}
    assert again["image_read_validation"] == checked
    few = convert.rescan(spark, str(out), most_lines=1, decodes=lambda data: data[:3] != b"raw")
    assert few["image_read_validation"]["images_checked"] == 2 and few["resolution_stats"]["total_images"] == 2
    assert convert.rescan(spark, str(out), decodes=lambda data: 1 // 0)["image_read_validation"]["abnormal_images"] == 5
    members = files.read_members(spark, str(out)).where("name = 'arkitscenes__x5_00.png'").collect()
    assert [(m.shard_id, m.size, m.payload) for m in members] == [(1, len(PNG), None)]
    broken = out / "jsonl/data_000007.jsonl"
    broken.write_text('\n{"id": broken\n[1]\n')
    read = files.read_samples(spark, str(out), lines=True)
    assert [(r.shard_id, r.line_idx) for r in read.orderBy("shard_id", "line_idx").collect()] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert validate.check_samples(read).where("not (keys_ok and roles_ok and assistant_ok and user_ok)").count() == 0
    assert [r.start for r in convert.shard_ranges(read).orderBy("shard_id").collect()] == [0, 2]
    picked = shards.filtered_page(convert.browse(read, want_source="MatterPort 3D", images="multi"), None).collect()
    assert [r.id for r in picked] == ["Matterpod 3D__x2"]
    broken.unlink()


@pytest.mark.parametrize("cap, seen", [(0, 0), (1, 1), (3, 3), (99, 6)])
def test_row_cap(spark, root, cap, seen):
    rows = convert.read_source(spark, str(root[0]), cap)
    assert [(r.file_index, r.row_in_file) for r in rows.orderBy("file_index", "row_in_file").collect()] == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (1, 3)][:seen]


def test_partitions_do_not_matter(spark, root):
    prepared = convert.prepare(convert.read_source(spark, str(root[0])).repartition(7))
    placed = shards.assign_shards(shards.write_ordinals(convert.build_samples(prepared), "file_index", "row_in_file"), 2)
    assert [r[0] for r in placed.orderBy("ordinal").select("sample.id").collect()] == [s["id"] for s in samples(root[1])]


def test_base64_images(spark):
    from sampleprep.functions import binary

    texts = [base64.b64encode(PNG).decode(), "data:image/PNG;base64," + base64.b64encode(b"x").decode(), "abcde", "!!!!", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    kind = df.schema["s"].dataType
    assert [r[0] for r in df.select(binary.payload(F.col("s"), kind, data_url=True)).collect()] == [PNG, b"x", None, b"", None, None]
