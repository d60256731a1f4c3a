"""Indexes of members and lines, byte ranges, and pairs of files, against plain reading."""

import io
import json
import tarfile
import tracemalloc

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from sampleprep.operators import recon, validate
from sampleprep.plans import convert
from sampleprep.sources import ranges
from sampleprep.sources import shards as files


class Counting:
    """A file that counts what is read."""

    def __init__(self, raw):
        self.raw, self.bytes, self.reads = raw, 0, 0

    def read_at(self, n, at):
        data = self.raw.read_at(n, at)
        self.bytes, self.reads = self.bytes + len(data), self.reads + 1
        return data


def add(archive, name, payload):
    info = tarfile.TarInfo(name)
    info.size = len(payload)
    archive.addfile(info, io.BytesIO(payload))


def line(paths, k=0, **other):
    content = [{"type": "image", "image": {"type": "relative_path", "format": "image/png", "relative_path": p, "width": 1, "height": 1}} for p in paths]
    return json.dumps({"meta_prompt": [""], "data": [{"role": "user", "content": content}], "id": f"s__{k}", "category": "c", **other})


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    """Three pairs, a line file and an archive alone; names that return, a compressed archive, broken and blank lines."""
    at = tmp_path_factory.mktemp("pairs")
    (at / "jsonl").mkdir(), (at / "images").mkdir()
    texts = {0: [line(["a", "b"], 1), "", line(["gone"], 2), "[1]", "{broken", line([], 3, meta_prompt=["x"])], 1: [line(["a"], 4)] * 40, 2: [], 3: [line(["z"], 5)]}
    for k, lines in texts.items():
        (at / f"jsonl/data_{k:06d}.jsonl").write_text("".join(x + "\n" for x in lines))
    members = {0: [("a", b"first a"), ("b", b"b" * 100_000), ("a", b"second a"), ("empty", b"")], 1: [("a", b"third a"), ("unnamed", b"u" * 50)], 2: [("packed", b"p1"), ("packed", b"p2"), ("more", b"m")], 4: [("alone", b"x")]}
    for k, found in members.items():
        with tarfile.open(at / f"images/data_{k:06d}.tar", "w:gz" if k == 2 else "w") as archive:
            folder = tarfile.TarInfo("folder")
            folder.type = tarfile.DIRTYPE
            archive.addfile(folder)
            for name, payload in found:
                add(archive, name, payload)
    return str(at), members, texts


def test_member_index(spark, root):
    at, members, _ = root
    index = ranges.member_index(spark, at)
    rows = index.collect()
    assert sorted((r.shard_id, r.name, r.size) for r in rows) == sorted((k, n, len(p)) for k, found in members.items() for n, p in found)
    for r in rows:
        if r.shard_id == 2:
            assert r.offset == -1
        else:
            data = open(f"{at}/images/data_{r.shard_id:06d}.tar", "rb").read()[r.offset : r.offset + r.size]
            assert data in [p for n, p in members[r.shard_id] if n == r.name]
    last = {r.name: r.shard_id for r in ranges.last_members(index).collect()}
    assert last == {"a": 1, "b": 0, "empty": 0, "unnamed": 1, "packed": 2, "more": 2, "alone": 4}


def test_fetched_members_are_the_last(spark, root):
    at, _, _ = root
    index = ranges.member_index(spark, at)
    got = {r.name: bytes(r.payload) for r in ranges.fetch_members(spark, at, ranges.last_members(index)).collect()}
    assert got == {"a": b"third a", "b": b"b" * 100_000, "empty": b"", "unnamed": b"u" * 50, "packed": b"p2", "more": b"m", "alone": b"x"}
    first = ranges.fetch_members(spark, at, index.where("shard_id = 0 and name = 'a'")).collect()
    assert sorted(bytes(r.payload) for r in first) == [b"first a", b"second a"]
    assert ranges.fetch_members(spark, at, index.where("name = 'no'")).count() == 0


def test_merged_ranges():
    offsets, sizes = np.array([0, 100, 250, 5000, 5010]), np.array([90, 100, 10, 4, 10**6])
    assert list(ranges.merged_ranges(offsets, sizes, gap=60, most=4096)) == [(0, 3, 0, 260), (3, 4, 5000, 5004), (4, 5, 5010, 1005010)]
    assert list(ranges.merged_ranges(offsets, sizes, gap=0, most=4096)) == [(0, 1, 0, 90), (1, 2, 100, 200), (2, 3, 250, 260), (3, 4, 5000, 5004), (4, 5, 5010, 1005010)]
    assert list(ranges.merged_ranges(np.array([7, 7]), np.array([3, 3]))) == [(0, 2, 7, 10)] and list(ranges.merged_ranges(offsets[:0], sizes[:0])) == []


def test_only_referenced_members_are_read(tmp_path, monkeypatch):
    """Of 200 members of 100 kB, the bytes of the two asked for are read, and no more than the gaps allow."""
    with tarfile.open(tmp_path / "data_000000.tar", "w") as archive:
        for k in range(200):
            add(archive, f"m{k}", bytes([k]) * 100_000)
    with tarfile.open(tmp_path / "data_000000.tar") as archive:
        wanted = [m for m in archive if m.name in ("m3", "m150")]
    raw = Counting(fs.LocalFileSystem().open_input_file(str(tmp_path / "data_000000.tar")))
    offsets, sizes = np.array([m.offset_data for m in wanted]), np.array([m.size for m in wanted])
    for _, _, begin, end in ranges.merged_ranges(offsets, sizes):
        raw.read_at(end - begin, begin)
    assert raw.bytes == 200_000 and raw.reads == 2


TEXTS = [b"", b"\n", b"a", b"a\n", b"\n\n\n", b"one\ntwo\nthree", b"one\ntwo\nthree\n", b"x" * 50 + b"\ny\n" + b"z" * 33, b"\n" * 20 + b"end"]


@pytest.mark.parametrize("text", [*TEXTS, b"".join(bytes([97 + k % 26]) * (k % 7) + b"\n" for k in range(200))])
@pytest.mark.parametrize("part", [1, 3, 8, 10**6])
def test_stretches_are_all_lines(tmp_path, text, part):
    (tmp_path / "f").write_bytes(text)
    raw = fs.LocalFileSystem().open_input_file(str(tmp_path / "f"))
    want = text.split(b"\n")[:-1] + ([text.split(b"\n")[-1]] if text.split(b"\n")[-1] else [])
    for most_lines, most_bytes, block in ((1, 10**6, 7), (3, 5, 2), (1000, 10**6, 1 << 20)):
        got = []
        for begin in range(0, len(text), part):
            for offset, size, n in ranges.stretches(raw, len(text), begin, min(begin + part, len(text)), most_lines, most_bytes, block):
                lines = ranges._lines(raw, {"offset": offset, "bytes": size, "n": n})
                assert len(lines) == n <= most_lines
                got += lines
        assert got == want


def test_large_line_files_in_little_memory(tmp_path):
    """A file of 200 MB in stretches of 4 MB: far less than the file is held at once."""
    block = b"".join(json.dumps({"id": k, "pad": "x" * 200}).encode() + b"\n" for k in range(5000))
    with open(tmp_path / "f", "wb") as out:
        for _ in range(200):
            out.write(block)
    size = (tmp_path / "f").stat().st_size
    raw = fs.LocalFileSystem().open_input_file(str(tmp_path / "f"))
    tracemalloc.start()
    lines = 0
    for begin in range(0, size, ranges.PART_BYTES):
        for offset, n_bytes, n in ranges.stretches(raw, size, begin, min(begin + ranges.PART_BYTES, size), 1024, 4 << 20):
            lines += len(ranges._lines(raw, {"offset": offset, "bytes": n_bytes, "n": n}))
    assert lines == 1_000_000 and size > 200 << 20 and tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("stride, part", [(1, 7), (3, 100), (1024, 64 << 20)])
def test_lines(spark, root, stride, part):
    at, _, texts = root
    index = ranges.line_index(spark, at, stride=stride, part_bytes=part)
    want = {(k, i): x for k, lines in texts.items() for i, x in enumerate(lines)}
    assert {(r.shard_id, r.line_idx): r.value for r in ranges.read_lines(spark, at, index).collect()} == want
    asked = [(0, 0), (0, 5), (1, 7), (1, 7), (1, 39), (1, 40), (9, 0)]
    got = ranges.lines_at(spark, at, spark.createDataFrame(asked, "shard_id int, line_idx int"), index, stride).collect()
    assert sorted((r.shard_id, r.line_idx, r.value) for r in got) == sorted((*k, want[k]) for k in asked if k in want)


def test_first_lines_only(spark, root):
    at, _, _ = root
    assert sorted(r.id for r in files.read_samples(spark, at, most_lines=3).collect()) == ["s__1", "s__2", "s__4", "s__4", "s__4", "s__5"]


def test_dataset_validation(spark, root):
    at, _, _ = root
    got = {r.shard_id: r for r in convert.validate_dataset(spark, at, multiple=8).collect()}
    assert [(k, r.has_text, r.has_archive, r.n, r.broken) for k, r in sorted(got.items())] == [(0, True, True, 3, 3), (1, True, True, 40, 0), (2, True, True, 0, 0), (3, True, False, 1, 0), (4, False, True, 0, 0)]
    assert [r.unresolved for _, r in sorted(got.items())] == [1, 0, 0, 1, 0] and [r.unreferenced for _, r in sorted(got.items())] == [1, 1, 2, 0, 1]
    assert [(r.bad_keys, r.bad_roles, r.bad_assistant, r.bad_user) for _, r in sorted(got.items())] == [(1, 0, 0, 0), *[(0, 0, 0, 0)] * 4]
    assert [r.size_ok for _, r in sorted(got.items())] == [False, True, True, False, True]
    # the joins say the same
    samples, members = files.read_samples(spark, at), files.read_members(spark, at)
    references = samples.select("shard_id", F.explode(F.flatten(F.transform("data", lambda t: F.transform(t["content"], lambda p: p["image"]["relative_path"])))).alias("path"))
    missing = {r.shard_id: r.n for r in validate.missing_members(references, members).groupBy("shard_id").agg(F.count("*").alias("n")).collect()}
    assert missing == {k: r.unresolved for k, r in got.items() if r.unresolved}
    texts = spark.createDataFrame([(k,) for k, _ in files.shard_files(f"{at}/jsonl", ".jsonl")], "shard_id int")
    archives = spark.createDataFrame([(k,) for k, _ in files.shard_files(f"{at}/images", ".tar")], "shard_id int")
    assert {(r.shard_id, r.has_text, r.has_archive) for r in recon.pair_shards(texts, archives).collect()} == {(k, r.has_text, r.has_archive) for k, r in got.items()}
    plan = ranges.scan_pairs(spark, at)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_empty_dataset(spark, tmp_path):
    assert convert.validate_dataset(spark, str(tmp_path)).count() == 0
    assert ranges.line_index(spark, str(tmp_path)).count() == 0 and ranges.member_index(spark, str(tmp_path)).count() == 0
