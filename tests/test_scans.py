"""Scans that end early or go on, kept geometry, row counts from footers, and the writer's commit."""

import json
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql import functions as F

from sampleprep.operators import nested, shards, stats
from sampleprep.plans import convert, scans
from sampleprep.sources import shards as files


def sample(k, images=1, source="s", size=10):
    parts = [{"type": "image", "image": {"type": "relative_path", "format": "image/png", "relative_path": f"{k}_{i}", "width": size, "height": 2 * size}} for i in range(images)]
    return json.dumps({"meta_prompt": [""], "data": [{"role": "user", "content": parts}], "id": f"{source}__{k}", "category": "even" if k % 2 == 0 else "odd"})


@pytest.fixture
def root(tmp_path):
    (tmp_path / "jsonl").mkdir()
    for shard in range(7):
        lines = [sample(shard * 20 + k, images=1 + k % 3, source="abc"[k % 3]) for k in range(20)] if shard != 3 else []
        (tmp_path / f"jsonl/data_{shard:06d}.jsonl").write_text("".join(x + "\n" + ("\n" if k % 5 == 0 else "") for k, x in enumerate(lines)))
    return str(tmp_path)


@pytest.mark.parametrize("size, wanted", [(7, {}), (10, {"want_category": "even"}), (4, {"want_source": "B", "images": "multi"}), (50, {"images": "single"}), (3, {"want_category": "none"})])
def test_pages_are_the_filter(spark, root, size, wanted):
    pages = list(scans.pages(spark, root, size, **wanted))
    rows = convert.browse(files.read_samples(spark, root, lines=True), **wanted).orderBy("shard_id", "line_idx").collect()
    assert [r for p in pages for r in p] == rows
    assert all(len(p) == size for p in pages[:-1])
    capped = list(scans.pages(spark, root, size, most_matches=9, **wanted))
    assert [r for p in capped for r in p] == rows[:9]


def test_other_shards_are_not_read(spark, root, monkeypatch):
    read = []
    real = scans.read_samples
    monkeypatch.setattr(scans, "read_samples", lambda *a, **k: read.append(k["only"]) or real(*a, **k))
    rows, cursor = scans.next_page(spark, root, size=5)
    assert read == [[0]] and cursor == scans.Cursor(0, rows[-1].line_idx + 1, 5, False)
    (__import__("pathlib").Path(root) / "jsonl/data_000000.jsonl").write_text("changed\n")  # behind the cursor's shard nothing is asked of it
    read.clear()
    _, cursor = scans.next_page(spark, root, scans.Cursor(4, 3, 50), size=5)
    assert read == [[4]] and cursor.found == 55
    read.clear()
    _, cursor = scans.next_page(spark, root, scans.Cursor(1, 0), size=45)
    assert read == [[1], [2, 3], [4, 5, 6]] and not cursor.exhausted
    assert scans.next_page(spark, root, scans.Cursor(6, 999), size=5) == ([], scans.Cursor(7, 0, 0, True))


def test_waves():
    assert list(scans.waves(list(range(10)))) == [[0], [1, 2], [3, 4, 5, 6], [7, 8, 9]] and list(scans.waves([])) == []


def test_first_hit_reads_no_later_files(spark, tmp_path):
    """Files behind the wave with the hit are broken, so that reading one would fail."""
    for k in range(7):
        part = tmp_path / f"p{k}"
        texts = ["<image> fine", "before <image>" if k in (2, 5) else "plain", "x <image> y <image>" if k == 2 else ""]
        spark.createDataFrame([(f"{k}-{i}", x) for i, x in enumerate(texts)], "id string, text string").coalesce(1).write.parquet(str(part))
        next(part.glob("*.parquet")).rename(tmp_path / f"{k}.parquet")
    row = scans.first_deviant(spark, str(tmp_path), F.col("text"))
    assert (row.id, row.file_index, row.row_in_file, row.slots, row.flags) == ("2-1", 2, 1, 1, "leading_text")
    paths = [str(tmp_path / f"{k}.parquet") for k in range(7)]
    for p in paths[3:]:
        open(p, "w").write("broken")
    assert scans.first_hit(spark, paths, lambda rows: rows.where("text = 'before <image>'")).id == "2-1"
    assert scans.first_hit(spark, paths[:3], lambda rows: rows.where("text = 'none'")) is None


def _one_file(made, path, tmp_path):
    made.coalesce(1).write.parquet(str(tmp_path / f"made-{path.name}"))
    next((tmp_path / f"made-{path.name}").glob("*.parquet")).rename(path)


def test_first_hit_where_files_lack_a_column(spark, tmp_path):
    """A file without the column has no hits, whichever file it is; only the named columns are read."""
    folder = tmp_path / "files"
    folder.mkdir()
    has = "id string, text string, images array<struct<bytes:binary,path:string>>"
    _one_file(spark.createDataFrame([("a", "before <image>")], "id string, other string"), folder / "0.parquet", tmp_path)
    _one_file(spark.createDataFrame([("b", "plain", None), ("c", "before <image>", [(b"raw", None)])], has), folder / "1.parquet", tmp_path)
    _one_file(spark.createDataFrame([("d",)], "id string"), folder / "2.parquet", tmp_path)
    row = scans.first_deviant(spark, str(folder), F.col("text"), columns="id string, text string")
    assert (row.id, row.file_index, row.row_in_file) == ("c", 1, 1) and "images" not in row
    paths = [str(folder / f"{k}.parquet") for k in (0, 2)]
    assert scans.first_hit(spark, paths, lambda rows: rows.where("text is not null"), columns="id string, text string") is None


def test_rows_are_numbered_across_row_groups(spark, tmp_path):
    """Row groups of one file go to several tasks, and each row keeps its number in the file."""
    n = 4000
    table = pa.table({"id": list(range(n)), "text": ["before <image>" if k == 3210 else f"{k:050d}" for k in range(n)]})
    pq.write_table(table, tmp_path / "0.parquet", row_group_size=100, compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = convert.read_source(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        assert rows.where("row_in_file <> id or file_index <> 0").count() == 0 and rows.count() == n
        row = scans.first_deviant(spark, str(tmp_path), F.col("text"))
        assert (row.id, row.row_in_file) == (3210, 3210)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_kept_geometry(spark, root, monkeypatch):
    whole = lambda: convert.resolution_stats(files.read_samples(spark, root))
    document, read = scans.update_geometry(spark, root)
    assert document == whole() and read == [0, 1, 2, 3, 4, 5, 6] and document["total_images"] == 234
    assert scans.update_geometry(spark, root) == (document, [])
    at = __import__("pathlib").Path(root) / "jsonl"
    (at / "data_000001.jsonl").write_text(sample(7, 2, "new", 900) + "\n")
    (at / "data_000009.jsonl").write_text(sample(8, 1, "new", -1) + "\n")
    (at / "data_000005.jsonl").unlink()
    document, read = scans.update_geometry(spark, root)
    assert document == whole() and read == [1, 9] and document["by_data_source"]["new"]["width_max"] == 900
    assert len([p for p in (at.parent / "_states").iterdir() if p.is_dir()]) == 1


def test_merged_states_are_the_whole(spark):
    rows = [(f"s{k % 3}", (k * 37) % 2000 - 5, (k * 91) % 1500 if k % 7 else None, k % 4) for k in range(300)]
    df = spark.createDataFrame(rows, "source string, width int, height int, part int")
    key = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    merged = stats.merge_geometry(stats.geometry_states(df, "part"))
    assert key(merged.collect()) == key(stats.geometry(df).collect())


def test_footer_counts(spark, tmp_path):
    for k, n in enumerate((3, 0, 50)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
    paths = [str(next((tmp_path / f"p{k}").glob("*.parquet"))) for k in range(3)]
    assert {r.file_index: r.n for r in convert.footer_counts(spark, paths).collect()} == {0: 3, 1: 0, 2: 50}
    df = spark.createDataFrame([(f, i) for f, n in ((0, 3), (2, 50)) for i in range(n)], "file_index int, row_in_file long")
    counts = convert.footer_counts(spark, paths)
    assert shards.capped(df, 5, counts).count() == 5
    plan = shards.capped(df, 5, counts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def rows_of(shard, n):
    return [Row(shard_id=shard, line=f'{{"k": {k}}}', members=[Row(name=f"{shard}_{k}", payload=b"x" * k)]) for k in range(n)]


def test_killed_and_repeated_tasks_leave_one_shard(tmp_path):
    root = str(tmp_path)
    writer = files.ShardWriter({"path": root}, overwrite=True)

    def killed():
        yield from rows_of(0, 3)
        yield from rows_of(1, 2)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(killed())
    # the shard that was whole has its name, the other has none
    assert [p.name for p in (tmp_path / "jsonl").iterdir() if not p.name.startswith(".")] == ["data_000000.jsonl"]
    first, again = writer.write(iter(rows_of(0, 3) + rows_of(1, 2))), writer.write(iter(rows_of(0, 3) + rows_of(1, 2)))
    assert first.shards == again.shards == [0, 1]
    writer.commit([again, None])
    assert sorted(p.name for p in (tmp_path / "jsonl").iterdir()) == ["data_000000.jsonl", "data_000001.jsonl"]
    assert (tmp_path / "jsonl/data_000001.jsonl").read_text().count("\n") == 2
    with tarfile.open(tmp_path / "images/data_000000.tar") as archive:
        assert archive.getnames() == ["0_0", "0_1", "0_2"]
    assert files.read_manifest(root) == {"complete": True, "shards": [0, 1]}


def test_readers_honour_the_manifest(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    moved = []
    real = fs.LocalFileSystem.move
    writer = files.ShardWriter({"path": root}, overwrite=True)
    message = writer.write(iter(rows_of(0, 1) + rows_of(2, 1)))
    monkeypatch.setattr(files, "_put", lambda *a: moved.append(a))
    writer.commit([message])
    assert not moved and real is fs.LocalFileSystem.move  # the driver moves nothing
    (tmp_path / "jsonl/data_000005.jsonl").write_text("{}\n")
    assert [k for k, _ in files.shard_files(f"{root}/jsonl", ".jsonl")] == [0, 2]
    assert files.read_samples(spark, root).count() == 2
    files.write_manifest(root, [0], False)
    with pytest.raises(RuntimeError, match="did not finish"):
        files.read_samples(spark, root)
    (tmp_path / files.MANIFEST).unlink()
    assert [k for k, _ in files.shard_files(f"{root}/jsonl", ".jsonl")] == [0, 2, 5]
    appended = files.ShardWriter({"path": root}, overwrite=False)
    files.write_manifest(root, [0, 2], True)
    appended.commit([appended.write(iter(rows_of(7, 1)))])
    assert files.read_manifest(root)["shards"] == [0, 2, 7]


def test_image_counts_of_samples(spark, root):
    counts = files.read_samples(spark, root).select(nested.image_count(F.col("data")).alias("n")).groupBy("n").count().collect()
    assert {r.n: r["count"] for r in counts} == {1: 42, 2: 42, 3: 36}
