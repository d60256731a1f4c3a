"""Parts of shard files by place: an index of archive members and of lines, byte ranges read from them, and pairs of files read side by side.

Indexes are small tables (a row for each member, or for each stretch of lines), so they can be stored, joined and filtered before any payload or
line is read. A task reads ranges in order of their place and holds one of bounded size at a time.
"""

from __future__ import annotations

import json
import tarfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sampleprep.session import map_arrow
from sampleprep.sources.shards import _open, read_members, shard_files

#: Members whose gap is smaller are read at once, up to this many bytes.
GAP_BYTES, READ_BYTES = 1 << 16, 8 << 20
#: Bytes of a file that one task takes.
PART_BYTES = 64 << 20
STRETCH = "shard_id int, path string, offset long, bytes long, n long"


def _files(spark: SparkSession, folder: str, ending: str, only: list[int] | None = None) -> DataFrame:
    """shard_id, path and file_bytes of a folder's shards."""
    system, _ = _open(folder)
    found = [x for x in shard_files(folder, ending) if only is None or x[0] in set(only)]
    sizes = [i.size for i in system.get_file_info([p for _, p in found])] if found else []
    return spark.createDataFrame([(s, p, n) for (s, p), n in zip(found, sizes, strict=True)], "shard_id int, path string, file_bytes long")


def _by_part(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a part of a file in one task, in order."""
    return rows.repartition("path", F.floor(F.col("offset") / PART_BYTES)).sortWithinPartitions("path", "offset", *order)


# ---- members of archives -------------------------------------------------------------------------------------------


def member_index(spark: SparkSession, root: str) -> DataFrame:
    """shard_id, name, size and offset (of the payload; -1 in a compressed archive) of all members, from headers alone."""
    return read_members(spark, root).select("shard_id", "name", "size", "offset")


def last_members(index: DataFrame) -> DataFrame:
    """Of each name the member that counts: the last in the last archive."""
    return index.groupBy("name").agg(F.max_by(F.struct("shard_id", "size", "offset"), F.struct("shard_id", "offset")).alias("m")).select("name", "m.*")


def merged_ranges(offsets: np.ndarray, sizes: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, begin, end): members first to last - 1 in order of offset lie in the bytes from begin to end; a larger one is alone."""
    first = 0
    for k in range(1, len(offsets) + 1):
        end = int((offsets[first:k] + sizes[first:k]).max())
        if k == len(offsets) or offsets[k] > end + gap or max(end, int(offsets[k] + sizes[k])) - offsets[first] > most:
            yield first, k, int(offsets[first]), end
            first = k


def fetch_members(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """shard_id, name, size and payload of the wanted rows of a member index; no other member's bytes are read, but for gaps.

    Each member is fetched once for each row that asks for it. A compressed archive is read from its start, once.
    """
    folder = f"{root.rstrip('/')}/images"
    rows = wanted.select("shard_id", "name", "size", "offset").join(_files(spark, folder, ".tar").drop("file_bytes"), "shard_id")

    def batch(names: list[str], payloads: list[bytes], shard: int) -> pa.RecordBatch:
        columns = [pa.array([shard] * len(names), pa.int32()), pa.array(names), pa.array([len(p) for p in payloads], pa.int64()), pa.array(payloads, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["shard_id", "name", "size", "payload"])

    def stream(path: str, shard: int, names: dict[str, int]) -> Iterator[pa.RecordBatch]:
        """A compressed archive: once to see where each name is last, once for the payloads, one at a time."""
        system, _ = _open(folder)
        with system.open_input_file(path) as raw, tarfile.open(fileobj=raw, mode="r:*") as archive:
            last = {m.name: k for k, m in enumerate(archive) if m.isfile() and m.name in names}
        with system.open_input_file(path) as raw, tarfile.open(fileobj=raw, mode="r:*") as archive:
            for k, member in enumerate(archive):
                if last.get(member.name) == k:
                    payload = archive.extractfile(member).read()
                    yield batch([member.name] * names[member.name], [payload] * names[member.name], shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for path, shard, part in _runs(batches, "path"):
            names, sizes, offsets = part.column("name").to_pylist(), part.column("size").to_numpy(), part.column("offset").to_numpy()
            if offsets[0] < 0:
                yield from stream(path, shard, Counter(names))
                continue
            with system.open_input_file(path) as raw:
                for first, last, begin, end in merged_ranges(offsets, sizes):
                    data = raw.read_at(end - begin, begin)
                    yield batch(names[first:last], [data[o - begin : o - begin + s] for o, s in zip(offsets[first:last].tolist(), sizes[first:last].tolist(), strict=True)], shard)

    return map_arrow(_by_part(rows, "name"), run, "shard_id int, name string, size long, payload binary")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(key, shard_id, rows) of each run of rows with one key inside a batch."""
    for batch in batches:
        keys = batch.column(key).to_pylist()
        starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            yield keys[a], batch.column("shard_id")[a].as_py(), batch.slice(a, b - a)


# ---- lines ---------------------------------------------------------------------------------------------------------


def stretches(raw, size: int, begin: int, end: int, most_lines: int, most_bytes: int, block: int = 1 << 20) -> Iterator[tuple[int, int, int]]:
    """(offset, bytes, lines) of runs of lines that start in the bytes from begin to end of a file: up to most_lines, or until most_bytes are reached."""
    starts = np.array([0] if begin == 0 and size else [], dtype=np.int64)
    at = max(begin - 1, 0)
    while at < end - 1:
        data = np.frombuffer(raw.read_at(min(block, end - 1 - at), at), dtype=np.uint8)
        starts = np.concatenate([starts, np.flatnonzero(data == 10) + at + 1])
        at += len(data)
        while len(starts) > most_lines or (len(starts) > 1 and starts[-1] - starts[0] >= most_bytes):
            k = min(most_lines, max(1, int(np.searchsorted(starts, starts[0] + most_bytes))), len(starts) - 1)
            yield int(starts[0]), int(starts[k] - starts[0]), k
            starts = starts[k:]
    if not len(starts):
        return
    stop = at  # the last line may go on behind the part
    while stop < size:
        found = raw.read_at(min(block, size - stop), stop).find(b"\n")
        if found >= 0:
            stop += found + 1
            break
        stop = min(size, stop + block)
    yield int(starts[0]), int(stop - starts[0]), len(starts)


def line_index(spark: SparkSession, root: str, stride: int = 1024, most_bytes: int = 4 << 20, part_bytes: int = PART_BYTES, only: list[int] | None = None) -> DataFrame:
    """shard_id, path, offset, bytes, n and line_idx (of the first line) of stretches of at most stride lines of the shards' line files; only: of these shards."""
    folder = f"{root.rstrip('/')}/jsonl"
    files = _files(spark, folder, ".jsonl", only).where("file_bytes > 0")
    parts = files.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("file_bytes") - 1) / part_bytes))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["path"]) as raw:
                    begin = row["part"] * part_bytes
                    found = list(stretches(raw, row["file_bytes"], begin, min(begin + part_bytes, row["file_bytes"]), stride, most_bytes))
                columns = [pa.array([row[k]] * len(found), t) for k, t in (("shard_id", pa.int32()), ("path", pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array([f[k] for f in found], pa.int64()) for k in range(3)]], ["shard_id", "path", "offset", "bytes", "n"])

    found = map_arrow(parts.repartition("path", "part"), run, STRETCH)
    before = W.partitionBy("shard_id").orderBy("offset").rowsBetween(W.unboundedPreceding, -1)
    return found.withColumn("line_idx", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _lines(raw, row: dict) -> list[bytes]:
    return raw.read_at(row["bytes"], row["offset"]).split(b"\n")[: row["n"]]


def read_lines(spark: SparkSession, root: str, index: DataFrame) -> DataFrame:
    """shard_id, line_idx and value of all lines of an index's stretches, one stretch at a time in a task."""
    folder = f"{root.rstrip('/')}/jsonl"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for path, shard, part in _runs(batches, "path"):
            with system.open_input_file(path) as raw:
                for row in part.to_pylist():
                    lines = [line.decode("utf-8", "replace") for line in _lines(raw, row)]
                    columns = [pa.array([shard] * len(lines), pa.int32()), pa.array(range(row["line_idx"], row["line_idx"] + len(lines)), pa.int64()), pa.array(lines, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["shard_id", "line_idx", "value"])

    return map_arrow(_by_part(index), run, "shard_id int, line_idx long, value string")


def lines_at(spark: SparkSession, root: str, wanted: DataFrame, index: DataFrame, stride: int = 1024) -> DataFrame:
    """shard_id, line_idx and value of wanted lines (shard_id, line_idx), a row for each time a line is asked for.

    A stretch has at most stride lines, so it lies in two bands of so many lines at most and the join is an equality. Only
    stretches with a wanted line are read, each once in a task.
    """
    folder = f"{root.rstrip('/')}/jsonl"
    band = lambda line: F.floor(line / stride)
    bands = index.withColumnRenamed("line_idx", "first").withColumn("band", F.explode(F.sequence(band(F.col("first")), band(F.col("first") + F.col("n") - 1))))
    asked = wanted.select("shard_id", F.col("line_idx").cast("long").alias("line_idx")).withColumn("band", band(F.col("line_idx")))
    found = asked.join(bands, ["shard_id", "band"]).where(F.col("line_idx").between(F.col("first"), F.col("first") + F.col("n") - 1)).drop("band")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for path, shard, part in _runs(batches, "path"):
            with system.open_input_file(path) as raw:
                at, lines, made = None, [], []
                for row in part.to_pylist():
                    if row["offset"] != at:
                        at, lines = row["offset"], _lines(raw, row)
                    made.append((row["line_idx"], lines[row["line_idx"] - row["first"]].decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(made), pa.int32()), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made])], ["shard_id", "line_idx", "value"])

    return map_arrow(_by_part(found, "line_idx"), run, "shard_id int, line_idx long, value string")


# ---- pairs of files ------------------------------------------------------------------------------------------------


def image_paths(line: bytes) -> list[str] | None:
    """The paths of all images of a sample; None for a line that holds no object."""
    try:
        sample = json.loads(line)
    except ValueError:
        return None
    if not isinstance(sample, dict):
        return None
    found = []
    for turn in sample.get("data") or []:
        for part in (turn.get("content") if isinstance(turn, dict) else None) or []:
            image = part.get("image") if isinstance(part, dict) else None
            path = image.get("relative_path") if isinstance(image, dict) else None
            found += [path] if isinstance(path, str) else []
    return found


def scan_pairs(spark: SparkSession, root: str) -> DataFrame:
    """The lines of all shards beside the shard's archive, each pair of files in one task and nothing shuffled.

    shard_id, line_idx, value, unresolved (the line's paths that its archive lacks; null where the line holds no object), and a row without
    line_idx for each shard: has_text, has_archive, members and unreferenced (members that no line names).
    """
    root = root.rstrip("/")
    texts, archives = (dict(shard_files(f"{root}/{part}", ending)) for part, ending in (("jsonl", ".jsonl"), ("images", ".tar")))
    pairs = [(k, texts.get(k), archives.get(k)) for k in sorted(texts.keys() | archives.keys())]
    rows = spark.createDataFrame(pairs, "shard_id int, text string, archive string").repartition(max(1, min(len(pairs), 20_000)))
    schema = pa.schema([("shard_id", pa.int32()), ("line_idx", pa.int64()), ("value", pa.string()), ("unresolved", pa.list_(pa.string())), ("has_text", pa.bool_()), ("has_archive", pa.bool_()), ("members", pa.int64()), ("unreferenced", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(root)
        for batch in batches:
            for shard, text, archive in zip(*(batch.column(c).to_pylist() for c in ("shard_id", "text", "archive")), strict=True):
                names, named = set(), set()
                if archive is not None:
                    with system.open_input_file(archive) as raw, tarfile.open(fileobj=raw, mode="r:*") as members:
                        names = {m.name for m in members if m.isfile()}
                made, size, at = [], 0, 0
                if text is not None:
                    with system.open_input_stream(text, compression=None, buffer_size=1 << 20) as raw:
                        for at, line in enumerate(_split(raw)):
                            paths = image_paths(line)
                            named.update(paths or [])
                            made.append({"shard_id": shard, "line_idx": at, "value": line.decode("utf-8", "replace"), "unresolved": None if paths is None else [p for p in paths if p not in names]})
                            size += len(line)
                            if len(made) >= 4096 or size >= READ_BYTES:
                                yield pa.RecordBatch.from_pylist(made, schema)
                                made, size = [], 0
                made.append({"shard_id": shard, "has_text": text is not None, "has_archive": archive is not None, "members": len(names), "unreferenced": len(names - named)})
                yield pa.RecordBatch.from_pylist(made, schema)

    return map_arrow(rows, run, "shard_id int, line_idx long, value string, unresolved array<string>, has_text boolean, has_archive boolean, members long, unreferenced long")


def _split(raw, block: int = 1 << 20) -> Iterator[bytes]:
    """Lines of a stream without their newline, as many as end with one or have content."""
    rest: list[bytes] = []
    while data := raw.read(block):
        *lines, last = data.split(b"\n")
        for line in lines:
            yield b"".join([*rest, line])
            rest = []
        rest.append(last)
    if last := b"".join(rest):
        yield last
