"""Shard files: tar archives as a data source, line files with their line numbers, and a writer of both.

Paths go through pyarrow's file systems, so local, HDFS and object-store folders work alike on every executor.
"""

from __future__ import annotations

import io
import json
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from sampleprep.session import ship

_UNNAMED = re.compile(r"/\.[0-9a-f]{32}$")
_SHARD = re.compile(r"data_(\d+)\.(?:tar|jsonl)$")
MEMBERS = "shard_id int, name string, size long, offset long, payload binary"
_BATCH = pa.schema([("shard_id", pa.int32()), ("name", pa.string()), ("size", pa.int64()), ("offset", pa.int64()), ("payload", pa.binary())])
#: Members and payload bytes that go to Spark at once; a batch ends with the member that reaches either.
_BATCH_ROWS, _BATCH_BYTES = 8192, 8 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


#: Names the shards of a finished write, in the folder of a dataset.
MANIFEST = "_shards.json"
#: Stores where a file appears when it is closed, as a whole; elsewhere it is written under another name first.
_WHOLE = frozenset(("s3", "gcs", "abfs"))


def read_manifest(root: str) -> dict | None:
    system, at = _open(root)
    try:
        with system.open_input_file(f"{at}/{MANIFEST}") as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return None


def write_manifest(root: str, shards: list[int], complete: bool) -> None:
    system, at = _open(root)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(f"{at}/{MANIFEST}") as f:
        f.write(json.dumps({"complete": complete, "shards": sorted(shards)}).encode())


def _listed(folder: str, ending: str) -> list[tuple[int, str]]:
    system, at = _open(folder)
    found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    matched = [(m, i.path) for i in found if i.is_file and i.path.endswith(ending) and (m := _SHARD.search(i.path))]
    return sorted((int(m[1]), path) for m, path in matched)


def shard_files(folder: str, ending: str) -> list[tuple[int, str]]:
    """(shard_id, path) of a folder's shards, sorted; none if it doesn't exist.

    Where the dataset has a manifest, its shards count; a write that did not finish is an error.
    """
    made = read_manifest(folder.rstrip("/").rpartition("/")[0])
    if made and not made["complete"]:
        raise RuntimeError(f"the last write of {folder} did not finish")
    known = set(made["shards"]) if made else None
    return [x for x in _listed(folder, ending) if known is None or x[0] in known]


@dataclass
class TarPart(InputPartition):
    shard_id: int
    path: str


class TarReader(DataSourceReader):
    """One task for each archive; headers are read by seeking, payloads only if asked for."""

    def __init__(self, options: dict) -> None:
        self.folder, self.payload, self.names = options["path"], options.get("payload", "false") == "true", None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            names = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if names is not None and f.attribute == ("name",):
                self.names = names if self.names is None else self.names & names
            else:
                yield f

    def partitions(self) -> list[TarPart]:
        return [TarPart(i, p) for i, p in shard_files(self.folder, ".tar")] or [TarPart(-1, "")]

    def read(self, partition: TarPart) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in self.members(partition):
            rows.append(row)
            size += len(row[4] or b"")
            if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BATCH.types)], schema=_BATCH)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BATCH.types)], schema=_BATCH)

    def members(self, partition: TarPart) -> Iterator[tuple]:
        if not partition.path:
            return
        system, _ = _open(self.folder)
        with system.open_input_file(partition.path) as raw, tarfile.open(fileobj=raw, mode="r:*") as archive:
            plain = archive.fileobj is raw  # else the archive is compressed, and places in it are none of the file
            for member in archive:
                if member.isfile() and (self.names is None or member.name in self.names):
                    offset = member.offset_data if plain and not member.issparse() else -1
                    yield partition.shard_id, member.name, member.size, offset, archive.extractfile(member).read() if self.payload else None


@dataclass
class Written(WriterCommitMessage):
    shards: list[int]


class ShardWriter(DataSourceWriter):
    """Writes rows (shard_id, line, members) that come sorted by shard, each shard in one task.

    A task gives its files their own names when they are whole, so a task that is killed leaves none and one that is run again puts the same
    files in place of the first. The driver moves nothing: on commit it writes the manifest, which readers honour, and deletes what
    killed tasks and, with overwrite, earlier writes have left.
    """

    def __init__(self, options: dict, overwrite: bool = False) -> None:
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, rows: Iterator) -> Written:
        system, root = _open(self.folder)
        for part in ("jsonl", "images"):
            system.create_dir(f"{root}/{part}", recursive=True)
        made: list[int] = []
        shard, text, raw, archive, names = None, None, None, None, []

        def close() -> None:
            if shard is not None:
                archive.close(), raw.close(), text.close()
                for name, final in names:
                    if name != final:
                        _put(system, name, final)

        for row in rows:
            if row.shard_id != shard:
                close()
                shard, mark = row.shard_id, uuid.uuid4().hex
                made.append(shard)
                finals = [f"{root}/{part}/data_{shard:06d}.{ending}" for part, ending in (("jsonl", "jsonl"), ("images", "tar"))]
                names = [(f if system.type_name in _WHOLE else f"{f.rpartition('/')[0]}/.{mark}", f) for f in finals]
                text, raw = (system.open_output_stream(name) for name, _ in names)
                archive = tarfile.open(fileobj=raw, mode="w|")
            if row.line is not None:
                text.write(row.line.encode() + b"\n")
            for member in row.members or []:
                info = tarfile.TarInfo(member.name)
                info.size = len(member.payload)
                archive.addfile(info, io.BytesIO(member.payload))
        close()
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        made = {k for message in messages if message for k in message.shards}
        earlier = read_manifest(self.folder)
        system, root = _open(self.folder)
        for part, ending in (("jsonl", "jsonl"), ("images", "tar")):
            left = [i.path for i in system.get_file_info(fs.FileSelector(f"{root}/{part}", allow_not_found=True)) if _UNNAMED.search(i.path)]
            left += [path for k, path in _listed(f"{self.folder}/{part}", f".{ending}") if self.overwrite and k not in made]
            for path in left:
                system.delete_file(path)
        write_manifest(self.folder, [*made] if self.overwrite else [*made.union(earlier["shards"] if earlier else [])], True)

    def abort(self, messages: list[Written | None]) -> None:
        """What is whole stays; a manifest that says so keeps readers off."""


def _put(system: fs.FileSystem, name: str, final: str) -> None:
    """Rename, in place of what an earlier try has left."""
    try:
        system.move(name, final)
    except OSError:
        if system.get_file_info(final).type == fs.FileType.NotFound:
            raise
        system.delete_file(final)
        system.move(name, final)


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshards"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema: T.StructType) -> TarReader:
        return TarReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TarShards)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_members(spark: SparkSession, root: str, payload: bool = False) -> DataFrame:
    """shard_id, name, size, offset (of the payload; -1 in a compressed archive) and payload of all archives' regular members."""
    register(spark)
    return spark.read.format("tarshards").option("payload", str(payload).lower()).load(f"{root.rstrip('/')}/images")


_SAMPLE = (
    "meta_prompt array<string>, data array<struct<role:string,content:array<struct<type:string,text:struct<type:string,format:string,string:string>,"
    "image:struct<type:string,format:string,relative_path:string,width:int,height:int>>>>>, id string, category string"
)


def read_samples(
    spark: SparkSession, root: str, lines: bool = False, most_lines: int | None = None, only: list[int] | None = None, after: tuple[int, int] | None = None
) -> DataFrame:
    """shard_id and the sample of each line that holds an object; blank lines and lines that can't be parsed are left out.

    lines adds line_idx, by the index of lines. most_lines: the first lines of each shard; only: these shards; after: lines from this
    (shard_id, line_idx) on. Of lines that are left out so, whole stretches are not read.
    """
    numbered = lines or most_lines is not None or after is not None
    if numbered:
        from sampleprep.sources import ranges

        index = ranges.line_index(spark, root, only=only)
        wanted = F.lit(True) if most_lines is None else F.col("line_idx") < most_lines
        late = F.lit(True) if after is None else F.col("shard_id") > after[0]
        begun = late if after is None else late | (F.col("shard_id") == after[0]) & (F.col("line_idx") + F.col("n") > after[1])
        late = late if after is None else late | (F.col("shard_id") == after[0]) & (F.col("line_idx") >= after[1])
        rows = ranges.read_lines(spark, root, index.where(wanted & begun)).where(wanted & late)
    else:
        found = [p for k, p in shard_files(f"{root.rstrip('/')}/jsonl", ".jsonl") if only is None or k in set(only)]
        shard: Column = F.regexp_extract(F.col("_metadata.file_name"), r"data_(\d+)\.jsonl$", 1).cast("int")
        named = [f"{root.rstrip('/')}/jsonl/{p.rpartition('/')[2]}" for p in found]
        rows = spark.read.text(named).select(shard.alias("shard_id"), "value") if named else spark.createDataFrame([], "shard_id int, value string")
    return parse_samples(rows, "shard_id", *["line_idx"] * numbered)


def parse_samples(rows: DataFrame, *others: str, keep: bool = False) -> DataFrame:
    """The columns others and the sample of each line (value) that holds an object; keep: other rows too, with a null sample."""
    read = F.from_json("value", f"{_SAMPLE}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    parsed = rows.withColumn("s", F.when(F.startswith(F.btrim("value"), F.lit("{")), read))
    fine = F.col("s").isNotNull() & F.col("s._bad").isNull()
    parsed = parsed if keep else parsed.where(fine)
    return parsed.select(*others, *[F.when(fine, F.col(f"s.{c}")).alias(c) if keep else F.col(f"s.{c}") for c in ("meta_prompt", "data", "id", "category")])
