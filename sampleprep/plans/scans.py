"""Scans of a dataset that end early or go on where they ended: pages of filtered samples, the first deviant row, and geometry that is kept by shard."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sampleprep.functions import text as t
from sampleprep.operators import shards, stats, validate
from sampleprep.plans import convert
from sampleprep.sources.shards import _open, read_samples, shard_files

#: Files or shards of the largest wave.
MOST_AT_ONCE = 4096


def waves(items: list, first: int = 1) -> Iterator[list]:
    """The items in order, in lists of first, twice as many, and so on: a hit near the start costs little, a far one few rounds."""
    at, n = 0, max(1, first)
    while at < len(items):
        yield items[at : at + n]
        at, n = at + n, min(2 * n, MOST_AT_ONCE)


# ---- pages ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cursor:
    """Where a filtered scan goes on: the next line, and how many matches came before; exhausted at the end or at the cap of matches."""

    shard_id: int = 0
    line_idx: int = 0
    found: int = 0
    exhausted: bool = False


def next_page(spark: SparkSession, root: str, cursor: Cursor = Cursor(), size: int = 10, most_matches: int = 200_000, **wanted: str) -> tuple[list[Row], Cursor]:
    """The next size samples that meet the browser's filter, in order of shard and line, and the cursor behind them.

    Shards before the cursor are not read, nor, of its shard, whole stretches before it; then come waves of shards until the page is full. Only
    the page's rows reach the driver.
    """
    need = min(size, most_matches - cursor.found)
    if cursor.exhausted or need <= 0:
        return [], Cursor(cursor.shard_id, cursor.line_idx, cursor.found, True)
    rows: list[Row] = []
    left = [k for k, _ in shard_files(f"{root.rstrip('/')}/jsonl", ".jsonl") if k >= cursor.shard_id]
    for some in waves(left):
        samples = read_samples(spark, root, lines=True, only=some, after=(cursor.shard_id, cursor.line_idx))
        rows += convert.browse(samples, **wanted).orderBy("shard_id", "line_idx").limit(need - len(rows)).collect()
        if len(rows) == need:
            found = cursor.found + need
            return rows, Cursor(rows[-1].shard_id, rows[-1].line_idx + 1, found, found >= most_matches)
    return rows, Cursor(left[-1] + 1 if left else cursor.shard_id, 0, cursor.found + len(rows), True)


def pages(spark: SparkSession, root: str, size: int = 10, most_matches: int = 200_000, **wanted: str) -> Iterator[list[Row]]:
    """All pages, one after the other."""
    cursor = Cursor()
    while not cursor.exhausted:
        rows, cursor = next_page(spark, root, cursor, size, most_matches, **wanted)
        if rows:
            yield rows


# ---- first hit -----------------------------------------------------------------------------------------------------


def first_hit(spark: SparkSession, paths: list[str], hits: Callable[[DataFrame], DataFrame], first: int = 1, columns: str | None = None) -> Row | None:
    """The first row, by file and row, of what hits leaves of Parquet files; files are read in waves, none behind the wave with a hit.

    hits gets rows with file_index and row_in_file and keeps both. Each wave gives one row by an aggregate; nothing is sorted.
    columns: the columns to read, as a schema; a file that lacks one has nulls there. Without it the files have to be of one schema.
    """
    base = 0
    for some in waves(sorted(paths), first):
        reader = spark.read if columns is None else spark.read.schema(columns)
        rows = shards.with_file_order(reader.parquet(*some)).withColumn("file_index", F.col("file_index") + base)
        found = hits(rows)
        row = found.agg(F.min_by(F.struct(*found.columns), F.struct("file_index", "row_in_file")).alias("x")).first().x
        if row is not None:
            return row
        base += len(some)
    return None


def first_deviant(spark: SparkSession, folder: str, text: Column, most: int = 400, columns: str | None = None) -> Row | None:
    """The first row of a folder's Parquet files whose layout deviates, with slots, flags and snippet; columns as in first_hit."""
    paths = spark.read.parquet(f"{folder.rstrip('/')}/*.parquet").inputFiles()
    return first_hit(spark, paths, lambda rows: validate.deviants(rows, text, most), columns=columns)


# ---- kept geometry -------------------------------------------------------------------------------------------------

_STAMP = "shard_id int, file_bytes long, file_time long"


def _stamps(root: str) -> list[tuple[int, int, int]]:
    """(shard_id, bytes, time) of the shards' line files."""
    folder = f"{root}/jsonl"
    system, _ = _open(folder)
    found = shard_files(folder, ".jsonl")
    return [(k, i.size, i.mtime_ns or 0) for (k, _), i in zip(found, system.get_file_info([p for _, p in found]), strict=True)] if found else []


def update_geometry(spark: SparkSession, root: str, normalise: Callable[[Column], Column] = t.normalise_source) -> tuple[dict[str, Any], list[int]]:
    """The geometry document of a dataset from kept states of its shards, and the shards that were read for it.

    States are kept under _states in the dataset's folder, with size and time of each line file. Shards whose file is the same are not read
    again, changed ones are replaced and missing ones left out. A new version is written beside the old one and then named.
    """
    root = root.rstrip("/")
    system, at = _open(root)
    named = f"{at}/_states/latest.json"
    try:
        with system.open_input_file(named) as f:
            version = json.loads(f.read())["version"]
        kept = {r.shard_id: (r.shard_id, r.file_bytes, r.file_time) for r in spark.read.parquet(f"{root}/_states/{version}/stamps").collect()}
    except FileNotFoundError:
        version, kept = None, {}
    stamps = _stamps(root)
    new = [s[0] for s in stamps if kept.get(s[0]) != s]
    states = stats.geometry_states(convert.sample_images(read_samples(spark, root, only=new), normalise, "shard_id"), "shard_id")
    if version is not None:
        same = spark.createDataFrame([(s[0],) for s in stamps if kept.get(s[0]) == s], "shard_id int")
        states = spark.read.parquet(f"{root}/_states/{version}/cells").join(same, "shard_id", "left_semi").unionByName(states)
    if new or version is None or kept.keys() != {s[0] for s in stamps}:
        made = uuid.uuid4().hex
        states.write.parquet(f"{root}/_states/{made}/cells")
        spark.createDataFrame(stamps, _STAMP).coalesce(1).write.parquet(f"{root}/_states/{made}/stamps")
        with system.open_output_stream(named) as f:
            f.write(json.dumps({"version": made}).encode())
        if version is not None and system.get_file_info(f"{at}/_states/{version}").type == fs.FileType.Directory:
            system.delete_dir(f"{at}/_states/{version}")
        version = made
    return convert.geometry_document(stats.merge_geometry(spark.read.parquet(f"{root}/_states/{version}/cells"))), new
