"""Best-fit packing by hierarchical residual packing.

Each task tokenises its documents, cuts those over the capacity and packs the pieces best-fit, longest first. Nearly
full bins are done. The others are merged as items: neighbouring tasks' bins come together (a coalesce, no shuffle) and
are packed best-fit again, round after round, until one task is left or a round saves nothing. A bin carries its
pieces (ids, places and checksums, never tokens or texts), so no join puts the result together. A task holds at most
flush pieces of its input at a time, and a later round at most most_bins bins; where more underfull bins
are left than that, more tasks stay.

Defined cases: null text is empty and gives one piece of length 1 (the end id); a null id is kept; repeated rows are packed
each; an empty table gives no rows; texts of any length are cut without gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import checkpointed
from sampleprep.llm.tokens import WordTokens
from sampleprep.session import map_arrow

CAPACITY = 2048


@lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path, keep=250_000)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: each item, longest first, goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: a bin with room r exists
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            held = with_room[room]
            at = held.pop()
            if not held:
                rooms ^= 1 << room
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        room -= size
        if room:
            held = with_room.setdefault(room, [])
            if not held:
                rooms |= 1 << room
            held.append(at)
    return bins


def _merged(members: pa.ListArray, fills: np.ndarray, capacity: int, nearly: int) -> pa.RecordBatch:
    """Pack bins (lists of pieces) into bins; places are counted anew."""
    bins = best_fit(fills, capacity)
    order = np.fromiter((i for b in bins for i in b), dtype=np.int64)
    taken = members.take(pa.array(order))
    sizes = np.diff(np.asarray(taken.offsets))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    cuts = starts[np.concatenate([[0], np.cumsum([len(b) for b in bins])])]
    pieces = taken.flatten()
    lengths = np.asarray(pieces.field("length"), dtype=np.int64)
    upto = np.concatenate([[0], np.cumsum(lengths)])
    offsets = upto[:-1] - np.repeat(upto[cuts[:-1]], np.diff(cuts))
    names = [f.name for f in pieces.type]
    fields = [pa.array(offsets, pa.int64()) if n == "offset" else pieces.field(n) for n in names]
    placed = pa.StructArray.from_arrays(fields, fields=list(pieces.type))
    fill = np.diff(upto[cuts])
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), placed)
    return pa.RecordBatch.from_arrays([pa.array(fill, pa.int32()), pa.array(fill >= capacity - nearly), lists], ["fill", "done", "members"])


def _pieces(ids: list, texts: list, id_type: pa.DataType, path: str, capacity: int, end_id: int) -> tuple[pa.ListArray, np.ndarray]:
    encode, end = _tokens(path).encode, np.uint32(end_id).astype("<u4").tobytes()
    row, piece, start, length, crc = [], [], [], [], []
    for i, text in enumerate(texts):
        tokens = (encode(text) if text else b"") + end
        for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
            part = tokens[at : at + 4 * capacity]
            row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
    columns = {
        "doc_id": pa.array(ids, id_type).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
        "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "offset": pa.array(np.zeros(len(row), np.int64)),
    }
    made = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1), pa.int32()), made), np.array(length, dtype=np.int64)


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = 0, nearly: int = 8, fan_in: int = 8, flush: int = 100_000, most_bins: int = 200_000,
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    nearly: bins with no more room than this are done at once. fan_in: tasks that merge into one in a round.
    """
    id_type = docs.schema[id_col].dataType
    piece_type = T.StructType(
        [
            T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("offset", T.LongType()),
        ]
    )
    schema = T.StructType([T.StructField("fill", T.IntegerType()), T.StructField("done", T.BooleanType()), T.StructField("members", T.ArrayType(piece_type))])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.ListArray, np.ndarray]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                held.append(_pieces(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(0).type, tokenizer_path, capacity, end_id))
                if sum(len(x) for _, x in held) >= flush:
                    yield _merged(pa.concat_arrays([m for m, _ in held]), np.concatenate([x for _, x in held]), capacity, nearly)
                    held = []
        if held:
            yield _merged(pa.concat_arrays([m for m, _ in held]), np.concatenate([x for _, x in held]), capacity, nearly)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            together = pa.Table.from_batches(rows).combine_chunks()
            members = together.column("members")
            members = pa.concat_arrays(members.chunks) if members.num_chunks != 1 else members.chunk(0)
            yield _merged(members, np.asarray(together.column("fill"), dtype=np.int64), capacity, nearly)

    bins = checkpointed(map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), first, schema))
    done, left = [bins.where("done")], bins.where("not done")
    tasks, rows = bins.rdd.getNumPartitions(), left.count()
    while tasks > 1 and rows > 1:
        fewer = max(-(-tasks // fan_in), -(-rows // most_bins))
        if fewer >= tasks:
            break
        bins = checkpointed(map_arrow(left.coalesce(fewer), again, schema))
        done.append(bins.where("done"))
        left = bins.where("not done")
        rows, tasks = left.count(), fewer
    packed = left
    for part in done:
        packed = packed.unionByName(part)
    return (
        packed.withColumn("sequence_id", F.monotonically_increasing_id())
        .select("sequence_id", F.inline("members"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )
