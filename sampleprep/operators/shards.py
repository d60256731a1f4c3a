"""Ordinals, caps, shards and pages. The order of rows is always (file, row in file)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: A list of files is broadcast up to this many (some 20 MB); a longer one is joined by shuffle.
MOST_FILES = 200_000


def with_file_order(df: DataFrame) -> DataFrame:
    """Columns file_index (files sorted by path) and row_in_file for a frame read from files."""
    files = sorted(df.inputFiles())
    index = df.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], "path string, file_index int")
    index = index.select(F.regexp_replace("path", "^file:/+", "/").alias("__file"), "file_index")
    rows = df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("row_in_file"))
    key = F.regexp_replace("__path", "^file:/+", "/")
    return rows.join(F.broadcast(index) if len(files) <= MOST_FILES else index, key == F.col("__file")).drop("__path", "__file")


def prefix_sums(counts: DataFrame, key: str, n: str) -> DataFrame:
    """start and end (the last ordinal) of each key's rows; for tables with a row per file or shard."""
    upto = F.sum(n).over(W.orderBy(key).rowsBetween(W.unboundedPreceding, 0))
    return counts.select(key, n, (upto - F.col(n)).alias("start"), (upto - 1).alias("end"))


def capped(df: DataFrame, cap: int, counts: DataFrame | None = None) -> DataFrame:
    """The first cap rows by (file_index, row_in_file): the file where the cap falls is found from row counts, nothing is sorted.

    counts: file_index and n of the files, where they are known without a scan.
    """
    sums = prefix_sums(df.groupBy("file_index").agg(F.count("*").alias("n")) if counts is None else counts, "file_index", "n")
    cut = sums.where(F.col("end") >= cap).orderBy("file_index").select("file_index", (F.lit(cap) - F.col("start")).alias("rows")).first()
    if cut is None:
        return df
    return df.where((F.col("file_index") < cut.file_index) | (F.col("file_index") == cut.file_index) & (F.col("row_in_file") < cut.rows))


def first_of_each_file(df: DataFrame, most: int, order: str = "row_in_file") -> DataFrame:
    """At most the first most rows of each file, or lines of each shard by line_idx."""
    return df.where(F.col(order) < most)


def write_ordinals(df: DataFrame, group: str, order: str, width: int = 1 << 16) -> DataFrame:
    """ordinal over all rows by (group, order); order is a whole number.

    Rows are numbered inside ranges of order that are width wide, and the ranges by their row counts, so a group of any size is
    spread over tasks of at most width rows (as order is unique in a group).
    """
    ranged = df.withColumn("range_", F.floor(F.col(order) / width))
    before = W.orderBy(group, "range_").rowsBetween(W.unboundedPreceding, -1)
    counts = ranged.groupBy(group, "range_").agg(F.count("*").alias("n"))
    starts = counts.select(F.col(group).alias("g_"), F.col("range_").alias("r_"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start_"))
    joined = ranged.join(starts, ranged[group].eqNullSafe(F.col("g_")) & (F.col("range_") == F.col("r_")))
    inside = F.row_number().over(W.partitionBy(group, "range_").orderBy(order)) - 1
    return joined.withColumn("ordinal", F.col("start_") + inside).drop("g_", "r_", "start_", "range_")


def assign_shards(ordered: DataFrame, shard_size: int) -> DataFrame:
    """shard_id and line_idx from ordinal."""
    return ordered.withColumns({"shard_id": F.floor(F.col("ordinal") / shard_size).cast("int"), "line_idx": (F.col("ordinal") % shard_size).cast("int")})


def shard_counts(assigned: DataFrame, shard_size: int, emit_trailing_empty: bool = True) -> DataFrame:
    """shard_id and n; a full last shard (or no rows at all) is followed by an empty one."""
    counts = assigned.groupBy("shard_id").agg(F.count("*").alias("n"))
    return with_trailing(counts, shard_size) if emit_trailing_empty else counts


def with_trailing(counts: DataFrame, shard_size: int) -> DataFrame:
    """Shards' counts with the empty shard that follows a full last one."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    trailing = total.where(F.col("rows") % shard_size == 0).select(F.floor(F.col("rows") / shard_size).cast("int").alias("shard_id"), F.lit(0).cast("long").alias("n"))
    return counts.unionByName(trailing)


def segments(rows: DataFrame, group: str, order: str, shard_size: int) -> DataFrame:
    """first, last and n of each shard's rows in each group: where all shards lie, from two narrow columns."""
    placed = assign_shards(write_ordinals(rows.select(group, order), group, order), shard_size)
    return placed.groupBy(group, "shard_id").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def place(rows: DataFrame, laid: DataFrame, group: str, order: str, shard_size: int) -> DataFrame:
    """shard_id of each row by the shards' segments, met by bands of order.

    The segments are about as many as shards and groups; up to MOST_FILES they are broadcast, so that wide rows stay where they are.
    """
    width = shard_size * 8
    band = lambda c: F.floor(F.col(c) / width)
    bands = laid.select(F.col(group).alias("g_"), "shard_id", "first", "last", F.explode(F.sequence(band("first"), band("last"))).alias("b_"))
    few = bands.count() <= MOST_FILES
    met = (F.col(group) == F.col("g_")) & (band(order) == F.col("b_")) & F.col(order).between(F.col("first"), F.col("last"))
    return rows.join(F.broadcast(bands) if few else bands, met).drop("g_", "b_", "first", "last")


def locate(ordinals: DataFrame, index: DataFrame) -> DataFrame:
    """shard_id and line_idx of each ordinal by the shards' ranges (start, end).

    Ordinals are cut into bands as wide as the largest shard, so that each range lies in two bands at most and the join is an equality.
    """
    width = F.max(F.greatest(F.col("end") - F.col("start") + 1, F.lit(1))).over(W.partitionBy())
    bands = index.where("end >= start").withColumn("width", width)
    bands = bands.withColumn("band", F.explode(F.sequence(F.floor(F.col("start") / F.col("width")), F.floor(F.col("end") / F.col("width")))))
    asked = ordinals.withColumn("band", F.floor(F.col("ordinal") / bands.agg(F.max("width")).scalar()))
    found = asked.join(bands.drop("width", "n"), "band").where(F.col("ordinal").between(F.col("start"), F.col("end")))
    return found.select(*ordinals.columns, "shard_id", (F.col("ordinal") - F.col("start")).alias("line_idx"))


def page(ordered: DataFrame, number: int, size: int = 10) -> DataFrame:
    """Rows of a page (from 1) by ordinal; numbers outside are moved to the first or last page."""
    at = ordered.agg(F.greatest(F.lit(1), F.least(F.lit(number), F.ceil((F.max("ordinal") + 1) / size)))).scalar()
    return ordered.where((F.col("ordinal") >= (at - 1) * size) & (F.col("ordinal") < at * size))


def filtered_page(rows: DataFrame, after: tuple[int, int] | None, size: int = 10) -> DataFrame:
    """The next size rows after (shard_id, line_idx): a resumable cursor."""
    if after is not None:
        rows = rows.where(F.struct("shard_id", "line_idx") > F.struct(F.lit(after[0]).alias("shard_id"), F.lit(after[1]).alias("line_idx")))
    return rows.orderBy("shard_id", "line_idx").limit(size)
