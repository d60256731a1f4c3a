"""Exact dedup by progressive refinement: length, then a prefix hash, then the full hash.

The first pass reads each text once and shuffles only counts by (length, prefix hash), summed before the
shuffle. What can still have a twin is put in a bitmap sized by its count (32 MB at most), which is broadcast; the second
pass computes the full hash only where the bitmap says so and groups by it. Texts are never shuffled. The counts by pair and the
groups are copied, so that each is computed once and a large group's rows are split in the last join. A false hit of
the bitmap costs one hash and one small row, never a wrong result, so results are exact at every size.

Defined cases: null text is the empty text; all empty texts are one group; a null id sorts behind every other
id; of repeated rows with one id one stays; other columns of the input are ignored by the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleprep.llm.common import bitmaps, checkpointed, filter_size, maybe_in, once, text_or_empty, without

#: Runs that one space replaces, but for a single space, which stays what it is.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, _RUNS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, hash_all: bool = False, filter_bits: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_hash, mark (a 64-bit hash of the normalised text).

    hash_all also gives text_hash of texts that have no twin; else it is null for those that the first two steps ruled out.
    filter_bits: bits of the bitmap, by the number of possible twins if not given.
    """
    norm = normalised(text_or_empty(text_col))
    read = docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
    size, prefix = F.octet_length("norm"), F.xxhash64(F.substring("norm", 1, prefix_chars))
    pairs = checkpointed(read.groupBy(size.alias("size"), prefix.alias("prefix")).agg(F.count("*").alias("n")))
    lengths = pairs.groupBy("size").agg(F.sum("n").alias("n")).where("n > 1").select("size")
    alike = checkpointed(pairs.join(lengths, "size", "left_semi").where("n > 1").select(F.xxhash64("size", "prefix").alias("hash")))
    bits = filter_bits or filter_size(alike.count())
    probed = maybe_in(read, F.xxhash64(size, prefix), bitmaps(alike, bits), bits, "maybe")
    full = F.sha2(F.when(F.col("maybe") | F.lit(hash_all), F.col("norm")), 256)
    hashed = checkpointed(probed.select("id", "maybe", full.alias("text_hash"), F.xxhash64("norm").alias("mark"), F.monotonically_increasing_id().alias("row")))

    left = hashed.where("maybe")
    # with a copy of the groups, the join's sides have exchanges of their own, and Spark splits a large group's
    groups = checkpointed(
        left.groupBy("text_hash").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("first"),
            F.count("*").alias("group_size"),
        )
    )
    grouped = left.join(groups, "text_hash").select(
        "id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_hash", "mark"
    )
    alone = hashed.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_hash", "mark"
    )
    return grouped.unionByName(alone)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows (same id, equal text) one stays.

    Full hashes are taken of possible twins only, and texts stay where they are: what moves are the dropped rows' ids, and repeated rows.
    """
    dropped = checkpointed(exact_dedup(docs, id_col, text_col).where("not kept").select("id", "mark", F.col("id").eqNullSafe(F.col("keep_id")).alias("again")))
    keys = {"id": F.col(id_col), "mark": F.xxhash64(normalised(text_or_empty(text_col)))}
    return once(without(docs, dropped.where("not again"), keys), dropped.where("again"), keys)
