"""Joins between samples, members and source rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleprep.functions import text as t


def last_wins(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """The values of each key's last row, by order."""
    packed = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"last.{v}").alias(v) for v in values])


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).agg((F.count("*") - F.count_distinct(key)).alias("duplicates"))


def pair_shards(texts: DataFrame, archives: DataFrame) -> DataFrame:
    """shard_id and whether both of its files are there."""
    a, b = texts.select("shard_id").distinct().withColumn("has_text", F.lit(True)), archives.select("shard_id").distinct().withColumn("has_archive", F.lit(True))
    both = a.join(b, "shard_id", "full_outer")
    return both.select("shard_id", F.coalesce("has_text", F.lit(False)).alias("has_text"), F.coalesce("has_archive", F.lit(False)).alias("has_archive"))


def check_references(references: DataFrame, members: DataFrame, validate: bool = True) -> DataFrame:
    """Counts of references (path) to members (name, size, readable): checked, missing, empty, unreadable, abnormal.

    Without a single member nothing is checked, as there is no archive to hold them against.
    """
    last = members.groupBy("name").agg(F.max_by(F.struct("size", "readable"), F.struct("shard_id", "size")).alias("m"))
    joined = references.select("path").join(last, F.col("path") == F.col("name"), "left")
    missing = F.col("name").isNull()
    empty = ~missing & (F.col("m.size") == 0)
    bad = ~missing & ~empty & ~F.col("m.readable") if validate else F.lit(False)
    counts = joined.agg(F.count("*").alias("checked"), F.count_if(missing).alias("missing"), F.count_if(empty).alias("empty"), F.count_if(bad).alias("unreadable"))
    some = members.limit(1).agg(F.count("*") > 0).scalar()
    kept = counts.select(*[F.when(some, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in ("checked", "missing", "empty", "unreadable")])
    return kept.withColumn("abnormal", F.col("missing") + F.col("empty") + F.col("unreadable"))


def reconcile(source: DataFrame, outputs: DataFrame, members: DataFrame, parity: bool = False) -> DataFrame:
    """Each image's size in the source and in the output, in kB, and the difference.

    source: (sample_id, sizes array, null for an undecodable slot); outputs: (sample_id, paths array) last wins; members: (name, size).
    Output paths are taken by the slot number in their name; parity takes them by their place in the list, as the compacted
    list has it. A slot without a path takes the member named for it as .jpg, then as .png, else the .jpg name.
    """
    paths = outputs.select("sample_id", F.posexplode("paths").alias("place", "path"))
    slot = F.col("place") if parity else F.coalesce(F.regexp_extract("path", r"_(\d+)\.[a-z]+$", 1).try_cast("int"), F.col("place"))
    have = paths.select("sample_id", slot.alias("slot"), "path")
    asked = source.select("sample_id", F.posexplode("sizes").alias("slot", "source_size"))
    both = asked.join(have, ["sample_id", "slot"], "full_outer").join(source.select(F.col("sample_id").alias("known")).distinct(), F.col("sample_id") == F.col("known"), "left_semi")
    names = [t.member_name(F.col("sample_id"), F.col("slot"), F.lit(mime)) for mime in ("image/jpeg", "image/png")]
    # the names a slot may have, best first; one join finds those that are there
    asked = F.when(F.col("path").isNotNull(), F.array("path")).otherwise(F.array(*names))
    both = both.select("sample_id", "slot", "path", "source_size", F.posexplode(asked).alias("place", "name"))
    met = both.join(members.select(F.col("name").alias("n"), F.col("size").alias("member_size")), F.col("name") == F.col("n"), "left")
    best = F.min(F.struct(F.col("n").isNull().alias("absent"), "place", "name", F.col("member_size").alias("size")))
    both = met.groupBy("sample_id", "slot", "path", "source_size").agg(best.alias("best"))
    image, out = F.col("best.name"), F.col("best.size")
    src_kb, out_kb = t.kilobytes(F.when(F.col("source_size") > 0, F.col("source_size"))), t.kilobytes(out)
    return both.select("sample_id", "slot", image.alias("image_id"), src_kb.alias("source_kb"), out_kb.alias("output_kb"), (src_kb - out_kb).alias("diff_kb"))


def report_line(image: Column, *kilobytes: Column) -> Column:
    """A tab-separated line with six places (ties to even), blank for what is missing."""
    return F.concat_ws("\t", image, *[F.when(k.isNull(), "").otherwise(F.format_string("%.6f", F.bround(k, 6))) for k in kilobytes])
