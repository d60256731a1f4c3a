"""Helpers of the operators in this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of one bitmap of Spark's bitmap functions.
_BITMAP = 8 * 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the folder named by spark.checkpoint.dir, which every executor reaches.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def filter_size(keys: int, bits_a_key: int = 16, most: int = 1 << 28) -> int:
    """Bits of a filter for so many keys: a power of two, 32 MB at most; a filter that is too full only lets more rows pass."""
    return min(most, max(_BITMAP, 1 << (bits_a_key * keys).bit_length()))


def bitmaps(hashes: DataFrame, bits: int) -> DataFrame:
    """A set of 64-bit hashes (column hash) as rows of 4 KB of a bitmap with so many bits."""
    slot = (F.pmod("hash", F.lit(bits)) + 1).alias("slot")
    return hashes.select(slot).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def maybe_in(rows: DataFrame, hashed: Column, made: DataFrame, bits: int, into: str) -> DataFrame:
    """rows with a column that is false only where the hash is surely not in the bitmaps; these are broadcast (32 MB at most)."""
    slot, bucket, bitmap = (free_name(rows, n) for n in ("slot", "bucket", "bitmap"))
    probed = rows.withColumn(slot, F.pmod(hashed, F.lit(bits)) + 1).withColumn(bucket, F.bitmap_bucket_number(slot))
    probed = probed.join(F.broadcast(made.withColumnsRenamed({"bucket": bucket, "bitmap": bitmap})), bucket, "left")
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8).cast("int") + 1)) != 0
    return probed.withColumn(into, F.coalesce(hit, F.lit(False))).select(*rows.columns, into)


def without(rows: DataFrame, gone: DataFrame, keys: dict[str, Column], most_broadcast: int = 500_000) -> DataFrame:
    """rows whose keys are not in gone, whose columns are named as keys; nulls are equal.

    Up to most_broadcast rows of gone are broadcast. Beyond it only rows that a bitmap of gone lets pass are shuffled, so
    the rows that surely stay are not.
    """
    gone = checkpointed(gone.select(*keys).distinct())
    taken = {k: free_name(rows, f"gone_{k}") for k in keys}
    named = gone.withColumnsRenamed(taken)
    n = gone.count()
    if n == 0:
        return rows

    def anti(some: DataFrame, other: DataFrame) -> DataFrame:
        same = None
        for k, column in keys.items():
            equal = column.eqNullSafe(F.col(taken[k]))
            same = equal if same is None else same & equal
        return some.join(other, same, "left_anti")

    if n <= most_broadcast:
        return anti(rows, F.broadcast(named))
    bits, hit = filter_size(n), free_name(rows, "hit")
    probed = maybe_in(rows, F.xxhash64(*keys.values()), bitmaps(gone.select(F.xxhash64(*keys).alias("hash")), bits), bits, hit)
    return probed.where(~F.col(hit)).drop(hit).unionByName(anti(probed.where(hit).drop(hit), named.hint("shuffle_hash")))


def once(rows: DataFrame, repeated: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """rows with one of each key in repeated, whose columns are named as keys; all others as they are.

    Only rows that a bitmap of the repeated keys lets pass are shuffled; copies are dropped before that, too.
    """
    hashes = checkpointed(repeated.select(F.xxhash64(*keys).alias("hash")).distinct())
    n = hashes.count()
    if n == 0:
        return rows
    bits, hit = filter_size(n), free_name(rows, "hit")
    probed = maybe_in(rows, F.xxhash64(*keys.values()), bitmaps(hashes, bits), bits, hit)
    named = {free_name(rows, f"key_{k}"): c for k, c in keys.items()}
    few = probed.where(hit).drop(hit).withColumns(named).dropDuplicates([*named]).drop(*named)
    return probed.where(~F.col(hit)).drop(hit).unionByName(few)
