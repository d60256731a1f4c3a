"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of their id. A document's virtual finish time is the words of its
source up to and with it, divided by the source's weight; copies for later epochs follow after all words of the
source. The copies of all sources are range-sorted by finish time and cut where the total budget (all words) is
spent. A source that has given max_repeats copies of itself drops out, and the others share on by weight, so the cut
gives exactly the capped targets but for a document.

Prefix sums take two levels (hash buckets in a source, then rows in a bucket), so a source with any share of the
rows is spread over about sqrt(rows) tasks of about sqrt(rows) rows. Only words and ids are shuffled, never texts.

Defined cases: null text has no words; a null source is a source, last; documents without words take 0; an empty
table gives an empty result; repeated rows with one id count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sampleprep.llm.common import WORD, checkpointed, free_name, text_or_empty

_SOURCE = ["no_source", "source"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """no_source, source, weight, source_size, target: shares of all words by weight, capped, the excess reshared.

    Sources by code point, null last, weigh weights[0], weights[1], ..., repeating. With the sources ordered by cap /
    weight, a prefix of them is capped, and the rest share what is left by weight.
    """
    sources = sizes.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    # windows over the table of sources, one row for each
    rank = F.row_number().over(W.orderBy(*_SOURCE)) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")))
    sources = sources.withColumn("cap", F.col("source_size") * max_repeats)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), *_SOURCE)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    sources = sources.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "level": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "spent": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        }
    )
    sources = sources.withColumn("level", (F.col("total") - F.col("spent")) / F.col("level"))
    free = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(free, F.lit(float("inf"))))
    return sources.select(*_SOURCE, "weight", "source_size", target.alias("target"))


def finish_times(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, max_repeats: int, weights: tuple[int, ...]) -> tuple[DataFrame, int]:
    """A row for each document with the finish time of its first copy; and the total budget."""
    sizes = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.col(source_col).isNull().alias("no_source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
    )
    sizes = checkpointed(sizes.withColumns({"shuffle": F.xxhash64(F.lit(seed), F.col("id").cast("string")), "row": F.monotonically_increasing_id()}))
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bits = max(0, round(max(n, 1).bit_length() / 2))
    sizes = sizes.withColumn("bucket", F.shiftrightunsigned("shuffle", 64 - bits) if bits else F.lit(0).cast("long"))
    buckets = sizes.groupBy(*_SOURCE, "bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    sources = source_targets(sizes, weights, max_repeats)
    sources = sources.select(F.col("source").alias("s"), "weight", "source_size", "target")
    offsets = buckets.join(sources, F.col("source").eqNullSafe(F.col("s"))).select("s", F.col("bucket").alias("b"), "offset", "weight", "source_size", "target")
    joined = sizes.join(offsets, sizes["source"].eqNullSafe(offsets["s"]) & (sizes["bucket"] == offsets["b"])).drop("s", "b")
    upto = W.partitionBy(*_SOURCE, "bucket").orderBy("shuffle", "id", "size", "row").rowsBetween(W.unboundedPreceding, 0)
    words = F.col("offset") + F.sum("size").over(upto)
    return joined.withColumn("words", words), total


def _order(epoch: Column, of: Column | None = None) -> Column:
    """Finish time, shuffle, row and epoch of a copy; of: the struct that holds a document's columns, if not the row itself."""
    words, source_size, weight, shuffle, row = (F.col(c) if of is None else of[c] for c in ("words", "source_size", "weight", "shuffle", "row"))
    return F.struct(((words + epoch * source_size) / weight).alias("finish"), shuffle.alias("shuffle"), row.alias("row"), epoch.alias("epoch"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 7,
) -> DataFrame:
    """A row for each document: id, size, source, source_size, target, weight, copies (0 to max_repeats).

    words (of its shuffled source up to and with it), shuffle and row give the order; mixed_sequence() has all copies in it.
    """
    timed, total = finish_times(docs, id_col, text_col, source_col, seed, max_repeats, weights)
    timed = checkpointed(timed)
    copies = timed.select(F.explode(F.array(*[_order(F.lit(e)) for e in range(max_repeats)])).alias("at"), "size")
    ranged = checkpointed(copies.repartitionByRange("at").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.sum("size").alias("words"))
    # one row for each partition of the range sort
    parts = parts.withColumn("upto", F.sum("words").over(W.orderBy("part")))
    over = parts.where(F.col("upto") > total).orderBy("part").select("part", (F.col("upto") - F.col("words")).alias("given")).first()
    count = F.lit(max_repeats)
    if over is not None:
        upto = F.lit(over.given) + F.sum("size").over(W.partitionBy("part").orderBy("at"))
        first_out = ranged.where(F.col("part") == over.part).withColumn("upto", upto).where(F.col("upto") > total).agg(F.min("at").alias("at")).first().at
        cut = F.struct(F.lit(first_out.finish).alias("finish"), F.lit(first_out.shuffle).alias("shuffle"), F.lit(first_out.row).alias("row"), F.lit(first_out.epoch).alias("epoch"))
        count = sum(((_order(F.lit(e)) < cut).cast("int") for e in range(max_repeats)), F.lit(0))
    return timed.select("id", "size", "source", "source_size", "target", "weight", "shuffle", "row", "words", count.alias("copies"))


def mixed_sequence(mixed: DataFrame) -> DataFrame:
    """All copies of mix_sources() in mixed order: range-sorted by finish time."""
    return (
        mixed.where("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("at", _order(F.col("epoch")))
        .orderBy("at")
        .select("id", "epoch", "size", "source", F.col("at.finish").alias("finish"))
    )


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents with all their columns, a row for each copy, range-sorted by finish time: the mix as a sequence.

    Of rows with the same id, source and size each takes the copies of one of them.
    """
    name, number = free_name(docs, "mixed"), free_name(docs, "number")
    mixed = checkpointed(mix_sources(docs, id_col, text_col, source_col, **options).where("copies > 0"))
    same = ["id", "source", "size"]
    repeated = not mixed.groupBy(*same).count().where("count > 1").isEmpty()
    count = (lambda keys, order: F.row_number().over(W.partitionBy(*keys).orderBy(order))) if repeated else (lambda keys, order: F.lit(1))
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")
    taken = mixed.withColumn("number", count(same, F.col("row"))).select(F.struct("*").alias(name))
    rows = docs.withColumn(number, count([F.col(id_col), F.col(source_col), size], F.monotonically_increasing_id()))
    met = rows[id_col].eqNullSafe(F.col(f"{name}.id")) & rows[source_col].eqNullSafe(F.col(f"{name}.source")) & (size == F.col(f"{name}.size")) & (F.col(number) == F.col(f"{name}.number"))
    joined = rows.join(taken.hint("shuffle_hash"), met)
    at = F.transform(F.sequence(F.lit(0), F.col(f"{name}.copies") - 1), lambda e: _order(e, F.col(name)))
    return joined.withColumn(name, F.explode(at)).orderBy(name).select(docs.columns)
