"""Audits of text layout and of written samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sampleprep.functions import text as t


def layout_audit(rows: DataFrame, text: Column) -> DataFrame:
    """Counts over all rows: total, without and with placeholders, deviant."""
    # a generator keeps the layout from being worked out for each counter
    found = rows.select(F.explode(F.array(t.layout(text))).alias("x"))
    return found.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("x.slots") == 0).alias("without_placeholder"),
        F.count_if(F.col("x.slots") > 0).alias("with_placeholder"),
        F.count_if(F.col("x.deviant")).alias("deviant"),
    )


def deviants(rows: DataFrame, text: Column, most: int = 400) -> DataFrame:
    """The deviant rows with slots, flags and a snippet."""
    found = rows.withColumn("x", F.explode(F.array(t.layout(text)))).where("x.deviant")
    flags = F.array_compact(F.array(F.when(F.col("x.leading"), "leading_text"), F.when(F.col("x.between"), "between_text")))
    shown = t.snippet(F.regexp_replace(text, r"\r\n?", "\n"), most)
    return found.select(*[c for c in rows.columns], F.col("x.slots").alias("slots"), F.array_join(flags, ",").alias("flags"), shown.alias("snippet"))


def first_deviant(rows: DataFrame, text: Column, order: list[str], most: int = 400) -> DataFrame:
    return deviants(rows, text, most).orderBy(*order).limit(1)


def check_samples(samples: DataFrame, *others: str) -> DataFrame:
    """Each sample (id, meta_prompt, data) with the checks of its record: keys, roles in turn, kinds of parts; and the columns others."""
    data = F.col("data")
    roles = F.forall(F.transform(data, lambda x, i: x["role"].eqNullSafe(F.when(i % 2 == 0, "user").otherwise("assistant"))), lambda ok: ok)

    def only(role: str, kinds: tuple[str, ...]) -> Column:
        return F.forall(F.filter(data, lambda x: x["role"] == role), lambda x: F.forall(x["content"], lambda p: F.coalesce(p["type"].isin(*kinds), F.lit(False))))

    return samples.select(
        *others,
        "id",
        (F.col("id").isNotNull() & F.col("meta_prompt").eqNullSafe(F.array(F.lit(""))) & F.coalesce(F.size(data) > 0, F.lit(False))).alias("keys_ok"),
        F.coalesce(roles, F.lit(False)).alias("roles_ok"),
        F.coalesce(only("assistant", ("text",)), F.lit(False)).alias("assistant_ok"),
        F.coalesce(only("user", ("text", "image")), F.lit(False)).alias("user_ok"),
    )


def shard_sizes(counts: DataFrame, multiple: int = 16) -> DataFrame:
    """shard_id, n and whether n is a multiple, which the last shard needn't be."""
    last = F.max("shard_id").over(W.partitionBy())
    return counts.select("shard_id", "n", ((F.col("n") % multiple == 0) | (F.col("shard_id") == last)).alias("size_ok"))


def missing_members(references: DataFrame, members: DataFrame) -> DataFrame:
    """References (shard_id, path) without a member of that name in the same shard."""
    return references.join(members.select("shard_id", F.col("name").alias("path")), ["shard_id", "path"], "left_anti")
