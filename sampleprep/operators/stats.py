"""Counts, distributions, image geometry, censuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Upper bounds and labels of the buckets, in their order; the last label has no bound.
MEGAPIXELS = ((0.05, "<0.05 MP"), (0.15, "0.05–0.15 MP"), (0.5, "0.15–0.5 MP"), (1.0, "0.5–1 MP"), (2.0, "1–2 MP"), (4.0, "2–4 MP"), (None, "≥4 MP"))
SHORT_EDGES = ((320, "<320 px"), (480, "320–479 px"), (640, "480–639 px"), (768, "640–767 px"), (1024, "768–1023 px"), (None, "≥1024 px"))
UNKNOWN = "unknown"


def ratio(n: Column, total: Column) -> Column:
    """n / total to six places, ties to even; 0 of nothing is 0."""
    return F.bround(n.cast("double") / F.greatest(total.cast("double"), F.lit(1.0)), 6)


def _bucket(value: Column, known: Column, bounds: tuple) -> Column:
    found = F.when(~F.coalesce(known, F.lit(False)), UNKNOWN)
    for bound, label in bounds[:-1]:
        found = found.when(value < bound, label)
    return found.otherwise(bounds[-1][1])


def megapixel_bucket(width: Column, height: Column) -> Column:
    return _bucket(width.cast("double") * height / 1e6, (width > 0) & (height > 0), MEGAPIXELS)


def short_edge_bucket(width: Column, height: Column) -> Column:
    return _bucket(F.least(width, height), (width > 0) & (height > 0), SHORT_EDGES)


def bucket_order(bounds: tuple) -> list[str]:
    return [label for _, label in bounds] + [UNKNOWN]


def distribution(df: DataFrame, *keys: str, total: Column | None = None) -> DataFrame:
    """key columns, n and ratio; the ratio is of all rows unless total says otherwise."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    everything = F.sum("n").over(W.partitionBy()) if total is None else total
    return counted.withColumn("ratio", ratio(F.col("n"), everything))


def distributions(df: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """One row per (dimension, key): the distributions of several columns from one pass with grouping sets; weight: how many rows a row stands for."""
    each = F.lit(1).cast("long") if weight is None else F.col(weight)
    named = df.select(*[F.col(k).cast("string").alias(k) for k in keys], each.alias("weight_"))
    sets = named.groupingSets([[F.col(k)] for k in keys] + [[]], *keys).agg(F.coalesce(F.sum("weight_"), F.lit(0)).alias("n"), F.grouping_id().alias("g"))
    bits = {k: (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    dimension = key = None
    for k, g in bits.items():
        at = F.col("g") == g
        dimension = F.when(at, k) if dimension is None else dimension.when(at, k)
        key = F.when(at, F.col(k)) if key is None else key.when(at, F.col(k))
    everything = F.max(F.when(F.col("g") == (1 << len(keys)) - 1, F.col("n"))).over(W.partitionBy())
    rows = sets.select(dimension.alias("dimension"), key.alias("key"), "n", ratio(F.col("n"), everything).alias("ratio"))
    return rows.where("dimension is not null")


def geometry(images: DataFrame) -> DataFrame:
    """Counts of images (source, width, height) by source and bucket, by bucket, by source, and in all, from one pass.

    Columns scope (the source, or null for all), kind (total, megapixel, short_edge), bucket, n, unknown, and the least and largest
    width and height of images whose size is known (sources' totals only).
    """
    w, h = F.col("width"), F.col("height")
    known = (w > 0) & (h > 0)
    rows = images.select("source", megapixel_bucket(w, h).alias("mp"), short_edge_bucket(w, h).alias("edge"), F.coalesce(known, F.lit(False)).alias("known"), w, h)
    cols = [F.col(c) for c in ("source", "mp", "edge")]
    s, m, e = cols
    sets = rows.groupingSets([[s, m], [s, e], [s], [m], [e], []], *cols).agg(
        F.grouping_id().alias("g"),
        F.count("*").alias("n"),
        F.count_if(~F.col("known")).alias("unknown"),
        *[f(F.when(F.col("known"), F.col(c))).alias(f"{c}_{n}") for c in ("width", "height") for n, f in (("min", F.min), ("max", F.max))],
    )
    return _scoped(sets)


def _scoped(sets: DataFrame) -> DataFrame:
    """scope, kind and bucket from the grouping id; extremes for sources' totals only."""
    kind = F.when(F.col("g").isin(1, 5), "megapixel").when(F.col("g").isin(2, 6), "short_edge").otherwise("total")
    scope = F.when(F.col("g") < 4, F.col("source"))
    extremes = [F.when(F.col("g") == 3, F.col(c)).alias(c) for c in ("width_min", "width_max", "height_min", "height_max")]
    return sets.select(scope.alias("scope"), kind.alias("kind"), F.coalesce("mp", "edge").alias("bucket"), "n", "unknown", *extremes)


_ENDS = [(f"{c}_{n}", n) for c in ("width", "height") for n in ("min", "max")]


def geometry_states(images: DataFrame, *by: str) -> DataFrame:
    """The aggregate of geometry() in parts that can be stored and merged: n, unknown and extremes by (by, source, both buckets)."""
    w, h = F.col("width"), F.col("height")
    known = F.coalesce((w > 0) & (h > 0), F.lit(False))
    rows = images.select(*by, "source", megapixel_bucket(w, h).alias("mp"), short_edge_bucket(w, h).alias("edge"), known.alias("known"), w, h)
    ends = [(F.min if n == "min" else F.max)(F.when(F.col("known"), F.col(c.rpartition("_")[0]))).alias(c) for c, n in _ENDS]
    return rows.groupBy(*by, "source", "mp", "edge").agg(F.count("*").alias("n"), F.count_if(~F.col("known")).alias("unknown"), *ends)


def merge_geometry(states: DataFrame) -> DataFrame:
    """What geometry() gives for all images of some states together."""
    s, m, e = (F.col(c) for c in ("source", "mp", "edge"))
    sets = states.groupingSets([[s, m], [s, e], [s], [m], [e], []], s, m, e).agg(
        F.grouping_id().alias("g"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown"),
        *[(F.min if n == "min" else F.max)(c).alias(c) for c, n in _ENDS],
    )
    return _scoped(sets)


def ranked(dist: DataFrame, key: str = "key", n: str = "n") -> DataFrame:
    return dist.orderBy(F.desc(n), F.asc(key))


def top_k(dist: DataFrame, k: int, key: str = "key", n: str = "n") -> DataFrame:
    return ranked(dist, key, n).limit(k)


def top_with_rest(dist: DataFrame, most: int, rest: str = "others", key: str = "key", n: str = "n") -> DataFrame:
    """The most - 1 (at least 2) largest keys and the sum of the rest; all keys if there are no more than most (at least 3)."""
    most = max(3, most)
    # the ranks come from the largest keys alone, so no window has to hold all keys
    head = ranked(dist, key, n).limit(most + 1).withColumn("rank", F.row_number().over(W.orderBy(F.desc(n), F.asc(key))))
    kept = head.where((F.col("rank") < most) | (F.col("rank") == most) & (head.agg(F.max("rank")).scalar() == most)).select(key, n)
    total = dist.agg((F.sum(n) - kept.agg(F.sum(n)).scalar()).alias(n)).select(F.lit(rest).alias(key), n)
    return kept.unionByName(total.where(F.col(n) > 0))


def dense_heatmap(by_source: DataFrame, sources: int, bounds: tuple) -> DataFrame:
    """source, bucket, n for the largest sources (at least 3) and every bucket, 0 where there is none."""
    top = by_source.groupBy("source").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "source").limit(max(3, sources))
    cells = top.select("source", F.explode(F.array(*[F.lit(b) for b in bucket_order(bounds)])).alias("bucket"))
    return cells.join(by_source.select("source", "bucket", "n"), ["source", "bucket"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def parse_distribution(text: Column) -> Column:
    """Array of key, n from JSON like {"key": {"count": n}}; entries without a whole count are left out."""
    entries = F.map_entries(F.from_json(text, "map<string,string>"))
    made = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), F.get_json_object(e["value"], "$.count").try_cast("long").alias("n")))
    return F.filter(F.coalesce(made, F.array().cast("array<struct<key:string,n:bigint>>")), lambda e: e["n"].isNotNull())


def census(rows: DataFrame) -> DataFrame:
    """Over (slots, shape): totals by shape, and one row for all with shape null."""
    return rows.groupingSets([[F.col("shape")], []], "shape").agg(
        F.grouping_id().alias("overall"),
        F.count("*").alias("rows"),
        F.coalesce(F.sum("slots"), F.lit(0)).cast("long").alias("slots"),
        F.count_if(F.col("slots") == 0).alias("without_slots"),
        F.bround(F.coalesce(F.avg("slots"), F.lit(0.0)), 6).alias("average"),
    )


def slot_histogram(rows: DataFrame) -> DataFrame:
    """Over (slots, …): how many rows have so many slots."""
    return rows.groupBy("slots").agg(F.count("*").alias("n"))


def slot_validity(slots: DataFrame) -> DataFrame:
    """Over (decoded, readable): how many are checked, fine, not decoded, not readable."""
    fails = F.col("decoded").isNull()
    good = F.coalesce(F.col("readable"), F.lit(False))
    return slots.agg(
        F.count("*").alias("checked"),
        F.count_if(~fails & good).alias("ok"),
        F.count_if(fails).alias("decode_failed"),
        F.count_if(~fails & ~good).alias("invalid"),
    )
