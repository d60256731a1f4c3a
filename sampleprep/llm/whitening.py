"""Embedding whitening with a covariance weighted by multiplicity.

Entries are scaled to whole numbers, so that equal vectors are equal exactly. Rows are grouped by their scaled vector: the count of a group,
or one, is its weight in the fit. Sums are exact; the covariance is a weighted product of centred matrices, one partial
product for each task, summed by Spark cell by cell. The driver sees d sums and d * d cells (d entries a vector) and solves for the
components. Each distinct vector is whitened once, and the rows get its values by a join on the digest of their vector, so
vectors move once, when they are grouped, and copies are counted before that.

Defined cases: a null vector, one without entries and one with null or non-finite entries is dropped; entries too large for a long
are its bounds; of vectors of several lengths those of the length that most distinct vectors have stay (ties: the smaller);
a component without variance gives null; so does a deviation beyond a long; a null id keeps its rows; repeated rows each give
rows; an empty table gives none; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import checkpointed
from sampleprep.session import map_arrow

#: A variance below this share of the largest counts as none.
NO_VARIANCE = 1e-13
_LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """n: total weight; sums: of each entry, weighted; axes: a column for each component; variances: theirs; total: of all components."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    total: float


def scaled(vector: Column, scale: int) -> Column:
    """Entries times scale, rounded down, as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """True for vectors with entries that are all finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch], d: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors (column x) as a matrix; without d, a part for each length."""
    for batch in batches:
        sizes = np.diff(batch.column("x").offsets.to_numpy())
        for size in np.unique(sizes) if d is None else [d]:
            part = batch.filter(pa.array(sizes == size))
            if part.num_rows:
                yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, int(size))


def _sums(x: np.ndarray, weights: np.ndarray) -> list[int]:
    small = float(np.abs(x.astype(float)).max()) * float(weights.sum()) < 2.0**62
    return [int(s) for s in (weights @ x if small else weights.astype(object) @ x.astype(object))]


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly: longs, or Python's integers where those are too small."""
    high = float(np.abs(x.astype(float)).max(initial=0)) * n + float(max(map(abs, sums)))
    if high < 2.0**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def deviations(centre: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; null beyond a long."""
    if float((centre.astype(float) ** 2).sum(axis=1).max(initial=0)) < 2.0**62:
        return [int(s) for s in (centre**2).sum(axis=1)]
    return [s if s <= _LONG else None for s in (sum(int(v) ** 2 for v in row) for row in centre)]


def group_vectors(rows: DataFrame) -> DataFrame:
    """key, x and copies of each distinct vector x; rows have key and x."""
    return checkpointed(rows.groupBy("key", "x").agg(F.count("*").alias("copies")))


def fit(groups: DataFrame, weights: str = "one") -> Whitening | None:
    """The whitening of groups (x, copies), each weighing one, or its copies (weights="copies"); None without groups."""
    if weights not in ("one", "copies"):
        raise ValueError("weights: one or copies")
    weighed = groups.select("x", F.lit(1).cast("long").alias("weight") if weights == "one" else F.col("copies").alias("weight"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            w, d = part.column("weight").to_numpy(), x.shape[1]
            sums = pa.array([int(s) for s in _sums(x, w)], type=pa.decimal128(38, 0))
            n, many = (pa.array(np.full(d, v, dtype=np.int64)) for v in (w.sum(), len(w)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, dtype=np.int32)), pa.array(np.arange(d, dtype=np.int32)), sums, n, many], ["d", "i", "s", "n", "many"])

    parts = map_arrow(weighed, add, "d int, i int, s decimal(38,0), n long, many long")
    stats = checkpointed(parts.groupBy("d", "i").agg(F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("n").alias("n"), F.sum("many").alias("many")))
    most = stats.where("i = 0").orderBy(F.desc("many"), "d").first()
    if most is None:
        return None
    d, n = most.d, most.n
    sums = tuple(int(r.s) for r in stats.where(F.col("d") == d).orderBy("i").collect())

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for part, x in _matrices(batches, d):
            centre = (centred(x, n, sums) / n).astype(float)
            total += (centre * part.column("weight").to_numpy()[:, None]).T @ centre
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.ravel())], ["cell", "v"])

    cells = map_arrow(weighed, multiply, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    covariance = np.zeros(d * d)
    for r in cells.collect():
        covariance[r.cell] = r.v / n
    values, vectors = np.linalg.eigh(covariance.reshape(d, d))
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, np.arange(d)] < 0, -1.0, 1.0)  # of the two signs the one with a positive largest entry
    return Whitening(n, sums, vectors, values, float(np.trace(covariance.reshape(d, d))))


def apply(groups: DataFrame, model: Whitening, components: int) -> DataFrame:
    """key, deviation and whitened (an array of doubles) of the groups whose vectors have the model's length."""
    d, k = len(model.sums), min(components, len(model.sums))
    variances = model.variances[:k]
    flat = variances <= NO_VARIANCE * max(model.variances[0], 0.0)
    out = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, d):
            centre = centred(x, model.n, model.sums)
            with np.errstate(divide="ignore", invalid="ignore"):
                white = ((centre / model.n).astype(float) @ model.axes[:, :k]) / np.sqrt(variances)
            white = pa.array(white.ravel(), mask=np.tile(flat, len(white)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), white)
            yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.binary()), pa.array(deviations(centre), type=pa.int64()), lists], ["key", "deviation", "whitened"])

    return map_arrow(groups.select("key", "x"), run, out)


def identity_error(white: DataFrame, model: Whitening, components: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over the components that have variance.

    white: copies (weight) and whitened of the fit's vectors.
    """
    k = int((model.variances[: min(components, len(model.sums))] > NO_VARIANCE * max(model.variances[0], 0.0)).sum())
    if not k:
        return 0.0
    at = [F.col("whitened")[i] for i in range(k)]
    total = F.sum("weight")
    means = white.agg(*[(F.sum(F.col("weight") * at[i]) / total).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = white.agg(*[(F.sum(F.col("weight") * (at[i] - means[i]) * (at[j] - means[j])) / total).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256, weights: str = "one"
) -> DataFrame:
    """A row for each usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    vector = F.col(vector_col)
    usable_rows = rows.where(usable(vector)).select(F.col(id_col).alias("id"), scaled(vector, scale).alias("x"))
    keyed = usable_rows.select("id", "x", F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256)).alias("key"))
    groups = group_vectors(keyed.select("key", "x"))
    model = fit(groups, weights)
    if model is None:
        columns = T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double")
        return rows.sparkSession.createDataFrame([], T.StructType([T.StructField("id", rows.schema[id_col].dataType), *columns]))
    white = checkpointed(apply(groups, model, components))
    weighed = white.withColumn("weight", F.lit(1)) if weights == "one" else white.join(groups.select("key", F.col("copies").alias("weight")), "key")
    error = identity_error(weighed, model, components)
    share = [float(v / model.total) if model.total > 0 else 0.0 for v in model.variances[:components]]
    joined = keyed.select("id", "key").join(white, "key").select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return joined.select(
        "id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(s) for s in share]), F.col("place") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
