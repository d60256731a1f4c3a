"""Near-dedup at a set similarity of word shingles, on the byte-position index of the SimHash operator.

A 64-bit SimHash can't tell a similarity of 0.8: such pairs differ in 7 to 14 bits, where nothing is guaranteed. Here
positional bytes come from minwise hashes of the shingles, so two documents share each with the probability of their
similarity. The index holds each distinct sketch under groups of positional bytes; pairs that meet are verified by the
tally of all their shared positional bytes.

With 21 groups of 6 bytes, a pair of similarity 0.8 meets with probability 0.998, one of 0.9 with 1 - 1e-7. The tally
over 252 bytes has a standard error of 0.025 and only chooses candidates (slack of 0.1, four standard errors, is taken off);
each candidate is then verified by the exact Jaccard similarity of the two sets of shingle hashes.

A list of over most_postings is first tallied against six leaders. The components that verified links make are known
then: where a list's members are in more than one, its members are dealt into blocks, and each pair of blocks is a task in which
every pair of different components is tallied and verified, so each pair in a list is linked or in one component.

Defined cases: null text is empty; documents without words have one common set; texts with fewer words than a shingle are
one shingle; a null id sorts behind every other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import bitmaps, checkpointed, filter_size, maybe_in, once, text_or_empty, without
from sampleprep.llm.components import connected_components
from sampleprep.llm.simhash import fingerprint_of, has_words, shingle_hashes
from sampleprep.llm.simhash import links as simhash_links
from sampleprep.session import map_arrow

BYTES, GROUP, GROUPS, _LEADERS = 252, 6, 21, 6
_RNG = np.random.default_rng(5)
_A = (_RNG.integers(0, 2**31, BYTES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_X = _RNG.integers(0, 2**32, BYTES, dtype=np.uint32)


_SHINGLES = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of all shingles, sorted."""
    return np.unique(shingle_hashes(text, words))


def node_of(found: np.ndarray) -> int:
    """One number for each distinct set of shingles."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(found.tobytes())).view(np.int64))


def sketch(found: np.ndarray, block: int = 1024) -> bytes:
    """One byte of the least hash of all shingles for each of BYTES hash functions."""
    least = np.full(BYTES, 2**32 - 1, np.uint32)
    low = found.astype(np.uint32)
    for at in range(0, len(low), block):
        np.minimum(least, ((low[at : at + block, None] ^ _X) * _A).min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, mark (a hash of the text), fp (SimHash), node, size (shingles) and sketch of each row, from one reading of its text."""
    fields = [("mark", T.LongType()), ("fp", T.LongType()), ("node", T.LongType()), ("size", T.LongType()), ("sketch", T.BinaryType())]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(n, t) for n, t in fields)])

    def made(text: str | None) -> tuple[np.uint64, int, int, bytes]:
        hashes = shingle_hashes(text, words)
        found = np.unique(hashes)
        return np.uint64(fingerprint_of(hashes) if has_words(text) else 0), node_of(found), len(found), sketch(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [made(t.as_py()) for t in batch.column(2)]
            fps = np.array([r[0] for r in rows], np.uint64).view(np.int64)
            columns = [pa.array(fps), *(pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.binary())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.names)

    return map_arrow(docs.select(F.col(id_col).alias("id"), _mark(text_col).alias("mark"), F.col(text_col).alias("text")), run, schema)


def _mark(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col))


def _sets(docs: DataFrame, marks: DataFrame, text_col: str, words: int) -> DataFrame:
    """node and shingles of the texts with these marks, once for each node.

    A bitmap of the marks picks the texts, which stay where they are; a false hit gives a node that nothing asks for.
    """
    hashes = checkpointed(marks.select(F.col("mark").alias("hash")).distinct())
    bits = filter_size(hashes.count())
    read = docs.select(F.col(text_col).alias("text"))
    rows = maybe_in(read, _mark("text"), bitmaps(hashes, bits), bits, "maybe").where("maybe")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), words) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], _SHINGLES.names)

    return checkpointed(map_arrow(rows.select("text"), run, _SHINGLES).groupBy("node").agg(F.first("shingles").alias("shingles")))


def alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """True if the Jaccard similarity of two sorted sets is similarity or more."""
    if min(len(x), len(y)) + 1e-9 < similarity * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared + 1e-9 >= similarity * (len(x) + len(y) - shared)


def _tallied(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """Of (a, b), those that share at least least positional bytes."""
    both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
    both = both.join(nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, BYTES) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    return map_arrow(both, run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of (a, b), those whose sets have this similarity."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v.as_py(), dtype=np.uint64) for v in batch.column(k)] for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array([alike(p, q, similarity) for p, q in zip(x, y, strict=True)], pa.bool_()))

    return map_arrow(both, run, "a long, b long")


def _in_blocks(listed: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame, similarity: float, least: int, rows: int, block_bytes: int) -> DataFrame:
    """More links (a, b) inside the lists (key, node) whose members are in several components, whose roots (node, root) are given.

    Blocks have about rows members and block_bytes of shingles. A pair of blocks gives at most one link for each of its members.
    """
    inside = listed.select("key", "node").join(nodes.select("node", "size", "sketch"), "node").join(roots.select(F.col("node").alias("n"), "root"), F.col("node") == F.col("n"), "left")
    inside = inside.select("key", "node", "size", "sketch", F.coalesce("root", "node").alias("root"))
    wanted = F.ceil(F.greatest(F.count("*") / rows, F.sum("size") * 8 / block_bytes)).cast("int").alias("blocks")
    several = inside.groupBy("key").agg(wanted, F.min("root").alias("least_root"), F.max("root").alias("most_root")).where("least_root < most_root")
    dealt = inside.join(several.select("key", "blocks"), "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("key", "node", "sketch", "root", "own", other).join(sets, "node")
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "sketch", "root", "shingles")

    def block_pair(key: tuple, made: pa.Table) -> pa.Table:
        own, node, root = (made.column(n).to_numpy() for n in ("own", "node", "root"))
        drawn = np.frombuffer(b"".join(made.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, BYTES)
        found = [np.frombuffer(v.as_py(), dtype=np.uint64) for v in made.column("shingles")]
        first, root, a, b = own == key[1].as_py(), root.copy(), [], []
        one = key[1].as_py() == key[2].as_py()
        for x in np.flatnonzero(first):
            rest = np.flatnonzero((root != root[x]) & (np.arange(len(own)) > x if one else ~first))
            for y in rest[(drawn[rest] == drawn[x]).sum(axis=1) >= least]:
                if root[x] != root[y] and alike(found[x], found[y], similarity):
                    a.append(min(node[x], node[y]))
                    b.append(max(node[x], node[y]))
                    root[root == root[y]] = root[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(block_pair, "a long, b long")


def _print_links(marked: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) between the nodes of equal fingerprints, and of those within bits by the SimHash operator's index."""
    prints = checkpointed(marked.groupBy("fp").agg(F.min("node").alias("node"), F.max("node").alias("most")))
    equal = marked.select("fp", F.col("node").alias("a")).join(prints.where("node < most").select("fp", F.col("node").alias("b")), "fp").where("a <> b").select("a", "b")
    linked = simhash_links(prints.select("fp"), bits).withColumnsRenamed({"a": "x", "b": "y"})
    for fp, node in (("x", "a"), ("y", "b")):
        linked = linked.join(prints.select(F.col("fp").alias(fp), F.col("node").alias(node)), fp)
    return equal.unionByName(linked.select("a", "b"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, bits: int | None = 3, similarity: float = 0.8,
    slack: float = 0.1, most_postings: int = 32, block_rows: int = 1024, block_bytes: int = 32 << 20,
) -> DataFrame:
    """id, mark, and keep (the id and mark of the row that stays) of each row that is in a group of several.

    Groups are what SimHash links (bits or fewer differing bits) and links of this similarity reach together; bits None leaves SimHash out.
    """
    marked = checkpointed(sketches(docs, id_col, text_col, words))
    own = F.struct(F.col("id").isNull().alias("none"), "id", "mark")
    nodes = checkpointed(marked.groupBy("node").agg(*[F.first(c).alias(c) for c in ("sketch", "size", "mark")], F.min(own).alias("low"), F.count("*").alias("rows")))
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sketch", k * GROUP + 1, GROUP)) for k in range(GROUPS)])
    postings = nodes.select("node", F.explode(keys).alias("key"))
    mixed = [F.col("node").bitwiseXOR(F.lit(int(c))) for c in _RNG_LEADERS]
    lists = postings.groupBy("key").agg(F.count("*").alias("n"), *[F.min(m).alias(f"m{i}") for i, m in enumerate(mixed)]).where("n > 1")
    listed = checkpointed(postings.join(lists, "key"))
    short, long_lists = listed.where(F.col("n") <= most_postings), listed.where(F.col("n") > most_postings)
    a, b = short.select("key", F.col("node").alias("a")), short.select("key", F.col("node").alias("b"))
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b"))).select("a", "b")
    leaders = F.array(*[F.col(f"m{i}").bitwiseXOR(F.lit(int(c))) for i, c in enumerate(_RNG_LEADERS)])
    led = long_lists.select(F.col("node").alias("a"), F.explode(leaders).alias("b")).where("a <> b")
    led = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    least = int(np.ceil((similarity - slack) * BYTES))
    candidates = checkpointed(_tallied(pairs.unionByName(led).distinct(), nodes, least))
    asked = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node"))).unionByName(long_lists.select("node")).distinct()
    sets = _sets(docs, nodes.join(asked, "node", "left_semi"), text_col, words)

    links = _verified(candidates, sets, similarity)
    roots = connected_components(links if bits is None else links.unionByName(_print_links(marked, bits)))
    if not long_lists.isEmpty():
        more = checkpointed(_in_blocks(long_lists, nodes, sets, roots, similarity, least, block_rows, block_bytes))
        if not more.isEmpty():
            # links between components, and the roots' roots
            for end in ("a", "b"):
                more = more.join(roots.select(F.col("node").alias("n"), "root"), F.col(end) == F.col("n"), "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
            again = connected_components(more).select(F.col("node").alias("n"), F.col("root").alias("upper"))
            roots = roots.join(again, F.col("root") == F.col("n"), "left").select("node", F.coalesce("upper", "root").alias("root"))
            roots = checkpointed(roots.unionByName(again.select(F.col("n").alias("node"), F.col("upper").alias("root"))).distinct())
    rooted = nodes.select("node", "low", "rows").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").where("rows > 1 or root is not null")
    rooted = rooted.select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = checkpointed(rooted.groupBy("root").agg(F.min("low").alias("keep")))
    labels = rooted.join(lowest, "root").select("node", "keep")
    return marked.select("id", "mark", "node").join(labels, "node").select("id", "mark", F.struct("keep.id", "keep.mark").alias("keep"))


_RNG_LEADERS = [0, -1, *np.random.default_rng(6).integers(-(2**62), 2**62, _LEADERS - 2).tolist()]


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, bits: int = 3, similarity: float = 0.8, **options) -> DataFrame:
    """One row of each group stays, with all its columns: the one with the smallest id, null last, then by a hash of the text.

    What is decided is a row (id and text), so rows of one id with different texts go and stay on their own; of repeated
    rows (same id, equal text) one stays.
    """
    grouped = checkpointed(near_groups(docs, id_col, text_col, words, bits, similarity, **options))
    same = F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("mark") == F.col("keep.mark"))
    keys = {"id": F.col(id_col), "mark": _mark(text_col)}
    kept = without(docs, grouped.where(~same), keys)
    return once(kept, grouped.where(same).groupBy("id", "mark").count().where("count > 1"), keys)
