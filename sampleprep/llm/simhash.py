"""SimHash near-dedup with a byte-position inverted index and count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most d bits share at least
8 - d of them. The inverted index holds each distinct fingerprint under combinations of three positional bytes,
chosen so that any five shared bytes contain one of them; pairs that meet are tallied (shared positional bytes), kept
from the guaranteed minimum on, and verified by their differing bits. Copies meet only once, as one fingerprint.

A posting list over most_postings is not paired. Its fingerprints are indexed again under five positional bytes, and
lists that are still over it are solved by probing: each fingerprint looks up every value of the three other
bytes within d bits, in the table of fingerprints. Both are exact and linear in the list.

Defined cases: null or empty text, or one without words: fingerprint zero, linked like any other; a null id gets a
fingerprint and a component; a component of null ids only has a null component id; repeated rows get the same
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import WORD, checkpointed
from sampleprep.llm.components import connected_components
from sampleprep.session import map_arrow

_WORDS = re.compile(WORD.encode())
#: Triples of byte positions: any five of eight positions have three in one half.
_TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of all word shingles in order, repeats included; fewer words are one shingle; without words the hash of the empty one."""
    from xxhash import xxh64_intdigest

    found = _WORDS.findall((text or "").encode("utf-8", "replace").lower())
    if len(found) < words:
        found, words = [b" ".join(found)], 1
    parts = zip(*(found[k : len(found) - words + 1 + k] for k in range(words)), strict=True)
    return np.fromiter((xxh64_intdigest(b" ".join(s), seed) for s in parts), dtype="<u8", count=len(found) - words + 1)


def fingerprint_of(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bit i is 1 if set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), block):
        ones += np.unpackbits(hashes[at : at + block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def has_words(text: str | None) -> bool:
    return bool(text) and _WORDS.search(text.encode("utf-8", "replace")) is not None


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text's word shingles; zero without words."""
    return fingerprint_of(shingle_hashes(text, words, seed)) if has_words(text) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """id and fp (the fingerprint's 64 bits as a long) of each row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words, seed) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def _key(number: int, fp: Column, places: tuple[int, ...]) -> Column:
    key = F.lit(number).cast("long")
    for i in places:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, i))
    return key


def _postings(fps: DataFrame, places: list[tuple[int, ...]]) -> DataFrame:
    return fps.select("fp", F.explode(F.array(*[_key(k, F.col("fp"), p) for k, p in enumerate(places)])).alias("key"))


def _pairs(postings: DataFrame, bits: int, least_shared: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Links among the postings of lists up to most; the postings of longer lists."""
    lengths = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    listed = postings.join(lengths, "key")
    short = listed.where(F.col("n") <= most).select("key", "fp")
    a, b = short.select("key", F.col("fp").alias("a")), short.select("key", F.col("fp").alias("b"))
    shared = sum(((_byte(F.col("a"), i) == _byte(F.col("b"), i)).cast("int") for i in range(8)), F.lit(0))
    verified = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    met = (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (shared >= least_shared) & verified
    return a.join(b, met).select("a", "b"), listed.where(F.col("n") > most).select("key", "fp")


def links(fps: DataFrame, bits: int = 3, most_postings: int = 2000) -> DataFrame:
    """(a, b) of all distinct fingerprints fps (column fp) within bits (3 at most), each pair at least once."""
    if not 0 <= bits <= 3:
        raise ValueError("bits: 0 to 3")
    found, long_lists = _pairs(_postings(fps, _TRIPLES), bits, 8 - bits, most_postings)
    again = checkpointed(long_lists.select("fp").distinct())
    if again.isEmpty():
        return found
    fives = list(combinations(range(8), 5))
    more, longest = _pairs(_postings(again, fives), bits, 8 - bits, most_postings)
    masks = [sum(1 << b for b in c) for n in range(1, bits + 1) for c in combinations(range(24), n)]
    probes = longest.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
    number = F.shiftright("key", 40)  # the list's number is above its five bytes
    flips = F.lit(0).cast("long")
    for k, places in enumerate(fives):
        rest = [i for i in range(8) if i not in places]
        spread = F.lit(0).cast("long")
        for j, i in enumerate(rest):
            spread = spread.bitwiseOR(F.shiftleft(F.shiftright("mask", 8 * j).bitwiseAND(F.lit(255)).cast("long"), 8 * i))
        flips = F.when(number == k, spread).otherwise(flips)
    probed = probes.select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(flips).alias("b")).distinct()
    probed = probed.join(again.withColumnRenamed("fp", "b"), "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return found.unionByName(more).unionByName(probed)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3, most_postings: int = 2000) -> DataFrame:
    """id, fp and component_id (the smallest id that links reach) of each row."""
    marked = checkpointed(fingerprints(docs, id_col, text_col, words))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("id").alias("low")))
    roots = connected_components(links(distinct.select("fp"), bits, most_postings))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = checkpointed(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    labels = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select("id", "fp", "component_id")

