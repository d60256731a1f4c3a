"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() applies them to documents, each result written as
Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleprep.llm.common import table
from sampleprep.llm.exact_dedup import drop_exact
from sampleprep.llm.language_id import keep_identified
from sampleprep.llm.language_id import train as train_language
from sampleprep.llm.mixing import apply_mix
from sampleprep.llm.near_similarity import drop_near
from sampleprep.llm.packing import pack
from sampleprep.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from all labelled rows of docs (a bounded sample)."""
    return keep_identified(docs, train_language(docs))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, within 3 bits or of similarity 0.8."""
    return drop_near(docs, words=5, bits=3, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources, a row for each copy, in mixed order."""
    return apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence of 2048 tokens and its place there."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", dedup_exact),
    ("near dedup", dedup_near),
    ("mixing", mix),
    ("packing", pack_sequences),
]


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's copy is deleted when the next one's is written; the last copy stays, as the rows are read from it."""
    docs = table(spark, sf_dir, "documents")
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-pipeline-")
    folder = f"{folder.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _delete(spark, f"{folder}/{k - 1}")
    return docs.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", F.lit(len(STAGES)).alias("stages"))


#: The language and packing stages are models; tests hold run() against plain Python instead.
ORACLE_SQL = None
