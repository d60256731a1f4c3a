"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleprep.llm.bm25 import search
from sampleprep.llm.chat_format import format_chats, gather, loss_text, parse
from sampleprep.llm.common import table
from sampleprep.llm.exact_dedup import exact_dedup
from sampleprep.llm.html_text import extract
from sampleprep.llm.language_id import fold_of, identify
from sampleprep.llm.language_id import train as train_language
from sampleprep.llm.licenses import scan_licenses
from sampleprep.llm.mixing import mix_sources
from sampleprep.llm.packing import pack
from sampleprep.llm.simhash import near_duplicates
from sampleprep.llm.spelling import group_variants, vocabulary
from sampleprep.llm.toxicity import score as score_toxicity
from sampleprep.llm.toxicity import train as train_toxicity
from sampleprep.llm.url_filter import filter_urls, train
from sampleprep.llm.whitening import whiten

#: Name of the tokenizer file; its folder comes from the installed public_tokenizers.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"), hash_all=True)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("text_hash").alias("text_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), train(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_language(docs.where(fold_of("doc_id", 4) != 2))
    found = identify(docs, model)
    return found.select(F.col("id").alias("doc_id"), (fold_of("id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_topk_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each document whose id is divisible by 20, by its whole text."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    found = search(docs, asked, 10)
    return found.select("query_id", F.col("id").alias("doc_id"), F.col("rank").cast("int").alias("rank"), "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 3) != 1).select("doc_id", "toxic")
    found = score_toxicity(docs, train_toxicity(docs, docs.join(labels, "doc_id")))
    return found.select(F.col("id").alias("doc_id"), (fold_of("id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text")
    )
    read = format_chats(gather(rows.unionByName(extra))).select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("turns"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["first"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(vocabulary(table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_html_text": op6_html_text,
    "op7_topk_bm25": op7_topk_bm25,
    "op8_toxicity": op8_toxicity,
    "op9_mix_sources": op9_mix_sources,
    "op10_chat_format": op10_chat_format,
    "op11_license_scan": op11_license_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op10_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (SELECT *, regexp_replace(text, '(\\*)(</turn>|### )', '\1\\\2', 'g') AS shown FROM c)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(length(shown) + length(role) + 15)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
}
