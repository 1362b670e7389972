"""The registered queries of this package: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from candlework.llm import (
    chat, classifier, decontaminate, exact_dedup, html_text, jaccard, langid, lexical, merkle, pieces, pii,
    quality_rules, sharding,
)
from candlework.session import scratch_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_quality_rules(spark, sf_dir):
    return quality_rules.quality_digest(quality_rules.judged(_table(spark, sf_dir, "documents")))


@_query
def op2_decontamination(spark, sf_dir):
    found = decontaminate.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.decontamination_digest(found)


@_query
def op3_sharding(spark, sf_dir):
    return sharding.shard_digest(sharding.assign_shards(_table(spark, sf_dir, "documents")))


@_query
def op4_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    table = classifier.word_vectors(docs)
    net = classifier.train(docs, _table(spark, sf_dir, "labels"), table)
    return classifier.score(docs, table, net).select(
        "doc_id",
        (~classifier.trained_on(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= classifier.CHOOSE).cast("int").alias("predicted"),
    )


@_query
def op5_html_extraction(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@_query
def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op7_chat_formatting(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes = chat.conversation_nodes(rows.unionByName(chat.planted(spark)))
    return chat.chat_digest(chat.format_trees(nodes))


@_query
def op8_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).select(
        "doc_id", (~langid.trained_on(F.col("doc_id"))).alias("held_out"), "lang_pred", "score"
    )


@_query
def op9_pii(spark, sf_dir):
    return pii.pii_digest(pii.pii_spans(_table(spark, sf_dir, "documents")))


@_query
def op10_sentencepiece(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
    v = pieces.load_vocabulary()
    encoded = pieces.encode(docs, v).select(
        "doc_id",
        "text_sha256",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.array_join("costs", ",").alias("costs"),
        "ids",
    )
    return pieces.decode(encoded, v).select(
        "doc_id", "n_pieces", "ids_sha256", "costs", F.sha2("text", 256).alias("decoded_sha256"),
        (F.sha2("text", 256) == F.col("text_sha256")).alias("exact"),
    )


@_query
def op12_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(docs, F.when(chosen, merkle.leaf_digest(merkle.lower_cased(F.col("text")))))


@_query
def op13_exact_dedup(spark, sf_dir):
    """All documents, delivered in two halves; the second meets the index of the first."""
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("string")
    rows = stored(exact_dedup.digested(_table(spark, sf_dir, "documents")).withColumn("delivery", half), "digests")
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"), rows.schema["doc_id"].dataType.simpleString())
    for delivery in ("0", "1"):
        index.add(rows.where(F.col("delivery") == delivery), delivery)
    return exact_dedup.judged(rows, index)
@_query
def op11_lexical_search(spark, sf_dir):
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


