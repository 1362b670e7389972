"""From raw documents to token ids: five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the one before has kept and
returns a DataFrame. All but the last return the columns of documents. Between two
stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlework.llm import decontaminate, filters, jaccard, pieces, pii, quality_rules
from candlework.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that too many of their host share."""
    kept = quality_rules.judged(docs.select(COLUMNS)).where("kept")
    return _sized(kept.withColumn("text", F.col("clean_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return jaccard.deduplicated(docs.select(COLUMNS)).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    docs = docs.select(COLUMNS)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_passages(docs, benchmark).where("n_hit > 0").select("doc_id")
    return filters.without_ids(docs, "doc_id", stored(found, "contaminated")).select(COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return _sized(pii.redact_pii(docs.select(COLUMNS)))


def pieces_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as ids of pieces, with the costs of the best segmentations and their changes."""
    return pieces.encode(docs.select(COLUMNS)).select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_pieces"), "ids", "costs", "changes"
    )


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", private_data),
    ("sentencepiece", pieces_of),
]

#: SQL cannot express the segmentation; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
