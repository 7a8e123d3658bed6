"""From raw documents to training pieces, one stored stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.mixing import mixed_documents
from tablewright.llm.pieces import decoded, encoded
from tablewright.llm.sentence_spans import without_repeated_spans
from tablewright.llm.site_quality import kept_documents
from tablewright.llm.weighted_minhash import near_duplicates
from tablewright.session import scratch


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their sites do not speak against."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: of the smallest id, then of the smallest text hash.

    Rows without an id come last in their group. Equal rows of id and text are one document.
    """
    first = near_duplicates(docs, marked=True).groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first")
    )
    first = first.select(F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"))
    mark = F.md5(F.coalesce("text", F.lit("")))
    kept = docs.join(first, docs["doc_id"].eqNullSafe(F.col("first_id")) & (mark == F.col("first_mark")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stood before; ``n_chars`` follows the text."""
    cut = without_repeated_spans(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.char_length("text").cast("bigint"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them; ``n_chars`` follows the text."""
    return mixed_documents(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they give the text again."""
    rows = decoded(encoded(docs, packed=True))
    return rows.select(
        "doc_id", "lang", "source", F.expr("octet_length(piece_ids) div 2").alias("n_pieces"), "piece_ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("restored"),
    )


STAGES = [
    ("quality classifier", good),
    ("near-duplicates", single),
    ("repeated sentences", unrepeated),
    ("mix of sources", mixed),
    ("pieces", as_pieces),
]

# Classifier, sampling and segmentation have no SQL; tests/llm covers the operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
