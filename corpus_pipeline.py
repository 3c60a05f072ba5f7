"""A training corpus from a table of documents, in five stages.

Each stage takes all rows that the one before it kept and returns the columns
of ``documents``; the last one returns the pieces of each text.

NULL and empty texts are scored like others; a text whose lines all went is
empty, and of the empty ones, which are near copies of each other, one row
stays. Rows that share an id are rows of their own. Long texts go through whole.
An empty table gives no rows. Of columns beyond those of ``documents``, all but
the last stage keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclime.llm import fair_mix, line_chunks, pieces, quality, simhash
from gridclime.llm.common import stage

#: A classifier and a model tokeniser have no SQL; the stages are held against brute force in the tests.
ORACLE_SQL = None


def replaced(found: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with the text that is left, and its length."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated probability of good quality is under the threshold go."""
    vectors, network = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    packed = docs.select(F.struct("*").alias("row"), "text")
    return quality.score(packed, vectors, network).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, with the lines around them that repeat too; the text and its length are what is left."""
    return replaced(line_chunks.dedup_lines(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return simhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their targets: documents beyond them go, and those taken twice are there twice."""
    return fair_mix.mixed(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, piece_ids of every row."""
    coded = pieces.encode(docs.select("doc_id", "source", "text"))
    return coded.select("doc_id", "source", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mixing),
    ("sentencepiece", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, work in STAGES:
        docs = stage(work(spark, docs, sf_dir))
    return docs
