"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs.  All but the last return the columns
of documents.  Null and empty texts hold nothing toxic, repeated or leaked, so they pass every filter and encode
to no ids; the near-duplicate stage makes rows of one doc_id and text one.  Empty tables give empty results,
and further columns of documents are carried along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, jaccard_join, line_dedup, piece_codec, toxicity
from strandline.llm.storage import remove, scratch, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.3; training sees labelled documents outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.without_toxic(docs, model, 0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-equal lines stay once in the corpus; documents left without a line go."""
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets with a Jaccard similarity of 0.8 or more stays."""
    return jaccard_join.one_of_each(docs, percent=80, words=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of the whole text."""
    tokens = piece_codec.encode(docs, piece_codec.load(), ["doc_id", "lang", "source"])
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]
#: Models and similarity search can't be stated in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES:
        path = scratch(spark, name)
        docs = stored(stage(spark, docs, sf_dir), name, path)
        if last:
            remove(spark, last)  # nothing reads the stage before any more
        last = path
    return docs
