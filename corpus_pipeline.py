"""The corpus pipeline: toxic documents go, copies go, near copies go, domains are mixed, texts become ids.

Each stage takes all documents its predecessor kept and returns the columns of documents; the last one
returns ids instead. No stage needs more of a table than its own operator reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, pieces, toxicity
from millrace.llm.exact_dedup import without_copies
from millrace.llm.near_dedup import without_near_copies
from millrace.llm.queries import TOXIC, piece_model
from millrace.llm.textblocks import small_batches
from millrace.session import settle

# Shares of the tokens of poor and good texts. Documents are repeated to get there, none is dropped.
WEIGHTS = [0.1, 0.9]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine holds for toxic go; labels teach it and decide nothing."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels), TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8 or more."""
    small_batches(spark)
    return without_near_copies(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated until poor and good texts have the target shares of the tokens."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", (F.col("quality") > 0).cast("int").alias("domain"))
    return mixing.lifted(docs, mixing.fit_domains(docs, labels, len(WEIGHTS)), WEIGHTS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the hash of what they decode to."""
    small_batches(spark)
    return pieces.encode(docs, pieces.Vocabulary.load(piece_model()), check=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("SentencePiece", to_pieces),
]

# Classifiers, a least-squares fit and piece ids: SQL states none of them. tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, settle(docs, "stage") if k else docs, sf_dir)
    return docs
