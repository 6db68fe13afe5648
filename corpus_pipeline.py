"""From raw documents to sampled pieces: five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchvault.llm.decontaminate import without_contaminated
from matchvault.llm.jaccard import without_near_copies
from matchvault.llm.pieces import decode, encode
from matchvault.llm.resample import selected
from matchvault.llm.secrets_scan import redacted
from matchvault.llm.store import small_batches, written


def _short(spark):
    """One executor works for all stages, and keeps some of the memory that each batch size needs."""
    small_batches(spark, rows=300, size="1m", read=512)


def _table(spark, sf_dir, name):
    _short(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents among the top k of the importance resampling."""
    return selected(docs, _table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _short(spark)
    return without_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; ``n_chars`` follows the text."""
    _short(spark)
    return redacted(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they spell its text."""
    _short(spark)
    spelled = decode(encode(docs.select("doc_id", "lang", "source", "text")))
    return spelled.select(
        "doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces",
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("lossless"),
    )


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("secret scans", secrets),
    ("SentencePiece encoding and decoding", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
