"""The corpus pipeline over ``documents``: each stage calls one operator of ``ridestat.llm``.

toxicity        documents that score as toxic go
line dedup      lines that an earlier line equals or nearly equals go, and documents left without a word
near-dedup      one document of each near-duplicate class stays
mixing          documents are dropped or repeated until each source holds its target
bpe             the ids of every text, and whether they decode to it

Every stage but the last returns the columns of its input. ``run`` writes each stage's result to the
shared checkpoint folder and reads it from there, as a driver of the stages would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestat.llm import bpe, line_dedup, mixing, near_dup, toxicity
from ridestat.llm.common import ready, stored
from ridestat.llm.queries import tokenizer_path

#: No SQL: the first stage trains a network and the fourth draws at random. tests/llm compares each stage with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones among them, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.reject_toxic(docs, labels)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the text."""
    out = line_dedup.documents_without_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids (little-endian uint32), round_trip."""
    out = bpe.encode(docs, tokenizer_path(), decode=True)
    n_tokens = (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", "lang", "source", n_tokens, "token_ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
