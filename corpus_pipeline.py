"""A corpus pipeline of five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import lines, mixing, packing, quality, simhash
from pitpanel.llm.shared import WORD, new_path, read_table, tokenizer_path

#: SQL cannot express the stages with fingerprints, tokenizers and seeded choices; tests hold each against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled cutoff rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or resembles go; so do documents of which no word is left."""
    out = lines.dedup_lines(docs).where(F.coalesce(F.col("text").rlike(WORD), F.lit(False)) | (F.col("n_removed") == 0))
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints of five-word shingles at 3 or fewer differing bits,
    or sets of five-word shingles of a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs, width=5, alike=(8, 10))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's words as often as the mix takes their blocks: a first copy, and a second of what is taken twice."""
    out = mixing.mixed(docs)
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, lexical neighbours together."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
