"""From documents to token ids: quality, near-dedup, passage dedup, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe, importance, mixture, near_text, units
from gridloom.llm.common import cut, only, table
from gridloom.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling towards the labelled good ones draws."""
    return importance.Chosen(docs, table(ship(spark), sf_dir, "labels")).kept()


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    ship(spark)
    gone = cut(near_text.group_near(docs).where(~F.col("kept")).select("doc_id").distinct())
    return only(docs, gone, "doc_id", "left_anti")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the units that an earlier document, or an earlier place, has; n_chars follows."""
    ship(spark)
    clean = units.dedup_units(docs)
    return clean.select(*(F.char_length("text").cast(t).alias(c) if c == "n_chars" else c for c, t in docs.dtypes))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; n_chars follows."""
    mixed = mixture.repeated(docs)
    return mixed.select(*(F.char_length("text").cast(t).alias(c) if c == "n_chars" else c for c, t in docs.dtypes))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and lossless of each row."""
    ship(spark)
    return bpe.encode(docs)


STAGES = [("quality classifier", quality), ("near-duplicates", near_duplicates), ("substring dedup", passages), ("source mixing", mixing), ("byte-level BPE", tokens)]

#: DuckDB has neither the classifier nor the signatures nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again, but for the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
