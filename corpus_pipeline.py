"""Documents to training tokens, in stages that are written as Parquet in between.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and returns the columns of documents; the last one returns token ids. Null and empty texts
fail the quality rules and go in the first stage. Further columns of a table are dropped by the first stage, whatever their
names; repeated rows are near duplicates of each other, of which one stays; texts of any length are read whole; no documents
give none. Ties go by the smallest id, null last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, mixing, near_duplicates, pii, quality_rules
from ledgerline.llm.common import stash, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return near_duplicates.keep_one(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind in brackets."""
    return pii.scrub(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target of words takes it."""
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and their number, one row for each copy in the mix."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicate),
    ("personal data", personal_data),
    ("mixing", mixed),
    ("tokens", tokens),
]
#: Expectation-maximisation, darts, the random field and merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs)
    return docs
