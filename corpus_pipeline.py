"""A training corpus from the table of documents: five stages, each over all its predecessor kept.

Documents that the quality classifier rejects go, lines that ten documents or more share go, one document of each group of
near-duplicates stays, documents are repeated as the mix of sources takes them, and what is left is encoded. All stages
but the last return the columns of their input, whatever further ones it has; ``n_chars`` follows the text where it is there.

Defined cases, stage by stage: a null text counts as empty, scores like one, has one empty line and becomes the empty text, links with
nothing, has no words to be mixed and so leaves in the mixing stage, as do texts that line dedup emptied; a null id takes no part in links and is kept
by the near-duplicate stage; rows that repeat an id are scored and deduplicated each, are one node of near-duplicates and
stay or go together; very long texts are whole in every stage; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import bpe, line_dedup, mixing, near_dedup, quality
from evenkeel.llm.common import remainder, written
from evenkeel.llm.queries import VOCABULARY


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), remainder(5) != 0)
    return quality.keep_good(docs, model)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    kept = near_dedup.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    coded = bpe.encode_documents(docs.select("doc_id", "source", "text"), VOCABULARY)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_common_lines),
    ("near_dedup", one_of_each_group),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: No SQL states the classifier or the tokeniser; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
