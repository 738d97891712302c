"""Exact deduplication over a persistent digest index, bucketed and sorted by digest.

The index is a Parquet table. A batch of documents is reduced to
one entry per digest (partial aggregation, so a text with a third of all rows sends one row
per task), a sort-merge anti-join against the index finds the digests that are new, and those
are appended with the row that stays; digests known before get a row that adds their count. Only the batch is shuffled:
the index is already bucketed by digest, so its rows of a digest are summed where they are.

Defined cases: null text counts as empty; all empty texts are one group; a null id loses ties;
rows that repeat an id with an equal text are members of one group and share its fate; an empty
table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import WHITE, fresh, joined_by_share, partitions, text_of, written


def normal_text(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, WHITE, "")


def thin(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Row key, digest of the normal text, code points of the original."""
    body = text_of(text)
    return docs.select(
        F.col(key).alias("doc_id"), F.unhex(F.sha2(normal_text(body).cast("binary"), 256)).alias("digest"),
        F.length(body).cast("long").alias("chars"),
    )


class DigestIndex:
    """A bucketed, sorted Parquet table of digests at ``path``.

    The table outlives the session: opening the same path again registers it anew.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, key_type: str = "bigint") -> None:
        self.spark, self.buckets = spark, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {key_type}, chars BIGINT, group_size BIGINT, is_first BOOLEAN) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        """(digest, keep_id, group_size) of every text indexed so far."""
        return self.spark.table(self.name).groupBy("digest").agg(
            F.max_by("keep_id", "is_first").alias("keep_id"), F.sum("group_size").alias("group_size"))

    def close(self) -> None:
        """Forget the name; the files stay, and so do frames that read them."""
        self.spark.sql(f"DROP TABLE {self.name}")

    def append(self, rows: DataFrame) -> DataFrame:
        """Add the texts of ``rows`` (of ``thin``); returns the batch's (digest, rows).

        Of equal texts new to the index the longest original stays, then the smallest id.
        """
        # one row per (digest, length) first: both steps aggregate before their shuffle
        entries = rows.groupBy("digest", "chars").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")).groupBy("digest").agg(
            F.max_by("id", "chars").alias("keep_id"), F.max("chars").alias("chars"), F.sum("n").alias("group_size"))
        # written, or the optimizer would push the anti-join, and with it every row, below the aggregation
        entries = written(entries, "entries")
        known = self.spark.table(self.name).filter("is_first").select("digest").hint("merge")
        new = entries.join(known, "digest", "left_anti").withColumn("is_first", F.lit(True))
        again = entries.join(known, "digest", "left_semi").withColumn("is_first", F.lit(False))
        columns = ["digest", "keep_id", "chars", "group_size", "is_first"]
        # both are computed before either is added
        written(new.unionByName(again).select(*columns), "index-rows").write.insertInto(self.name)
        return entries.select("digest", F.col("group_size").alias("rows"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", index_path: str | None = None) -> DataFrame:
    """One row per document with the row that stays for its text.

    With an ``index_path`` of earlier batches, texts seen before keep the row indexed first, and
    ``group_size`` counts the rows of all batches so far.
    """
    spark = docs.sparkSession
    rows = written(thin(docs, key, text), "digests")
    index = DigestIndex(
        spark, index_path or fresh(spark, "digest-index"), partitions(spark), rows.schema["doc_id"].dataType.simpleString())
    batch = index.append(rows)
    # keys are hot by their rows in this batch, whatever the index holds of them
    table = written(batch.join(index.table().hint("merge"), "digest"), "batch-groups")
    index.close()
    found = joined_by_share(rows.select("doc_id", "digest"), table, ["digest"], "rows", rows.count()).drop("rows")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
