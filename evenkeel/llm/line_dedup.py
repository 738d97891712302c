"""Line deduplication: lines found in many documents go, the others are put together again.

Lines are exploded as hashes of their keys, never as text: a written table of
(document, position, hash) serves both the count of distinct documents per hash and the list of
positions to drop. Counting aggregates before each shuffle, so a line of a third of all documents
is one row per task. The table of frequent hashes is broadcast only when its counted rows are few;
otherwise the join shuffles it, and adaptive execution splits frequent hashes.

Defined cases: null text counts as one empty line; empty keys never drop; a document whose lines
all drop has an empty text; rows that repeat an id count as one document and each row keeps its
own lines; an empty table gives an empty result; further columns pass through ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import WHITE, counted_small, lowered, text_of, written

MIN_DOCS = 10
MIN_CHARS = 1


def line_keys(text: Column) -> Column:
    """The key of every line: stripped at both ends, A-Z in lower case."""
    return F.transform(F.split(lowered(text), "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)))


def dropped_positions(docs: DataFrame, key: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(id, text hash, positions to drop) of the documents that lose lines."""
    body = text_of(text)
    lines = docs.select(
        F.col(key).alias("__id"), F.xxhash64(body).alias("__text"), F.posexplode(line_keys(body)).alias("pos", "line"),
    ).filter(F.length("line") >= min_chars).select(
        "__id", "__text", "pos", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))
    lines = written(lines, "lines")
    # two steps: distinct (hash, document) first, so that no hash gathers its documents in one task
    per_line = lines.select("h1", "h2", "__id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"))
    frequent = written(per_line.filter(F.col("n") >= min_docs).select("h1", "h2"), "frequent-lines")
    hits = lines.join(counted_small(frequent, frequent.count()), ["h1", "h2"])
    return hits.groupBy("__id", "__text").agg(F.collect_set("pos").alias("__drop"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with frequent lines cut from the text, plus ``n_lines`` (before) and ``n_dropped``."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drops = dropped_positions(docs, key, text, min_docs, min_chars)
    joined = docs.select(*names).join(
        drops, docs[key].eqNullSafe(F.col("__id")) & (F.xxhash64(text_of(text)) == F.col("__text")), "left")
    lines = F.split(text_of(text), "\n", -1)
    drop = F.coalesce(F.col("__drop"), F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    return joined.select(
        *[c for c in names if c != text],
        F.when(F.col("__drop").isNull(), text_of(text)).otherwise(
            F.array_join(F.transform(kept, lambda p: F.get(lines, p)), "\n")).alias(text),
        F.size(lines).cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_dropped"),
    )
