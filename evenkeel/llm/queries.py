"""The registered queries of this subpackage, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    bpe, exact_dedup, katz, licenses, line_dedup, mixing, near_dedup, neighbours, quality, runs, spelling, token_counts, toxicity,
)
from evenkeel.llm.common import WHITE, remainder, text_of

#: The vocabulary of the encoding operator and its pipeline stage.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The model of the counting operator.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: A document of more tokens is over the limit.
TOKEN_LIMIT = 4096


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, held_out = documents(spark, sf), remainder(5) == 0
    model = quality.fit(docs, labels(spark, sf), ~held_out)
    return quality.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_licenses(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    found = licenses.scan_documents(docs, licenses.fit(docs)).withColumn("predicted", F.array_sort(F.array_distinct("licences.family")))
    found = found.withColumn("licences", F.filter("licences", lambda x: x["confirmed"]))
    best = F.element_at(F.array_sort("licences", lambda a, b: F.when(a["probability"] > b["probability"], -1).when(a["probability"] < b["probability"], 1).otherwise(a["paragraph"] - b["paragraph"])), 1)
    return found.withColumn("best", F.when(F.size("licences") > 0, best)).select(
        "doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"), F.array_sort(F.array_distinct("licences.family")).alias("families"),
        F.col("best.family").alias("family"), F.col("best.paragraph").alias("paragraph"), F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"), "predicted")


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    result, _, _ = mixing.mix(documents(spark, sf))
    return result.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe.encode_documents(documents(spark, sf).select("doc_id", "text"), VOCABULARY)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf), width=2)


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, held_out = documents(spark, sf), remainder(3) == 1
    index = toxicity.fit(docs, labels(spark, sf), ~held_out)
    return toxicity.score_documents(docs, index).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence")


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = exact_dedup.deduplicate(documents(spark, sf))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return neighbours.nearest(rows, F.col("vec_id") % 100 == 0).select(
        F.col("query_id").cast("long"), "rank", F.col("vec_id").cast("long"), "score")


def op10_katz(spark: SparkSession, sf: str) -> DataFrame:
    scores = katz.score_documents(documents(spark, sf), remainder(7) != 2)
    return scores.select("doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``text`` with every tenth document (by crc32 of its id) repeating some of its words from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g, n, words = F.floor(F.col("h") / 10), F.size("words"), F.col("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, 1, a), again), 1, n), " ")
    split = F.array_remove(F.split(text_of(), f"[{WHITE}]+"), "")
    return docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, split)).withColumn(
        "text", F.when(F.size("words") > 0, planted).otherwise(F.col("text"))).drop("h", "words")


def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.find_runs(with_planted_runs(documents(spark, sf).select("doc_id", "text")).select("doc_id", "text"))
    # the greatest length / period, compared without division; runs come by start, then period
    ahead = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    kind = found.schema["runs"].dataType.elementType
    best = found.withColumn("best", F.aggregate("runs", F.lit(None).cast(kind), ahead))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, sf).select("doc_id", "text"), PIECES)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def with_planted_slips(doc_id: str, found: Counter) -> Counter:
    """The counts of a document's words, one of its letters lost from every word whose crc32 199 divides."""
    seed = crc32(f"{doc_id}:".encode())
    slips = [(w, h) for w in found if (h := crc32(w.encode(), seed)) % 199 == 0]
    lost = [(w[:h % len(w)] + w[h % len(w) + 1:], found.pop(w)) for w, h in slips]
    for word, n in lost:
        found[word] += n
    return found


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(spelling.count_words(documents(spark, sf), edit=with_planted_slips))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_near_dedup": op5_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_neighbours": op9_neighbours,
    "op10_katz": op10_katz,
    "op11_runs": op11_runs,
    "op12_token_counts": op12_token_counts,
    "op13_spelling": op13_spelling,
}

WHITE_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op6_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  unnest(string_split({LOWER_SQL}, chr(10))) AS low, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, trim(low, {WHITE_SQL}) AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op8_exact_dedup": """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
}
