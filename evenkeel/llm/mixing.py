"""Mixing sources to target weights by fixed-length blocks.

Every source's words, in a pseudorandom order of its documents, are packed end to end into blocks
of ``block_words``. The mix is a long list of output slots, cut into shards. Each source owns as
many slots as meet its target; one pseudorandom permutation of all slots deals them to shards, so
the source counts of a shard are a multinomial draw under the condition that the totals meet the
targets. A source's slots run through a pseudorandom permutation of its block numbers, epoch by
epoch, and slots and blocks are joined by (source, block number).

The permutation is swap-or-not (Hoang, Morris and Rogaway 2012), which works on any length
without sorting, so no step orders all rows. Offsets are prefix sums over hash buckets of about
sqrt(n) documents, so no window sees a whole source. Block numbers spread a large source evenly.

Defined cases: a null text has size 0 and is taken 0 times; null is a source of its own, ordered
last; an empty table gives an empty result; rows that repeat an id are documents of their own;
a source of size 0 has target 0. All choices hash ids and the seed, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD, counted_small, partitions, text_of, written

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
ROUNDS = 20
CHUNK = 8192
SEED = 7


def shuffled(x: Column, n: Column, salt: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``x`` in a pseudorandom permutation of 0..n-1: swap-or-not over ``rounds`` rounds."""

    def step(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(salt, r), n) - at, n)
        high = F.greatest(at, partner)
        return F.when(F.xxhash64(salt, r, high).bitwiseAND(F.lit(1)) == 1, partner).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1000 + i) for i in range(rounds)]), x.cast("long"), step)


def with_targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """Targets of (source, size): ``share`` of all sizes by weight, none above ``most`` times its size.

    What capped sources leave is shared again by weight. The capped ones are those with the
    smallest size per weight, so running sums in that order find them without iterating.
    ``share`` is a fraction. There is one row per source; a single task orders these.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("no", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    tight = Window.orderBy(F.col("size") / F.col("w"), "no").rowsBetween(Window.unboundedPreceding, -1)
    up, down = share
    cols = ranked.withColumn("w", w).withColumns({
        "budget": F.sum("size").over(every) * up, "all_w": F.sum("w").over(every),
        "size_before": F.coalesce(F.sum("size").over(tight), F.lit(0)), "w_before": F.coalesce(F.sum("w").over(tight), F.lit(0)),
    })
    # raised to the level at which this source is just full, the mix would hold (times ``down``):
    level = F.col("size") * most / F.col("w")
    full = (F.col("size_before") * most + level * (F.col("all_w") - F.col("w_before"))) * down <= F.col("budget")
    cols = cols.withColumn("full", full).withColumns({
        "full_size": F.sum(F.when(F.col("full"), F.col("size")).otherwise(0)).over(every) * most,
        "open_w": F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("w"))).over(every),
    })
    rate = F.try_divide(F.col("budget") - F.col("full_size") * down, F.col("open_w") * float(down))
    return cols.select(
        "source", "no", "size",
        F.when(F.col("full"), F.col("size") * float(most)).otherwise(F.col("w") * rate).alias("target"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1),
    share: tuple[int, int] = (3, 2), most: int = 2, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, slots, pieces) of the mix.

    documents: id, source, size, source_size, target, taken. slots: shard, position, source number,
    block. pieces: which words of a document fill which part of a block (source number, block,
    id, first word in the block, first word in the document, words).
    """
    spark = docs.sparkSession
    rows = written(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("place"),
    ), "sizes")
    n_rows = rows.count()
    sources = rows.groupBy("source").agg(F.sum("size").alias("size"))
    per = F.ceil(F.col("size") / block_words)
    sources = with_targets(sources, weights, share, most).withColumn("blocks", per).withColumn(
        "n_slots", F.when(F.col("size") > 0, F.least(F.col("blocks") * most, F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("size"))).cast("long"))).otherwise(F.lit(0)))
    sources = sources.withColumns({
        "base": F.coalesce(F.sum("n_slots").over(Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "all_slots": F.sum("n_slots").over(Window.partitionBy()),
    })
    sources = written(sources, "sources")
    small = counted_small(sources.select(F.col("source").alias("s"), "no", F.col("size").alias("source_size"), "target"), sources.count())

    # offsets of documents within their source: bucket sums, then running sums inside a bucket
    buckets = max(1, math.isqrt(n_rows))
    placed = rows.join(small, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("bucket", F.pmod("place", F.lit(buckets)))
    before = placed.groupBy("no", "bucket").agg(F.sum("size").alias("words")).select("no", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("no", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(before, ["no", "bucket"])
    placed = written(placed.withColumn("start", F.col("before") + F.col("inside")).drop("bucket", "place", "before", "inside"), "placed")

    # output slots: each source's slots, dealt to shards by one permutation of all slots
    chunks = sources.filter("n_slots > 0").select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_slots") - 1) / CHUNK))).alias("chunk"))
    chunks = chunks.repartition(partitions(spark), "no", "chunk")  # few rows, each of many slots: a stated number is not coalesced
    last = F.least(F.col("n_slots"), (F.col("chunk") + 1) * CHUNK) - 1
    slots = chunks.select("*", F.explode(F.sequence(F.col("chunk") * CHUNK, last)).alias("slot"))
    out = shuffled(F.col("base") + F.col("slot"), F.col("all_slots"), F.lit(seed))
    block = shuffled(F.pmod("slot", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("no")))
    slots = slots.select("no", block.alias("block"), out.alias("out")).select(
        F.floor(F.col("out") / shard_slots).alias("shard"), (F.col("out") % shard_slots).alias("position"), "no", "block")
    slots = written(slots, "slots")

    filled = placed.filter("size > 0")
    end = F.col("start") + F.col("size")
    pieces = filled.select("no", "doc_id", "start", end.alias("end"), F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))).alias("block"))
    first = F.greatest(F.col("block") * block_words, F.col("start"))
    words = F.least((F.col("block") + 1) * block_words, F.col("end")) - first
    pieces = pieces.select("no", "block", "doc_id", "start", (first % block_words).alias("at"), (first - F.col("start")).alias("from"), words.alias("words"))
    uses = slots.groupBy("no", "block").agg(F.count("*").alias("times"))
    taken = pieces.join(uses, ["no", "block"]).groupBy("no", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    # where words start names a document with words; those without take nothing
    result = filled.join(taken, ["no", "start"], "left").unionByName(
        placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))).select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return result, slots, pieces


def shard_counts(slots: DataFrame) -> DataFrame:
    """Slots of every source in every output shard."""
    return slots.groupBy("shard", "no").agg(F.count("*").alias("n_slots"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` repeated as the mix takes them: words taken over size, rounded up or down by a hash.

    The hash makes the rounding unbiased, so a source's copies stay near its target. A
    document without words is not part of a mix.
    """
    result, _, _ = mix(docs, key=key, **options)
    seed = options.get("seed", SEED)
    luck = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    copies = result.filter("taken > 0").select(
        F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.floor(F.try_divide(F.col("taken"), F.col("size")) + luck).cast("int").alias("__copies"))
    # an id that occurs twice with one size would multiply: keep one count for it
    copies = copies.filter("__copies > 0").groupBy("__id", "__size").agg(F.max("__copies").alias("__copies"))
    text = options.get("text", "text")
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    joined = docs.join(copies, docs[key].eqNullSafe(F.col("__id")) & (size == F.col("__size")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[docs[c] for c in docs.columns])
