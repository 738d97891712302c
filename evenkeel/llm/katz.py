"""Language-model scores by Katz backoff over word bigrams.

Counts of all training documents are discounted by Good-Turing (counts up to ``K``); what a context
saves goes to the words not seen after it, in proportion to the lower order, by a weight that
makes the probabilities of every context add up to 1. A bigram falls back to its word, a word to
the one class of unknown words. Where no successor of a context was discounted, one unseen
observation is added to it, so that unseen successors keep a probability; where the counts of
counts allow no Good-Turing discount, half an observation is taken.

Tokens occur a hundred million times, so no row is one token. Documents are read once, in batches
of about ``BATCH_TOKENS`` tokens, into a table bucketed by batch. A batch sends its distinct words
and bigrams with their training counts to the partition of their hash (bigrams: of their context),
as packed arrays; there the counts of all batches are summed and
each batch is answered for what it sent. Two shuffles of distinct n-grams per batch thus replace a
join of every token, hot words are one entry per batch, and the batches never move.

The sums are kept as tables, one of words and one of bigrams, partitioned by that hash: a row holds the n-grams of a part as
packed arrays, in the form in which batches send theirs. So a stored model answers other texts as it did the corpus: ``score_texts`` joins
their batches' n-grams with its rows by part, bigrams that are not there fall back to their word, words to the unknown class.

A context of more than ``SPLIT_TOKENS`` tokens is split by a salt of the second word, one salt for
so many tokens, so that no part grows with one context. A bigram is whole within its salt; the totals
of a split context are added over its parts on the driver, at most ``2 * SALTS`` rows whatever the corpus, and broadcast.

Words are known by 64-bit hashes, successors within a context by 48 bits.

Defined cases: null text counts as empty and has the end token alone; an id may repeat, each row is
scored; without training documents every token is the unknown class, of probability 1; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import fresh, partitions, written
from evenkeel.llm.near_dedup import WordHashes

K = 5
BATCH_TOKENS = 2_000_000
#: Tokens of the corpus per partition of the model.
PART_TOKENS = 1_000_000
#: Tokens after one context per salt, and salts of all contexts together; a corpus that would need more has more tokens per salt.
SPLIT_TOKENS = 100_000
SALTS = 1_000_000
# Fixed values that stand for the end of a text and for the context of its first word.
END, START = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
#: An odd number that sends the salts of a context to different parts.
SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)
LOW48 = np.uint64((1 << 48) - 1)


def pack(x: np.ndarray) -> bytes:
    """Compressed integers, byte planes apart, so that small numbers cost little."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_each(parts: list[np.ndarray]) -> list[bytes]:
    return [pack(p) for p in parts]


# What batches send of their words and bigrams; a model's tables have the same columns.
WORDS_SENT = "part long, batch long, words binary, counts binary, others binary"
PAIRS_SENT = "part long, batch long, contexts binary, runs binary, split binary, seconds binary, n binary, lower binary"
TABLE = ["table_contexts", "table_runs", "table_split", "table_seconds", "table_n", "table_lower"]


class Discounts:
    """Good-Turing discount factors of one order, from the counts of counts 1..K+1."""

    def __init__(self, often: list[int]) -> None:
        self.factor = np.ones(K + 1)
        n = [0, *often]
        tail = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            good = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
            self.factor[r] = good if 0 < good < 1 else (r - 0.5) / r

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.where(counts <= K, self.factor[np.minimum(counts, K)], 1.0)


class Words:
    """Lowest orders: discounted words, and one class of unknown words for what they save."""

    def __init__(self, tokens: int, words: int, often: list[int]) -> None:
        self.tokens, self.words, self.discounts = tokens, words, Discounts(often)
        saved = sum(r * often[r - 1] * (1 - self.discounts.factor[r]) for r in range(1, K + 1))
        self.total = tokens + (saved == 0)
        self.unknown = (saved or 1.0) / self.total

    def probability(self, counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.int64)
        return np.where(counts > 0, self.discounts.kept(counts) / self.total, self.unknown)


# ------------------------------------------------------------------------------ a batch


def numbered(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words, frequent ones first, and the number of each token's word."""
    words, stream, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    order = np.argsort(-often, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return words[order], place[stream]


def bigrams(words: np.ndarray, stream: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts (hash), their numbers of bigrams, second words (number), each token's bigram, and contexts (number)."""
    before = np.empty_like(stream)
    before[1:] = stream[:-1]
    before[np.cumsum(lengths) - lengths] = len(words)  # documents begin in the context of their start
    code, of_token = np.unique(before * (len(words) + 1) + stream, return_inverse=True)
    first, second = np.divmod(code, len(words) + 1)
    context, runs = np.unique(first, return_counts=True)
    return np.append(words, np.uint64(START))[context], runs, second, of_token, context


def dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by part, the parts present, and where each begins."""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    present, begin = np.unique(part[order], return_index=True)
    return order, present, begin


class Batch:
    """One row of the table of batches, unpacked."""

    def __init__(self, row) -> None:
        self.ids, self.id = row.ids, row.batch
        self.lengths = unpack(row.lengths).astype(np.int64)
        self.learns = unpack(row.learns).astype(bool)
        self.words, self.stream = unpack(row.words), unpack(row.stream).astype(np.int64)
        self.counted = np.repeat(self.learns, self.lengths)

    def word_counts(self, answers: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts of the batch's words and their salts, from the answers of all parts."""
        order, _, _ = dealt(self.words, parts)
        counts, salts = np.empty(len(order), np.uint64), np.empty(len(order), np.uint64)
        answers = answers.sort_values("part")
        counts[order] = np.concatenate([unpack(b) for b in answers["counts"]])
        salts[order] = np.concatenate([unpack(b) for b in answers["salts"]])
        return counts, salts

    def pairs(self, parts: int, salts: np.ndarray, start_salts: int) -> tuple[np.ndarray, ...]:
        """Bigrams in the order in which they are sent: contexts, runs, second words, each token's bigram, parts, begins, salts of each context.

        A context that is split has a run for each salt of its second words.
        """
        context, runs, second, of_token, first = bigrams(self.words, self.stream, self.lengths)
        of = np.append(salts, np.uint64(start_salts))[first]
        owner = np.repeat(np.arange(len(runs)), runs)
        salt = np.where(of[owner] > 1, (self.words[second] >> np.uint64(16)) % of[owner], np.uint64(0))
        by_salt = np.lexsort((salt, owner)) if salt.any() else np.arange(len(salt))
        owner, salt = owner[by_salt], salt[by_salt]
        start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (salt[1:] != salt[:-1])))
        runs = np.diff(np.append(start, len(owner)))
        context, of = context[owner[start]], of[owner[start]]
        order, present, begin = dealt(context + salt[start] * SPREAD, parts)
        moved = by_salt[np.repeat(start[order], runs[order]) + ranges(runs[order])]
        place = np.empty(len(moved), np.int64)
        place[moved] = np.arange(len(moved))
        return context[order], runs[order], second[moved], place[of_token], present, begin, of[order]


def ranges(runs: np.ndarray) -> np.ndarray:
    """0..run-1 for every run."""
    return np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)


# ------------------------------------------------------------------------------ the jobs


def batches_of(docs: DataFrame, learns: Column, key: str, text: str) -> DataFrame:
    """The documents' tokens in batches, in a table bucketed by batch."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def batched(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, task = WordHashes(), TaskContext.get().partitionId()
        ids, flags, hashes, held, number = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            words, stream = numbered(hashes)
            blocks = pack_each([[len(h) for h in hashes], flags, words, stream])
            return pa.RecordBatch.from_arrays([
                pa.array([task << 32 | number]), pa.array([ids], pa.list_(id_type)), *(pa.array([b], pa.binary()) for b in blocks)], names)

        for batch in given:
            id_type = batch.column(0).type
            for doc, value, flag in zip(batch.column(0), batch.column(1), batch.column(2)):
                h = np.append(memo.of(value.as_py() or ""), np.uint64(END))
                ids.append(doc.as_py())
                flags.append(flag.as_py())
                hashes.append(h)
                held += len(h)
                if held >= BATCH_TOKENS:
                    yield row()
                    ids, flags, hashes, held, number = [], [], [], 0, number + 1
        if ids:
            yield row()

    names = ["batch", "ids", "lengths", "learns", "words", "stream"]
    rows = docs.select(F.col(key), F.col(text), learns.alias("learns")).mapInArrow(
        batched, f"batch long, ids array<{kind}>, lengths binary, learns binary, words binary, stream binary")
    name = f"token_batches_{uuid.uuid4().hex}"
    rows.write.bucketBy(partitions(spark), "batch").option("path", fresh(spark, "token-batches")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


#: The batch number of a model's own rows.
STORED = -1


def _count_words(batches: DataFrame, parts: int, split: int, stored: DataFrame | None = None) -> DataFrame:
    """Answers to the batches, (part, batch, counts, salts), and per part its totals and the words themselves, where batch is null.

    ``stored`` are the words of a model, which take part like a batch that asks nothing.
    """
    own = stored is None

    def sent(given: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in given:
            for row in pdf.itertuples(index=False):
                b = Batch(row)
                # the salts of a stored model are those of its own corpus
                counts, others = (np.bincount(b.stream[x & own], minlength=len(b.words)) for x in (b.counted, ~b.counted))
                order, present, begin = dealt(b.words, parts)
                deal = lambda x: pack_each(np.split(x[order], begin[1:]))
                yield pd.DataFrame({"part": present, "batch": b.id, "words": deal(b.words), "counts": deal(counts), "others": deal(others)})

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [unpack(b) for b in pdf["words"]]
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        totals, others = (np.bincount(at, np.concatenate([unpack(b) for b in pdf[c]])).astype(np.int64) for c in ("counts", "others"))
        salts = -(-(totals + others) // split)  # of all tokens, also those that are not counted
        often = np.bincount(np.minimum(totals, K + 2), minlength=K + 3)
        ends = np.cumsum([len(w) for w in words])[:-1]
        out = pd.DataFrame({"part": pdf["part"], "batch": pdf["batch"].astype(object), "counts": pack_each(np.split(totals[at], ends)), "salts": pack_each(np.split(salts[at], ends)), "tokens": None, "words": None, "often": None, "others": None, "known": None})
        out = out[out["batch"] != STORED].reset_index(drop=True)
        out.loc[len(out)] = [pdf["part"].iloc[0], None, pack(totals), None, int(totals.sum()), int((totals > 0).sum()), often[1:K + 2].tolist(), pack(others), pack(distinct)]
        return out

    rows = batches.mapInPandas(sent, WORDS_SENT)
    if stored is not None:
        rows = rows.unionByName(stored)
    return rows.groupBy("part").applyInPandas(
        summed, "part long, batch long, counts binary, salts binary, tokens long, words long, often array<long>, others binary, known binary")


def _stored_words(answers: DataFrame) -> DataFrame:
    """The words of a model, as a batch sends its own."""
    return answers.filter("batch IS NULL").select("part", F.lit(STORED).cast("long").alias("batch"), F.col("known").alias("words"), "counts", "others")


def _totals(answers: DataFrame, *columns: str) -> list:
    """Sums over the parts of ``columns`` and of the counts of counts."""
    sums = [F.sum(c) for c in columns] + [F.sum(F.get("often", i)) for i in range(K + 1)]
    row = [int(x or 0) for x in answers.filter("batch IS NULL").agg(*sums).first()]
    return [*row[:len(columns)], row[len(columns):]]


def _count_pairs(batches: DataFrame, answers: DataFrame, parts: int, lower: Words, start_salts: int, stored: DataFrame | None = None) -> DataFrame:
    """Answers on bigrams: their counts, and of their contexts the total and what their weight needs.

    Of split contexts these hold the part's second words only; the rows without a batch have them by context, for ``_split_totals``,
    and the part's bigrams that were seen in training. ``stored`` are the bigrams of a model, which take part like a batch that asks nothing.
    """

    def sent(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.itertuples(index=False):
            b = Batch(row)
            counts, salts = b.word_counts(answers, parts)
            context, runs, second, of_token, present, begin, of = b.pairs(parts, salts, start_salts)
            n = np.bincount(of_token[b.counted], minlength=len(second))
            cut = (np.cumsum(runs) - runs)[begin][1:]
            out.append(pd.DataFrame({
                "part": present, "batch": b.id, "contexts": pack_each(np.split(context, begin[1:])), "runs": pack_each(np.split(runs, begin[1:])), "split": pack_each(np.split(of > 1, begin[1:])),
                "seconds": pack_each(np.split(b.words[second] & LOW48, cut)), "n": pack_each(np.split(n, cut)), "lower": pack_each(np.split(counts[second], cut)),
            }))
        return pd.concat(out)

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        read = lambda c: [unpack(b) for b in pdf[c]]
        contexts, runs, seconds = read("contexts"), [r.astype(np.int64) for r in read("runs")], read("seconds")
        ctx_of = np.repeat(np.concatenate(contexts), np.concatenate(runs))
        second, n, low = np.concatenate(seconds), np.concatenate(read("n")).astype(np.int64), np.concatenate(read("lower"))
        order = np.lexsort((second, ctx_of))
        c, w = ctx_of[order], second[order]
        new_context = np.append(True, c[1:] != c[:-1])
        new_pair = new_context | np.append(True, w[1:] != w[:-1])
        begin = np.flatnonzero(new_pair)
        total = np.add.reduceat(n[order], begin)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new_pair) - 1
        # per context: its total, what counts up to K hold, and the lower order's share of seen words
        owner = np.cumsum(new_context[begin]) - 1
        size = owner[-1] + 1
        seen = total > 0
        held = np.bincount(owner, total, size).astype(np.int64)
        few = np.stack([np.bincount(owner, total == r, size) for r in range(1, K + 1)], 1).astype(np.int64)
        mass = np.bincount(owner, np.where(seen, lower.probability(low[order][begin]), 0.0), size)
        many = np.bincount(owner, np.where(total > K, total, 0), size).astype(np.int64)
        known = c[begin][np.append(True, owner[1:] != owner[:-1])]
        hot = np.searchsorted(known, np.unique(np.concatenate(contexts)[np.concatenate(read("split")) > 0]))
        totals = [pack(x) for x in (known[hot], held[hot], few[hot].ravel(), many[hot], mass[hot].view(np.uint64))]
        held = held + unseen(held, few)
        out, start = [], 0
        for batch, ctx, run in zip(pdf["batch"], contexts, runs):
            mine = total[at[start:start + run.sum()]]
            start += run.sum()
            if batch == STORED:
                continue
            own = np.searchsorted(known, ctx)
            asked = own[np.minimum.reduceat(mine, np.cumsum(run) - run) == 0]  # contexts with an unseen word here
            out.append((pdf["part"].iloc[0], batch, pack(mine), pack(held[own]), pack(few[asked].ravel()), pack(many[asked]), pack(mass[asked].view(np.uint64)), None, *[None] * 6))
        often = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1:K + 2]
        # the table of the part: bigrams in the order of context and second word
        run = np.bincount(owner[seen], minlength=size)
        has = np.flatnonzero(run)
        table = (known[has], run[has], np.isin(has, hot), w[begin][seen], total[seen], low[order][begin][seen])
        out.append((pdf["part"].iloc[0], None, *totals, often.tolist(), *(pack(x) for x in table)))
        return pd.DataFrame(out, columns=["part", "batch", "n", "held", "few", "many", "mass", "often", *TABLE]).astype({"batch": object})

    own = answers.filter("batch IS NOT NULL").select("part", "batch", "counts", "salts")
    rows = batches.groupBy("batch").cogroup(own.groupBy("batch")).applyInPandas(sent, PAIRS_SENT)
    if stored is not None:
        rows = rows.unionByName(stored)
    return rows.groupBy("part").applyInPandas(
        summed, "part long, batch long, n binary, held binary, few binary, many binary, mass binary, often array<long>, " + ", ".join(f"{c} binary" for c in TABLE))


def _stored_pairs(answers: DataFrame) -> DataFrame:
    """The bigrams of a model, as a batch sends its own."""
    names = [c.removeprefix("table_") for c in TABLE]
    return answers.filter("batch IS NULL").select("part", F.lit(STORED).cast("long").alias("batch"), *[F.col(t).alias(n) for t, n in zip(TABLE, names)])


def unseen(held: np.ndarray, few: np.ndarray) -> np.ndarray:
    """1 for contexts of which no successor is discounted."""
    return (held > 0) & (few.sum(1) == 0)


def _split_totals(answers: DataFrame) -> tuple[np.ndarray, ...]:
    """Split contexts, and of each the sums over its parts: held, few, many, mass."""
    rows = answers.filter("batch IS NULL").orderBy("part").select("n", "held", "few", "many", "mass").collect()
    columns = [np.concatenate([np.empty(0, np.uint64), *(unpack(r[i]) for r in rows)]) for i in range(5)]
    context, at = np.unique(columns[0], return_inverse=True)
    add = lambda x: np.bincount(at, x, len(context))
    held, many, mass = add(columns[1]), add(columns[3]), add(columns[4].view(np.float64))
    few = np.stack([add(x) for x in columns[2].reshape(-1, K).T], 1)
    return context, held + unseen(held, few), few, many, mass


def _answers(batches: DataFrame, parts: int, split: int, stored: Model | None = None) -> tuple:
    """Answers on words and on bigrams, the lower order, and the salts of the context of first words."""
    on_words = written(_count_words(batches, parts, split, stored and stored.words), "word-counts")
    tokens, words, often = _totals(on_words, "tokens", "words")
    lower = Words(tokens, words, often)
    start_salts = stored.start_salts if stored else math.ceil((batches.agg(F.sum(F.size("ids"))).first()[0] or 0) / split)
    on_pairs = written(_count_pairs(batches, on_words, parts, lower, start_salts, stored and stored.pairs), "pair-counts")
    return on_words, on_pairs, lower, start_salts


class Model(NamedTuple):
    """Counts of a training corpus as tables of parts, and how they were dealt to parts and salts."""

    words: DataFrame
    pairs: DataFrame
    parts: int
    start_salts: int
    split_tokens: int

    def save(self, path: str) -> None:
        """Tables ``words`` and ``pairs`` partitioned by the hash of words and contexts, and one row of ``numbers``."""
        spark = self.words.sparkSession
        self.words.write.parquet(f"{path}/words")
        self.pairs.write.parquet(f"{path}/pairs")
        spark.range(1).select(F.lit(self.parts).alias("parts"), F.lit(self.start_salts).alias("start_salts"), F.lit(self.split_tokens).alias("split_tokens")).write.parquet(f"{path}/numbers")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        numbers = spark.read.parquet(f"{path}/numbers").first()
        return Model(spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/pairs"), numbers["parts"], numbers["start_salts"], numbers["split_tokens"])


def fit_and_score(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The model of the documents that ``learns`` marks, and the scores of all ``docs`` as ``score_documents`` has them."""
    batches = batches_of(docs, learns, key, text)
    # half full on average: the last batch of a task is as full as its partition leaves it
    most = batches.count() * BATCH_TOKENS
    parts, split = max(1, math.ceil(most / PART_TOKENS / 2)), max(SPLIT_TOKENS, most // SALTS)
    on_words, on_pairs, lower, start_salts = _answers(batches, parts, split)
    model = Model(_stored_words(on_words), _stored_pairs(on_pairs), parts, start_salts, split)
    return model, _scores(batches, on_words, on_pairs, lower, parts, start_salts, docs.schema[key].dataType.simpleString())


def score_documents(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, learns, n_tokens, n_known, train_tokens, base_score, score); ``learns`` marks training documents."""
    return fit_and_score(docs, learns, key, text)[1]


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of texts that the model need not have seen."""
    batches = batches_of(docs, F.lit(False), key, text)
    on_words, on_pairs, lower, _ = _answers(batches, model.parts, model.split_tokens, model)
    scores = _scores(batches, on_words, on_pairs, lower, model.parts, model.start_salts, docs.schema[key].dataType.simpleString())
    return scores.drop("learns")


def _scores(batches: DataFrame, on_words: DataFrame, on_pairs: DataFrame, lower: Words, parts: int, start_salts: int, kind: str) -> DataFrame:
    """Scores of the batches' documents, from the answers they got."""
    tokens, words = lower.tokens, lower.words
    discounts = Discounts(_totals(on_pairs)[0])
    shared = batches.sparkSession.sparkContext.broadcast(_split_totals(on_pairs))

    def scored(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.itertuples(index=False):
            b = Batch(row)
            counts, salts = b.word_counts(answers[answers["n"].isna()], parts)
            context, runs, second, of_token, _, _, of = b.pairs(parts, salts, start_salts)
            told = answers[answers["n"].notna()].sort_values("part")
            read = lambda c: np.concatenate([unpack(x) for x in told[c]])
            n, held = read("n").astype(np.int64), read("held").astype(np.float64)
            asked = np.minimum.reduceat(n, np.cumsum(runs) - runs) == 0
            few, many, mass = read("few").reshape(-1, K).astype(np.float64), read("many").astype(np.float64), read("mass").view(np.float64)
            split, *sums = shared.value
            own = np.searchsorted(split, context[of > 1])
            held[of > 1] = sums[0][own]
            own = np.searchsorted(split, context[asked & (of > 1)])
            few[of[asked] > 1], many[of[asked] > 1], mass[of[asked] > 1] = (x[own] for x in sums[1:])
            weight = np.ones(len(context))
            left = held[asked] - (few * discounts.factor[1:] * np.arange(1, K + 1)).sum(1) - many
            weight[asked] = np.where(held[asked] > 0, left / np.maximum(held[asked], 1) / np.maximum(1 - mass, 1e-300), 1.0)
            of_pair = np.repeat(np.arange(len(context)), runs)
            low = lower.probability(counts[second])
            p = np.where(n > 0, discounts.kept(n) / np.maximum(held[of_pair], 1), weight[of_pair] * low)
            begin = np.cumsum(b.lengths) - b.lengths
            add = lambda x: np.add.reduceat(x, begin)
            c = counts.astype(np.float64)[b.stream]
            out.append(pd.DataFrame({
                "doc_id": pd.Series(list(b.ids), dtype=object), "learns": b.learns, "n_tokens": b.lengths, "n_known": add((c > 0).astype(np.int64)), "train_tokens": tokens,
                "base_score": add(np.log10((c + 1) / (tokens + words + 1))), "score": add(np.log10(p)[of_token]),
            }))
        return pd.concat(out)

    told = on_words.filter("batch IS NOT NULL").select("part", "batch", "counts", "salts").unionByName(
        on_pairs.filter("batch IS NOT NULL").drop("often", *TABLE), allowMissingColumns=True)
    return batches.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(
        scored, f"doc_id {kind}, learns boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
