"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

A word is a point that counts each letter. Replacing a letter takes one count down and another up, deleting one
takes a single count down, so words one edit apart lie within L1 distance two, in one pair of lengths (l, l) or (l, l - 1). For
each length, the upper part of a k-d tree deals words to cells; it is fitted on a bounded sample of the vocabulary and
broadcast, while every word is indexed. A word is sent as a query to its own length and to the next shorter one, to the
cells whose box lies within the steps an edit may take; a cell is one Spark group, split into blocks of bounded size. Inside,
the tree goes on down to small leaves with the same box pruning; in a leaf, integer distances tell the points
exactly one edit away, which name the letters concerned. Then letter order is verified: the edit is made at each
place of that letter, the result is looked up among the words of the cell by a hash that such an edit changes by
one term, and hits are compared letter by letter.

A word's form is its most frequent near word, if it is ``ratio`` times as frequent; forms are followed
by joins that double their reach each turn (frequencies grow by that ratio, so chains are short and have no loops).

Defined cases: null and empty texts have no words; a null id counts as an empty one; rows that repeat are
counted each; ties of frequency go to the smallest word in code-point order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import counted_small, text_of, written
from evenkeel.llm.runs import scattered

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Distinct words a counting task holds before it hands on what it has.
COUNT_LIMIT = 200_000
#: Words that fit the upper trees, and the longest of them; every word is indexed.
SAMPLE = 200_000
SAMPLE_LENGTH = 100
#: Words a cell is meant to hold, and letters of the words and of the queries that meet in one task.
CELL = 40_000
BLOCK_WORDS = 1_000_000
BLOCK_QUERIES = 2_000_000
#: Points of a leaf, and pairs that are verified together.
LEAF = 64
PAIRS = 200_000
#: Letters: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64


# ------------------------------------------------------------------- words and their counts


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    edit: Callable[[str, Counter], Counter] | None = None,
) -> DataFrame:
    """(word, n) of the words of ``least_length`` letters or more that occur ``least_count`` times or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. ``edit`` may
    change the counts of a document's words, given its id as text; it may shorten words, not lengthen them.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            words = [w for w in total if len(w) >= least_length]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], ["word", "n"])

        total: Counter = Counter()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = Counter(find(value.as_py().lower().decode("utf-8", "replace")))
                total.update(edit(name, found) if edit else found)
                if len(total) > COUNT_LIMIT:
                    yield told()
                    total = Counter()
        yield told()

    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    parts = docs.select(name.alias("key"), text_of(text).alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def codes_of(words: list[str], length: int) -> np.ndarray:
    """The letters of words of equal ``length`` as numbers, one row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
    return np.where(points < 128, points - 97, points - 192 + 26).astype(np.uint8)


def vectors_of(codes: np.ndarray) -> np.ndarray:
    """How often each row holds each letter."""
    rows = np.repeat(np.arange(len(codes)) * LETTERS, codes.shape[1])
    counts = np.bincount(rows + codes.ravel(), minlength=len(codes) * LETTERS).reshape(len(codes), LETTERS)
    return counts.astype(np.int16 if codes.shape[1] < 30_000 else np.int32)


# ---------------------------------------------------------------------------- the k-d tree


def most_even(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, count) that part the points most evenly into those with at most that count and the others."""
    middle = np.partition(points, len(points) // 2, axis=0)[len(points) // 2]
    best = None
    for cut in (middle, middle - 1):
        low = (points <= cut).sum(axis=0)
        even = np.minimum(low, len(points) - low)
        letter = int(even.argmax())
        if even[letter] and (best is None or even[letter] > best[0]):
            best = (even[letter], letter, int(cut[letter]))
    return best and best[1:]


def passing(count: np.ndarray, cut: int, down: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which queries reach points with at most ``cut``, and which those with more; steps left are 0 or 1 each way.

    A step spent on a letter is spent: the next box beyond it is two steps away.
    """
    return (count <= cut) | ((count == cut + 1) & (down > 0)), (count > cut) | ((count == cut) & (up > 0))


def upper_tree(points: np.ndarray, most: float, first: int) -> list[tuple[int, int, int, int]]:
    """Nodes (letter, cut, low child, high child) or (-1, cell, 0, 0) with at most ``most`` of ``points`` each where they can be parted."""
    nodes: list = [None]
    open_nodes, cell = [(0, np.arange(len(points)))], first
    while open_nodes:
        at, inside = open_nodes.pop()
        split = most_even(points[inside]) if len(inside) > most else None
        if split is None:
            nodes[at] = (-1, cell, 0, 0)
            cell += 1
            continue
        low = points[inside, split[0]] <= split[1]
        nodes[at] = (*split, len(nodes), len(nodes) + 1)
        open_nodes += [(len(nodes), inside[low]), (len(nodes) + 1, inside[~low])]
        nodes += [None, None]
    return nodes


def cells_near(nodes: list, points: np.ndarray, steps: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows of ``points``) whose box lies within the ``steps`` down and up."""
    n = len(points)
    waiting = [(0, np.arange(n), np.full(n, steps[0], np.int8), np.full(n, steps[1], np.int8))]
    while waiting:
        at, rows, down, up = waiting.pop()
        letter, cut, low, high = nodes[at]
        if letter < 0:
            yield cut, rows
            continue
        count = points[rows, letter]
        to_low, to_high = passing(count, cut, down, up)
        waiting.append((low, rows[to_low], (down - (count > cut))[to_low], up[to_low]))
        waiting.append((high, rows[to_high], down[to_high], (up - (count <= cut))[to_high]))


def points_near(points: np.ndarray, queries: np.ndarray, steps: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``queries``, rows of ``points``) exactly the ``steps`` apart; the tree is built as it is walked.

    Where the steps are one down and one up, or one down alone, the squared distance is the number of steps and nothing else is that near.
    """
    kind = np.float32 if points.size and points[0].sum() <= 4000 else np.float64  # squares stay exact
    p, q = points.astype(kind), queries.astype(kind)
    pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
    n = len(queries)
    waiting = [(np.arange(len(points)), np.arange(n), np.full(n, steps[0], np.int8), np.full(n, steps[1], np.int8))]
    while waiting:
        inside, rows, down, up = waiting.pop()
        if not len(rows) or not len(inside):
            continue
        split = most_even(points[inside]) if len(inside) > LEAF else None
        if split is None:
            step = max(1, PAIRS * 10 // len(inside))
            for start in range(0, len(rows), step):
                some = rows[start:start + step]
                apart = qq[some][:, None] + pp[inside][None, :] - 2 * (q[some] @ p[inside].T)
                i, j = np.nonzero(apart == sum(steps))
                yield some[i], inside[j]
            continue
        letter, cut = split
        low, count = points[inside, letter] <= cut, queries[rows, letter]
        to_low, to_high = passing(count, cut, down, up)
        waiting.append((inside[low], rows[to_low], (down - (count > cut))[to_low], up[to_low]))
        waiting.append((inside[~low], rows[to_high], down[to_high], (up - (count <= cut))[to_high]))


# --------------------------------------------------------------------------- letter order


class Words:
    """The words of a block: their letters, a hash that is a sum over places, and lookup by it."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.factors = scattered(np.arange(codes.shape[1] + 1, dtype=np.uint64))
        self.hashes = ((codes + np.uint64(1)) * self.factors[:-1]).sum(axis=1, dtype=np.uint64)
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        _, often = np.unique(self.sorted, return_counts=True)
        self.most = int(often.max()) if len(often) else 0
        self.held = np.zeros(1 << 20, bool)
        self.held[self.sorted >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``hashes``, words of that hash)."""
        rows = np.flatnonzero(self.held[hashes >> np.uint64(44)])
        at = np.searchsorted(self.sorted, hashes[rows])
        for further in range(self.most):  # words may share a hash
            place = np.minimum(at + further, len(self.sorted) - 1)
            hit = self.sorted[place] == hashes[rows]
            yield rows[hit & (at + further < len(self.sorted))], self.order[place[hit & (at + further < len(self.sorted))]]


class Asked:
    """The queries of a block with the sums that an edit changes."""

    def __init__(self, codes: np.ndarray, words: Words) -> None:
        self.codes, self.words = codes, words
        length, factors, terms = words.codes.shape[1], words.factors[:-1], codes + np.uint64(1)
        if codes.shape[1] == length:
            self.hashes = (terms * factors).sum(axis=1, dtype=np.uint64)
            return
        # sums of the letters before a place, and of those behind it, which move one to the front
        self.before, self.behind = np.zeros((2, len(codes), length + 1), np.uint64)
        np.cumsum(terms[:, :-1] * factors, axis=1, out=self.before[:, 1:])
        self.behind[:, :-1] = np.cumsum(terms[:, :0:-1] * factors[::-1], axis=1)[:, ::-1]

    def replaced(self, qi: np.ndarray, less: np.ndarray, more: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) where one letter ``less`` of the query, replaced by ``more``, gives the word."""
        pair, place = np.nonzero(self.codes[qi] == less[:, None])
        change = (more.astype(np.uint64) - less.astype(np.uint64))[pair] * self.words.factors[place]
        for row, word in self.words.find(self.hashes[qi[pair]] + change):
            query, at = qi[pair[row]], place[row]
            same = (self.codes[query] != self.words.codes[word]).sum(axis=1) == 1
            same &= self.codes[query, at] != self.words.codes[word, at]
            yield query[same], word[same]

    def deleted(self, qi: np.ndarray, less: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) where the query without one letter ``less`` is the word."""
        is_less = self.codes[qi] == less[:, None]
        is_less[:, 1:] &= self.codes[qi, :-1] != less[:, None]  # any of equal letters in a row gives the same word
        pair, place = np.nonzero(is_less)
        places = np.arange(self.words.codes.shape[1])[None, :]
        for row, word in self.words.find(self.before[qi[pair], place] + self.behind[qi[pair], place]):
            query, at = qi[pair[row]], place[row][:, None]
            same = (self.codes[query[:, None], places + (places >= at)] == self.words.codes[word]).all(axis=1)
            yield query[same], word[same]


def near_in_block(members: pd.DataFrame, queries: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``queries``, rows of ``members``) one edit apart; all members have one length, all queries that or one more."""
    if not len(members) or not len(queries):
        return
    length, longer = len(members["word"].iloc[0]), len(queries["word"].iloc[0])
    words = Words(codes_of(members["word"].tolist(), length))
    asked = Asked(codes_of(queries["word"].tolist(), longer), words)
    points = np.unique(vectors_of(words.codes), axis=0)
    found, of_query = np.unique(vectors_of(asked.codes), axis=0, return_inverse=True)
    order = np.argsort(of_query, kind="stable")  # queries of one point follow each other
    ends = np.searchsorted(of_query[order], np.arange(len(found) + 1))
    waiting, held = [], 0

    def verify() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, j = (np.concatenate(x) for x in zip(*waiting))
        moved = points[j] - found[i]
        less, more = moved.argmin(axis=1), moved.argmax(axis=1)
        size = ends[i + 1] - ends[i]
        pair = np.repeat(np.arange(len(i)), size)
        query = order[np.repeat(ends[i] - np.cumsum(size) + size, size) + np.arange(len(pair))]
        for start in range(0, len(pair), PAIRS):
            some, qi = pair[start:start + PAIRS], query[start:start + PAIRS]
            yield from asked.replaced(qi, less[some], more[some]) if length == longer else asked.deleted(qi, less[some])

    for i, j in points_near(points, found, (1, 1) if length == longer else (1, 0)):
        waiting.append((i, j))
        held += len(i)
        if held >= PAIRS:
            yield from verify()
            waiting, held = [], 0
    if held:
        yield from verify()


# ----------------------------------------------------------------------------------- on Spark


def upper_trees(vocabulary: DataFrame, cell: int = CELL) -> dict[int, list]:
    """Upper tree of every length up to ``SAMPLE_LENGTH`` with more than ``cell`` words; others are a cell each."""
    sizes = {r.length: r.n for r in vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).filter(
        (F.col("n") > cell) & (F.col("length") <= SAMPLE_LENGTH)).collect()}
    if not sizes:
        return {}
    share = min(1.0, SAMPLE / sum(sizes.values()))
    chosen = (F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < int(share * (1 << 32))) & F.length("word").isin(list(sizes))
    by_length: dict[int, list[str]] = {}
    for row in vocabulary.filter(chosen).select("word").collect():
        by_length.setdefault(len(row.word), []).append(row.word)
    trees, first = {}, 0
    for length, words in sorted(by_length.items()):
        words.sort()
        trees[length] = upper_tree(vectors_of(codes_of(words, length)), cell * len(words) / sizes[length], first)
        first += len(trees[length])
    return trees


def dealt(vocabulary: DataFrame, trees: dict[int, list]) -> DataFrame:
    """(cell, longer, asks, word, n): each word as a member of its cell, and as a query to the cells near it.

    ``longer`` is 1 for the search of words one letter shorter; members take part in both searches of their cell.
    """
    shared = vocabulary.sparkSession.sparkContext.broadcast(trees)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        for frame in frames:
            for length, group in frame.groupby(frame["word"].str.len()):
                vectors = vectors_of(codes_of(group["word"].tolist(), int(length)))
                for tree, steps, longer, asks in ((length, (0, 0), 0, False), (length, (0, 0), 1, False), (length, (1, 1), 0, True), (length - 1, (1, 0), 1, True)):
                    # lengths without a tree are one cell, numbered below zero
                    for cell, rows in cells_near(trees.get(tree, [(-1, -int(tree), 0, 0)]), vectors, steps):
                        if len(rows):
                            yield group.iloc[rows].assign(cell=cell, longer=longer, asks=asks)[["cell", "longer", "asks", "word", "n"]]

    return vocabulary.select("word", "n").mapInPandas(deal, "cell long, longer int, asks boolean, word string, n long")


def near_words(vocabulary: DataFrame, cell: int = CELL, block_words: int = BLOCK_WORDS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(word, near, near_n): every two words one edit apart, in both directions, each once."""
    rows = written(dealt(vocabulary, upper_trees(vocabulary, cell)), "cells")
    letters = lambda asks: F.sum(F.when(F.col("asks") == asks, F.length("word")).otherwise(0))
    # a cell of many words or queries is dealt to blocks: each block of words meets each block of queries
    counts = written(rows.groupBy("cell", "longer").agg(
        F.ceil(letters(False) / block_words).cast("int").alias("parts"), F.ceil(letters(True) / block_queries).cast("int").alias("turns")).filter(
        "parts > 0 AND turns > 0"), "cell-sizes")
    mine = F.xxhash64("word")
    blocks = rows.join(counted_small(counts, counts.count()), ["cell", "longer"]).withColumns({
        "part": F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(mine, F.col("parts")).cast("int"))))}).withColumn(
        "turn", F.explode(F.when(F.col("asks"), F.array(F.pmod(mine, F.col("turns")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("turns") - 1))))

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        members, queries = block[~block["asks"]], block[block["asks"]]
        found = [np.concatenate(x) for x in zip(*near_in_block(members, queries))] or [np.zeros(0, np.int64)] * 2
        asks, said = queries.iloc[found[0]], members.iloc[found[1]]
        links = [pd.DataFrame({"word": asks["word"].to_numpy(), "near": said["word"].to_numpy(), "near_n": said["n"].to_numpy()})]
        if block["longer"].iloc[0]:  # words of one length find each other, longer words are not searched for
            links.append(pd.DataFrame({"word": said["word"].to_numpy(), "near": asks["word"].to_numpy(), "near_n": asks["n"].to_numpy()}))
        return pd.concat(links)

    return blocks.groupBy("cell", "longer", "part", "turn").applyInPandas(meet, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form of each chain."""
    chains = written(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(chains.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "chains")
        chains = moved.select("word", "root")
        if not moved.filter("moved").head(1):
            return chains


def variants(vocabulary: DataFrame, ratio: int = RATIO, cell: int = CELL) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every (word, n)."""
    vocabulary = written(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(vocabulary, cell).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    grown = -F.col("best.less") >= ratio * F.col("n")
    known = written(vocabulary.join(near, "word", "left").select(
        "word", F.when(grown, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(grown, -F.col("best.less")).alias("form_n")), "forms")
    chains = roots(known.filter("form IS NOT NULL"))
    return known.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
