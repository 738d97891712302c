"""Periodic runs of words by uniting suffix classes in order of falling LCP.

A run of period q repeats its words q apart over ``repeats`` periods at least. If its first word is at i, the
suffixes at i and i + q agree over length - q words, and among the suffixes that agree so far none
starts between them, or the period would be smaller. So a document's suffixes are sorted (prefix
doubling), neighbours of the order are edges weighted by their LCP, and edges are taken from the
largest LCP down as Kruskal's method does: a union-find over ordered sets of positions unites the two classes,
the smaller into the larger, and every two positions that become adjacent at a distance within the
LCP seed a run. Every run has exactly one such seed at its first word; seeds that the word
before would extend are other words of the same run. Nothing is compared twice and no pairs are listed.

Runs of ``least`` words and ``repeats`` periods make suffixes agree over ``least * (repeats - 1) / repeats`` words or more:
documents in which no stretch of that many words comes twice (hashes find them all) have no run,
and shorter LCPs need no edge. Words are numbered exactly, hashes only choose the documents.

Memory: a task holds one slice of its documents, about ``SLICE`` words, or a longer document alone with 4 bytes
a word for every doubling of its longest repeat. Time: n log n a document.

Defined cases: null text counts as empty and has no words, no runs and an empty collapsed text; repeated rows and
null ids are treated each; runs of equal start come by period; an empty table gives an empty result; other columns
pass through, but for columns named as an output, which are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAST = 24
REPEATS = 3
#: Words of the documents that are worked on together.
SLICE = 250_000


def scattered(x: np.ndarray) -> np.ndarray:
    """splitmix64: spreads 64-bit integers evenly."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeating(codes: np.ndarray, document: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the documents that hold some ``width`` words in a row twice, among few others."""
    if len(codes) < width:
        return np.zeros(0, np.int64)
    gram = scattered(codes.astype(np.uint64) + (document.astype(np.uint64) << np.uint64(32)))
    wide = 1
    while wide < width:
        step = min(wide, width - wide)
        gram = scattered(gram[:-step] * np.uint64(31) + gram[step:])
        wide += step
    inside = np.flatnonzero(document[:len(gram)] == document[width - 1:])
    order = np.argsort(gram[inside])
    twice = gram[inside[order[1:]]] == gram[inside[order[:-1]]]
    return np.unique(document[inside[order[1:][twice]]])


def suffix_ranks(x: np.ndarray) -> list[np.ndarray]:
    """Rank of every position among the stretches of 1, 2, 4, ... numbers from it, equal stretches sharing the first place.

    ``x`` ends in a number that stands nowhere else; the last ranks are the order of all suffixes.
    """
    n = len(x)
    place, keys, old = np.arange(n), x, np.zeros(n, np.int64)
    rank, ranks, wide = np.zeros(n, np.int64), [], 1
    while len(place):
        order = np.argsort(keys)
        place, keys, old = place[order], keys[order], old[order]
        here = np.arange(len(place))
        first = np.maximum.accumulate(np.where(np.r_[True, keys[1:] != keys[:-1]], here, 0))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], here, 0))
        rank[place] = old + first - group
        ranks.append(rank.astype(np.int32))
        alone = np.r_[first[1:] == here[1:], True] & (first == here)
        place = place[~alone]
        # a stretch that comes twice ends before its document does, so the next one starts inside
        old, keys = rank[place], rank[place] * n + rank[np.minimum(place + wide, n - 1)]
        wide *= 2
    return ranks


def edges(ranks: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(LCP, one suffix, the next in order) where suffixes agree over ``least`` numbers, the largest LCP first."""
    order = np.empty(len(ranks[-1]), np.int64)
    order[ranks[-1]] = np.arange(len(order))
    level = least.bit_length() - 1
    if level >= len(ranks):
        return (np.zeros(0, np.int64),) * 3
    same = np.flatnonzero(ranks[level][order[:-1]] == ranks[level][order[1:]])
    a, b = order[same], order[same + 1]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        lcp += (ranks[level][a + lcp] == ranks[level][b + lcp]).astype(np.int64) << level
    wanted = np.flatnonzero(lcp >= least)
    wanted = wanted[np.argsort(-lcp[wanted], kind="stable")]
    return lcp[wanted], a[wanted], b[wanted]


def seeds(x: list[int], lcps: list[int], a: list[int], b: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, period, LCP) of every run whose period is within the LCP; ``x[i - 1]`` never equals ``x[j - 1]`` over the edge of a document."""
    home: dict[int, list[int]] = {}
    for lcp, i, j in zip(lcps, a, b):
        large, small = home.get(i), home.get(j)
        if large is None:
            large = home[i] = [i]
        if small is None:
            small = [j]
        if len(large) < len(small):
            large, small = small, large
        last, top = -1, small[-1]
        for at_small, p in enumerate(small):
            at = bisect_left(large, p)
            if at:
                q = large[at - 1]
                if q != last and p - q <= lcp and x[q - 1] != x[p - 1]:
                    yield q, p - q, lcp
            if at < len(large):
                q = large[at]
                if q - p <= lcp and (p == top or q < small[at_small + 1]) and x[q - 1] != x[p - 1]:
                    yield p, q - p, lcp
            large.insert(at, p)
            home[p] = large
            last = p


def runs_of(documents: list[np.ndarray], least: int = LEAST, repeats: int = REPEATS) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document that has some, by start, then period.

    ``documents`` hold word numbers below 2^31.
    """
    agree = -(-least * (repeats - 1) // repeats)
    sizes = np.array([len(d) for d in documents], np.int64)
    codes = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64)
    chosen = repeating(codes, np.repeat(np.arange(len(documents)), sizes), agree)
    if not len(chosen):
        return {}
    # documents one after the other, each closed by a number of its own
    top = int(codes.max()) + 1
    x = np.concatenate([np.append(documents[d], top) + at * (top + 1) for at, d in enumerate(chosen)])
    starts = np.cumsum(np.r_[0, sizes[chosen] + 1])
    found: dict[int, list] = {}
    lcps, a, b = (v.tolist() for v in edges(suffix_ranks(x), agree))
    for start, period, lcp in seeds(x.tolist(), lcps, a, b):
        if period + lcp >= max(least, repeats * period):
            at = int(np.searchsorted(starts, start, "right")) - 1
            found.setdefault(int(chosen[at]), []).append((start - int(starts[at]), period + lcp, period))
    return {d: sorted(runs, key=lambda r: (r[0], r[2])) for d, runs in found.items()}


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each of ``n`` words that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


class Numbers(dict):
    """Words numbered in the order in which they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def find_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS, runs: str = "runs", collapsed: str = "collapsed",
) -> DataFrame:
    """``docs`` with the runs of each text (start, length, period; counted in words) and the text without their repeats.

    A run is a stretch of words q apart identical, q its least period, of ``max(least, repeats * q)`` words or more,
    that no neighbouring word extends. ``repeats`` is 2 or more.
    """
    if repeats < 2 or least < repeats:
        raise ValueError(f"runs need 2 repeats and a word each at least, not {repeats} in {least}")
    kept = [c for c in docs.columns if c not in (runs, collapsed)]
    run = T.StructType().add("start", T.LongType(), False).add("length", T.LongType(), False).add("period", T.LongType(), False)
    schema = T.StructType([docs.schema[c] for c in kept]).add(runs, T.ArrayType(run, False)).add(collapsed, T.StringType())
    run_type = pa.list_(pa.field("element", pa.struct([pa.field(f, pa.int64(), False) for f in ("start", "length", "period")]), False))

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
        start, words, held = 0, [], 0
        for value in batch.column(text_at).cast(pa.binary()):
            words.append((value.as_py() or b"").split())  # at the six ASCII white spaces
            held += len(words[-1])
            if held >= SLICE:
                yield start, words
                start, words, held = start + len(words), [], 0
        if words:
            yield start, words

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, words in slices(batch):
                numbers = Numbers()
                found = runs_of([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words], least, repeats)
                short = [b" ".join(compress(w, kept_words(len(w), found[d])) if d in found else w) for d, w in enumerate(words)]
                lists = pa.array([[dict(zip(("start", "length", "period"), r)) for r in found.get(d, ())] for d in range(len(words))], run_type)
                columns = [*batch.slice(start, len(words)).columns, lists, pa.array(short, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, runs, collapsed])

    text_at = kept.index(text)
    return docs.select(*kept).mapInArrow(find, schema)
