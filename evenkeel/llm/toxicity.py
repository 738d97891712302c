"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words (A-Z lower-cased, punctuation cut at the ends) and their first four and five
letters, which carry inflected forms. A chi-square test over the labelled sample, counted on Spark,
keeps the terms that speak for the toxic class (at most ``TERMS``, a value of ``CHI_SQUARE`` and ``MIN_EXAMPLES`` toxic
examples at least): by cosine over all words the nearest examples are those of like language and topic, and
far fewer toxic documents are found (README). The examples' vectors over the chosen terms form an inverted
index in blocks of ``BLOCK`` examples, with each term's largest weight per block. A document visits
blocks in falling order of their bound and stops when no block can reach its k-th neighbour, so the
neighbours are exact. Votes count by cosine; a logistic curve, fitted by leaving each example out,
calibrates them. The sample of examples is bounded: ``SAMPLE`` labelled documents, the least by hash.

Defined cases: null text counts as empty; a text without any chosen term has no neighbours and the
calibrated score of no votes; ties among neighbours go to the earlier example; without labels every
score is 0.5, with one class the class; labels null or of unknown documents are ignored; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import received, shipped
from evenkeel.llm.quality import labelled_sample

SAMPLE = 8000
TERMS = 4000
CHI_SQUARE = 40.0
#: Toxic examples a term must occur in; fewer may be copies of one text.
MIN_EXAMPLES = 6
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.7
MEMO_LIMIT = 300_000
EDGE = b".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~@^`"


def terms_of(word: bytes) -> tuple[bytes, ...]:
    """A word's terms; starts are marked apart from words."""
    plain = word.lower().strip(EDGE)
    if not plain:
        return ()
    letters = plain.decode("utf-8", "replace")
    return (plain, *(b"^" + letters[:n].encode() for n in (4, 5) if len(letters) > n))


class Index:
    """Examples in blocks with the largest weight of each term per block."""

    def __init__(self, terms: dict[bytes, int], examples: list[dict[int, int]], labels: np.ndarray, ids: list) -> None:
        self.terms, self.labels, self.ids = terms, labels, ids
        n = max(1, len(examples))
        df = Counter(t for e in examples for t in e)
        self.idf = np.array([np.log((1 + n) / (1 + df[t])) + 1 for t in range(len(terms))])
        self.blocks = -(-n // BLOCK)
        postings: list[list[tuple[int, float]]] = [[] for _ in terms]
        for i, counts in enumerate(examples):
            for t, w in zip(*self.vector(counts)):
                postings[t].append((i, w))
        self.at = [np.array([i for i, _ in p], np.int64) for p in postings]
        self.weight = [np.array([w for _, w in p]) for p in postings]
        self.bound = np.zeros((len(terms), self.blocks))
        for t, (at, weight) in enumerate(zip(self.at, self.weight)):
            np.maximum.at(self.bound[t], at // BLOCK, weight)
        self.cut = [np.searchsorted(at, np.arange(self.blocks + 1) * BLOCK) for at in self.at]
        self.curve = (0.0, 1.0)

    def vector(self, counts: dict[int, int]) -> tuple[list[int], np.ndarray]:
        """Terms and weights of unit length."""
        terms = sorted(counts)
        if not terms:
            return [], np.zeros(0)
        w = np.array([1 + np.log(counts[t]) for t in terms]) * self.idf[terms]
        return terms, w / np.sqrt((w * w).sum())

    def nearest(self, counts: dict[int, int], k: int = NEIGHBOURS, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example) of the ``k`` nearest with a positive cosine, nearest first, exactly."""
        terms, w = self.vector(counts)
        if not terms:
            return []
        bounds = w @ self.bound[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(best) == k and bounds[b] + 1e-12 < best[-1][0]:
                break
            scores = np.zeros(BLOCK)
            for t, x in zip(terms, w):
                lo, hi = self.cut[t][b], self.cut[t][b + 1]
                if hi > lo:
                    scores[self.at[t][lo:hi] - b * BLOCK] += x * self.weight[t][lo:hi]
            found = [(float(scores[i]), int(b * BLOCK + i)) for i in np.flatnonzero(scores) if b * BLOCK + i != without]
            best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:k]
        return best

    def votes(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes by cosine, in -0.5..0.5; 0 neighbours vote against."""
        total = sum(s for s, _ in near)
        return sum(s * self.labels[i] for s, i in near) / total - 0.5 if total > 0 else -0.5

    def calibrate(self, examples: list[dict[int, int]]) -> None:
        """Logistic curve of the votes, each example judged by the others."""
        x = np.array([self.votes(self.nearest(e, without=i)) for i, e in enumerate(examples)])
        y = self.labels
        target = np.where(y > 0.5, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        a = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a[0] + a[1] * x, -30, 30)))
            design = np.stack([np.ones_like(x), x], 1)
            w = np.maximum(p * (1 - p), 1e-9)
            step = np.linalg.solve(design.T @ (w[:, None] * design) + 1e-3 * np.eye(2), design.T @ (target - p) - 1e-3 * a)
            a = a + np.clip(step, -5, 5)
        self.curve = (float(a[0]), float(a[1]))

    def score(self, near: list[tuple[float, int]]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * self.votes(near), -30, 30))))


class Terms(dict):
    """Chosen terms of each word seen, forgotten when they grow many."""

    def __init__(self, chosen: dict[bytes, int]) -> None:
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        found = tuple(self.chosen[t] for t in terms_of(word) if t in self.chosen)
        if len(word) <= 64:
            self[word] = found
        return found

    def counts(self, text: str) -> Counter:
        return Counter(t for word in text.encode("utf-8", "replace").split() for t in self[word])


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic", bound: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Index | float:
    """The index of a bounded labelled sample; a constant score where there is nothing to learn."""
    sample = labelled_sample(docs, labels, label, may_learn, bound, key, text)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, list[int]] = {}
        for batch in batches:
            for y, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t in {t for w in set(body.encode("utf-8", "replace").split()) for t in terms_of(w)}:
                    counts.setdefault(t, [0, 0])[y >= 0.5] += 1
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))], ["term", "clean", "toxic"])

    sizes = [r["n"] for r in sample.groupBy((F.col("__label") >= 0.5).alias("y")).agg(F.count("*").alias("n")).orderBy("y").collect()]
    if len(sizes) < 2:
        return 0.5 if not sizes else float(sample.agg(F.max("__label")).first()[0] >= 0.5)
    n0, n1 = sizes
    tally = sample.select("__label", "text").mapInArrow(words, "term binary, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    apart = F.col("b") * (n0 - F.col("a")) - F.col("a") * (n1 - F.col("b"))
    total, have = float(n0 + n1), F.col("a") + F.col("b")
    chi = total * apart * apart / (float(n0) * n1 * have * F.greatest(total - have, F.lit(1.0)))
    chosen = tally.withColumn("chi", chi.cast("double")).filter((F.col("chi") >= CHI_SQUARE) & (apart > 0) & (F.col("b") >= MIN_EXAMPLES))
    chosen = chosen.orderBy(F.col("chi").desc(), "term").limit(TERMS).select("term").collect()
    terms = {bytes(r.term): i for i, r in enumerate(chosen)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Terms(terms)
        for batch in batches:
            found = [sorted(memo.counts(t).items()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(
                pa.array([[x[i] for x in f] for f in found], pa.list_(pa.int32())) for i in (0, 1))], ["doc_id", "label", "terms", "counts"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "__label", "text").mapInArrow(vectors, f"doc_id {kind}, label double, terms array<int>, counts array<int>").collect()
    rows = sorted(rows, key=lambda r: (r.terms, r.doc_id))  # like examples share blocks; labels take no part in ties
    examples = [dict(zip(r.terms, r.counts)) for r in rows]
    index = Index(terms, examples, np.array([float(r.label >= 0.5) for r in rows]), [r.doc_id for r in rows])
    index.calibrate(examples)
    return index


def score_documents(docs: DataFrame, index: Index | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, evidence): evidence lists the ids of the toxic neighbours, nearest first."""
    shared = shipped(docs.sparkSession, index)
    kind = docs.schema[key].dataType

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = received(shared)
        memo = None if isinstance(index, float) else Terms(index.terms)
        none = index if memo is None else index.score([])
        for batch in batches:
            scores, evidence = [], []
            for value in batch.column(1):
                counts = memo.counts(value.as_py() or "") if memo is not None else {}
                near = index.nearest(counts) if counts else []
                scores.append(index.score(near) if near else none)
                evidence.append([index.ids[i] for _, i in near if index.labels[i] > 0.5])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(batch.column(0).type))], ["doc_id", "score", "evidence"])

    name = kind.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(scored, f"doc_id {name}, score double, evidence array<{name}>")
