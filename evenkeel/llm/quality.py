"""Quality by attention-based multiple-instance learning (Ilse, Tomczak and Welling 2018).

A document is a bag of passages of ``PASSAGE`` words; whole texts are used. Every passage is encoded
by counts (kinds of characters, hashed byte pairs, repetition within the passage and the document),
a learned layer turns the counts into a vector, gated attention weighs the passages of a document,
and the weighted vector gives the score. Labels belong to documents alone; which passage speaks for
them is learned. The fit uses a bounded sample of labelled rows, the least by hash: ``SAMPLE``, and ``FIT_PASSAGES`` of each.

Defined cases: null text counts as empty; an empty text is one passage without words; a document
with several labels has the mean; labels null or of unknown documents are ignored; with no labels,
or one class only, every score is the share of good labels (0.5 without any); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 64
#: Labelled documents the fit may use, and passages of each, evenly spread over longer ones; scores use all passages.
SAMPLE = 4000
FIT_PASSAGES = 320
PAIRS = 64
HIDDEN = 16
THRESHOLD = 0.3


def _kinds() -> np.ndarray:
    kind = np.full(256, 9)
    for i, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".,;:'-", b"!?", b"#$%&*@^~_=+<>", b"|/\\()[]{}\"")):
        kind[list(members)] = i
    kind[128:] = 8
    return kind


KIND = _kinds()
PAIR = np.random.default_rng(1).integers(0, PAIRS, 65536)
WIDTH = 10 + PAIRS + 7


def encode(text: str) -> np.ndarray:
    """One row of counts per passage."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        return np.zeros((1, WIDTH), np.float32)
    count = -(-n // PASSAGE)
    of_word = np.arange(n) // PASSAGE
    in_passage = np.bincount(of_word, minlength=count)
    length = np.fromiter(map(len, words), np.int64, n)
    raw = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    of_byte = np.repeat(of_word, length + 1)
    size = np.bincount(of_byte, minlength=count)[:, None]
    kinds = np.bincount(of_byte * 10 + KIND[raw], minlength=count * 10).reshape(count, 10) / size
    pair = PAIR[raw[:-1].astype(np.int64) * 256 + raw[1:]]
    pairs = np.sqrt(np.bincount(of_byte[:-1] * PAIRS + pair, minlength=count * PAIRS).reshape(count, PAIRS) / size)
    word = np.fromiter(map(hash, words), np.int64, n)  # equal words have equal hashes within a process; no more is used
    triple = word.copy()
    triple[1:] = triple[1:] * 31 + word[:-1]
    triple[2:] = triple[2:] * 17 + word[:-2]
    mean = lambda x: np.bincount(of_word, x, minlength=count) / in_passage
    again = lambda x: mean(~np.isin(np.arange(n), np.unique(x, return_index=True)[1]))
    follows = np.zeros(n)
    follows[1:] = word[1:] == word[:-1]
    distinct = np.bincount(np.unique(of_word * 1.0 + 0j + word.astype(np.float64) * 1j).real.astype(np.int64), minlength=count) / in_passage
    rest = [in_passage / PASSAGE, mean(length) / 10, np.log1p(np.maximum.reduceat(length, np.arange(0, n, PASSAGE))), mean(follows), distinct, again(word), again(triple)]
    return np.hstack([kinds, pairs, np.stack(rest, 1)]).astype(np.float32)


def spread(passages: np.ndarray, most: int = FIT_PASSAGES) -> np.ndarray:
    """``most`` of the passages at even distances, all if they are no more."""
    return passages if len(passages) <= most else passages[np.linspace(0, len(passages) - 1, most).astype(int)]


class Attention:
    """Encoder layer, gated attention, logistic score; fitted by Adam."""

    def __init__(self, width: int, hidden: int = HIDDEN, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        self.p = {
            "W": draw.normal(0, width ** -0.5, (width, hidden)), "b": np.zeros(hidden),
            "V": draw.normal(0, hidden ** -0.5, (hidden, hidden)), "U": draw.normal(0, hidden ** -0.5, (hidden, hidden)),
            "w": draw.normal(0, hidden ** -0.5, hidden), "c": draw.normal(0, hidden ** -0.5, hidden), "c0": np.zeros(1),
        }
        self.mean, self.scale, self.constant = np.zeros(width), np.ones(width), None

    def _forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> tuple:
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        starts = np.searchsorted(bag, np.arange(bags))
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, s, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))

    def score(self, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        """Scores of the bags; ``bag`` numbers the rows of ``x`` in ascending order, none empty."""
        if self.constant is not None:
            return np.full(bags, self.constant)
        return self._forward((x - self.mean) / self.scale, bag, bags)[-1]

    def _gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h, t, s, a, z, out = self._forward(x, bag, len(y))
        d = (out - y) / len(y)
        dz = d[:, None] * p["c"]
        dh = a[:, None] * dz[bag]
        da = (dz[bag] * h).sum(1)
        starts = np.searchsorted(bag, np.arange(len(y)))
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["U"].T
        dx = dh * (1 - h * h)
        return {"W": x.T @ dx + 1e-4 * p["W"], "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ d, "c0": d.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.01) -> Attention:
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-3
        bags = [(b - self.mean) / self.scale for b in bags]
        draw = np.random.default_rng(5)
        first, second, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            order = draw.permutation(len(y))
            for i in range(0, len(y), batch):
                chosen = order[i:i + batch]
                bag = np.repeat(np.arange(len(chosen)), [len(bags[j]) for j in chosen])
                step += 1
                for k, g in self._gradients(np.concatenate([bags[j] for j in chosen]), bag, y[chosen]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    now = rate * (1 - epoch / epochs)
                    self.p[k] = self.p[k] - now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, bound: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``bound`` labelled documents, the least by hash of their id.

    Only ids are ordered; texts join the bounded list of ids. An id that occurs in several rows
    gives its first row per task only a vote each; ids are expected to be unique.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & may_learn)
    known = known.groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("__label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality", bound: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Attention:
    """The model learned from a bounded sample of labelled documents."""
    sample = labelled_sample(docs, labels, label, may_learn, bound, key, text)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [spread(encode(t)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blocks, pa.binary())], ["doc_id", "label", "block"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "__label", "text").mapInArrow(encoded, f"doc_id {kind}, label double, block binary").toPandas()
    rows = rows.sort_values(["doc_id", "label"], kind="stable")  # the fit must not depend on the order of tasks
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH).astype(np.float64) for b in rows["block"]]
    return Attention(WIDTH).fit(bags, (rows["label"].to_numpy() >= 0.5).astype(float))


def score_documents(docs: DataFrame, model: Attention, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                bags = [encode(t or "") for t in batch.column(1).to_pylist()]
                bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
                scores = model.score(np.concatenate(bags), bag, len(bags))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(scored, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Attention, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns as they were."""
    at = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                bags = [encode(t or "") for t in batch.column(at).to_pylist()]
                bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
                yield batch.filter(pa.array(model.score(np.concatenate(bags), bag, len(bags)) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
