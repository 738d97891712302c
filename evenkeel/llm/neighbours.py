"""Nearest neighbours by stable projections under a kd-tree (SRS: Sun, Wang, Qin, Zhang and Lin 2014).

Vectors are projected onto ``DIMENSIONS`` Gaussian directions. A squared projected distance is the
squared true distance times a chi-square variable, so once the next projected neighbour lies beyond
the k-th true distance found times the root of the chi-square quantile of ``CONFIDENCE``, a nearer
vector is missed with at most the remaining probability: the search stops. Candidates up to there
are verified on the original vectors.

The upper levels of the kd-tree split a bounded sample of projections into cells of about
``CELL_ROWS`` rows; every row is then indexed in its cell, and a task holds one cell with a
smaller kd-tree. A query searches its own cell first; the radius found there names the further
cells it must visit. Queries of a much visited cell are dealt over copies of the cell; a cell that
holds more than ``PART_ROWS`` rows, as the sample bounds the number of cells, is dealt to parts with a tree each,
and its queries search them all.

Equal vectors are indexed once with their least ids, k + 1 of them, which is all that any list of
k neighbours can show; the reduction is map-side, so a vector of a third of all rows stays small.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do null ids; vectors of different lengths are never neighbours; repeated rows count once;
with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import joined_by_share, written

DIMENSIONS = 8
CONFIDENCE = 0.99
CELL_ROWS = 16_384
PART_ROWS = 65_536
#: Projections the upper tree may be fitted on, and how many each cell needs of them.
SAMPLE = 1_000_000
SAMPLE_PER_CELL = 32
LEAF = 64
QUERIES_PER_TASK = 4_096
SEED = 11


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of even ``m`` <= x) = p."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if below < p else (low, x)
    return high


def directions(length: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, length]).normal(size=(length, m))


def project(vectors: pd.Series, m: int, seed: int) -> np.ndarray:
    """Projections of vectors, which may differ in length."""
    out = np.zeros((len(vectors), m))
    lengths = vectors.map(len).to_numpy()
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[at] = np.stack(vectors.iloc[at].to_numpy()).astype(np.float64) @ directions(int(n), m, seed)
    return out


def upper_tree(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Splits (dimension, value) of a complete binary tree, root first: the widest side at its median."""
    splits: list[tuple[int, float]] = []
    level = [points]
    for _ in range(depth):
        below = []
        for p in level:
            d = int(np.argmax(np.ptp(p, axis=0))) if len(p) else 0
            v = float(np.median(p[:, d])) if len(p) else 0.0
            splits.append((d, v))
            below += [p[p[:, d] < v], p[p[:, d] >= v]]
        level = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if splits:
        dims, values = np.array([d for d, _ in splits]), np.array([v for _, v in splits])
        for _ in range((len(splits) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), dims[node]] >= values[node])
    return node - len(splits)


class Leaves:
    """kd-tree of a cell, kept as its leaves: runs of points and their boxes."""

    def __init__(self, points: np.ndarray) -> None:
        parts, open_ = [], [np.arange(len(points))]
        while open_:
            at = open_.pop()
            if len(at) <= LEAF:
                parts.append(at)
                continue
            d = int(np.argmax(np.ptp(points[at], axis=0)))
            order = at[np.argsort(points[at, d], kind="stable")]
            open_ += [order[:len(at) // 2], order[len(at) // 2:]]
        self.points, self.parts = points, parts
        self.low = np.stack([points[p].min(0) for p in parts])
        self.high = np.stack([points[p].max(0) for p in parts])

    def search(self, vectors: np.ndarray, first: np.ndarray, query: np.ndarray, at: np.ndarray, k: int, bound: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the nearest found, ties to the smaller of ``first``; ``bound`` is a k-th squared distance known before."""
        gap = np.maximum(0, np.maximum(self.low - at, at - self.high))
        reach = (gap * gap).sum(1)
        rows, found = np.zeros(0, np.int64), np.zeros(0)
        for leaf in np.argsort(reach, kind="stable"):
            if reach[leaf] > factor * bound:
                break
            part = self.parts[leaf]
            near = part[((self.points[part] - at) ** 2).sum(1) <= factor * bound]
            if len(near):
                rows = np.concatenate([rows, near])
                found = np.concatenate([found, ((vectors[near] - query) ** 2).sum(1)])
                if len(found) >= k:
                    # equal distances are cut by id; a row's least id is enough, as each row has one at least
                    keep = np.lexsort((first[rows], found))[:k]
                    rows, found = rows[keep], found[keep]
                    bound = min(bound, float(found[-1]))
        return rows, found


def search_cell(points: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """Nearest of one cell's ``points`` for its ``queries``."""
    out = {"query": [], "ids": [], "squared": [], "home": []}
    if len(points) and len(queries):
        of_point, of_query = points["vec"].map(len).to_numpy(), queries["vec"].map(len).to_numpy()
        for n in np.unique(of_query):
            mine = points[of_point == n]
            if not len(mine):
                continue
            vectors = np.stack(mine["vec"].to_numpy()).astype(np.float64)
            tree = Leaves(np.stack(mine["proj"].to_numpy()))
            ids = mine["ids"].to_numpy()
            first = np.array([x[0] for x in ids])
            for q in queries[of_query == n].itertuples(index=False):
                rows, found = tree.search(vectors, first, np.asarray(q.vec, np.float64), np.asarray(q.proj), k, q.bound, factor)
                out["query"] += [q.query] * len(rows)
                out["ids"] += [ids[r] for r in rows]
                out["squared"] += found.tolist()
                out["home"] += [q.home] * len(rows)
    return pd.DataFrame({"query": pd.Series(out["query"], dtype=object), "ids": pd.Series(out["ids"], dtype=object),
                         "squared": np.array(out["squared"], float), "home": np.array(out["home"], np.int64)})


def usable(vec: Column) -> Column:
    limit = F.lit(float("inf"))
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    return vec.isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0)


def nearest(
    rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE,
    m: int = DIMENSIONS, cell_rows: int = CELL_ROWS, seed: int = SEED, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest rows found for each query, itself left out."""
    spark = rows.sparkSession
    factor = chi_square_quantile(confidence, m)
    name = rows.schema[key].dataType.simpleString()
    # adding 0.0 makes one zero of both
    valid = rows.select(F.col(key).alias("id"), F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vec"), is_query.alias("asks"))
    valid = valid.filter(F.col("id").isNotNull() & usable(F.col("vec")))

    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    least = valid.select("vec", "id").withColumn("n", rank).filter(F.col("n") <= k + 1)
    distinct = least.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))

    def projected(batches):
        for pdf in batches:
            pdf["proj"] = list(project(pdf["vec"], m, seed))
            yield pdf

    points = written(distinct.mapInPandas(projected, f"vec array<double>, ids array<{name}>, proj array<double>"), "projections")
    n = points.count()
    depth = max(0, math.ceil(math.log2(max(1, n / cell_rows))))
    depth = min(depth, int(math.log2(SAMPLE / SAMPLE_PER_CELL)))
    wanted = SAMPLE_PER_CELL * 2 ** depth
    sample = points.select("proj", F.xxhash64("vec").alias("h")).filter(F.pmod("h", F.lit(max(1, n // (2 * wanted)))) == 0)
    sample = sample.orderBy("h", "proj").limit(min(SAMPLE, 4 * wanted)).select("proj").toPandas()
    splits = upper_tree(np.stack(sample["proj"].to_numpy()) if len(sample) else np.zeros((0, m)), depth)

    def in_cells(batches):
        for pdf in batches:
            pdf["cell"] = cell_of(np.stack(pdf["proj"].to_numpy()), splits) if len(pdf) else np.zeros(0, np.int64)
            yield pdf

    points = written(points.mapInPandas(in_cells, f"vec array<double>, ids array<{name}>, proj array<double>, cell long"), "cells")
    sides = [f(F.col("proj")[i]).alias(f"{s}{i}") for s, f in (("low", F.min), ("high", F.max)) for i in range(m)]
    boxes = points.groupBy("cell").agg(*sides).toPandas().sort_values("cell")  # one row per cell, bounded by the sample
    cells, low, high = boxes["cell"].to_numpy(), boxes[[f"low{i}" for i in range(m)]].to_numpy(), boxes[[f"high{i}" for i in range(m)]].to_numpy()

    asking = valid.filter("asks").select("id", "vec")
    asked = written(asking.select("vec").distinct().join(points.select("vec", "proj", "cell"), "vec").withColumn("query", F.sha2(F.to_json(F.struct("vec")).cast("binary"), 256)), "queries")
    first_schema = f"query string, ids array<{name}>, squared double, home long"
    held = written(points.groupBy("cell").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")), "cell-parts")

    def run(at: DataFrame) -> DataFrame:
        """Search the cells that the rows of ``at`` name: copies of a much visited cell, parts of a large one."""
        visited = at.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).cast("int").alias("copies"))
        dealt = F.broadcast(held.join(visited, "cell"))  # one row per cell, bounded by the sample
        mine = F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int")
        left = points.join(dealt, "cell").withColumn("part", mine).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        right = at.join(dealt, "cell").withColumn("copy", F.pmod(F.xxhash64("query"), F.col("copies")).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        by = ["cell", "part", "copy"]
        return left.drop("parts", "copies").groupBy(*by).cogroup(right.drop("parts", "copies").groupBy(*by)).applyInPandas(
            lambda p, q: search_cell(p, q, k + 1, factor), first_schema)

    home = written(run(asked.select("query", "vec", "proj", "cell", F.lit(math.inf).alias("bound"), F.col("cell").alias("home"))), "own-cell")
    # the (k+1)-th distance in the own cell bounds what other cells must beat
    in_order = F.row_number().over(Window.partitionBy("query").orderBy("squared"))
    worst = home.select("query", "squared", in_order.alias("n")).groupBy("query").agg(
        F.coalesce(F.min(F.when(F.col("n") == k + 1, F.col("squared"))), F.lit(math.inf)).alias("bound"))

    def visits(batches):
        for pdf in batches:
            out = []
            for q in pdf.itertuples(index=False):
                gap = np.maximum(0, np.maximum(low - np.asarray(q.proj), np.asarray(q.proj) - high))
                go = cells[((gap * gap).sum(1) <= factor * q.bound) & (cells != q.home)]
                out += [(q.query, q.vec, q.proj, int(c), q.bound, q.home) for c in go]
            yield pd.DataFrame(out, columns=["query", "vec", "proj", "cell", "bound", "home"])

    away = asked.join(worst, "query", "left").select("query", "vec", "proj", F.coalesce("bound", F.lit(math.inf)).alias("bound"), F.col("cell").alias("home"))
    away = written(away.mapInPandas(visits, "query string, vec array<double>, proj array<double>, cell long, bound double, home long"), "visits")
    found = home.unionByName(run(away)).select("query", F.explode("ids").alias("id"), "squared")
    best = Window.partitionBy("query").orderBy("squared", "id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).select("query", F.col("id").alias("vec_id"), "squared")
    found = found.join(asked.select("query", "vec"), "query")
    # ids of a common vector may be many: each takes the same short list
    lists = found.groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("squared", "vec_id"))).alias("near"))
    asking = written(asking.distinct(), "asking")
    lists = lists.join(asking.groupBy("vec").agg(F.count("*").alias("rows")), "vec")
    own = joined_by_share(asking, written(lists, "lists"), ["vec"], "rows", max(1, asking.count()))
    own = own.select(F.col("id").alias("query_id"), F.filter("near", lambda x: x["vec_id"] != F.col("id")).alias("near"))
    return own.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias(key), F.sqrt("x.squared").alias("score"))
