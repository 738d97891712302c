"""Bin edges and N-dimensional bin numbers.

Bins are half open, the last bin includes its upper edge; values outside the edges
(and missing values) have no bin: their number is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.arrays import count_below
from evenkeel.functions.numeric import INF

Edges = Sequence[float]


def linspace_edges(spec: Sequence) -> list[float]:
    """Edges from ``[lo, hi, n]``, or the joined edges of a list of such triples."""
    triples = spec if isinstance(spec[0], (list, tuple)) else [spec]
    return [float(e) for lo, hi, n in triples for e in np.linspace(lo, hi, int(n))]


def step_edges(spec, name: str, lo: float | None = None, hi: float | None = None) -> list[float]:
    """Edges from ``[lo, hi, width]`` (upper end left out), a bin count or None (100 bins).

    Counting variables, whose names start with ``number``, are shifted by half a
    unit. Bin counts need the data range ``lo`` .. ``hi``.
    """
    if isinstance(spec, (list, tuple)):
        edges = np.arange(*spec)
        return [float(e) - (0.5 if name.startswith("number") else 0.0) for e in edges]
    n = 100 if spec is None else int(spec)
    if lo is None or hi is None:
        raise ValueError("a bin count needs the data range")
    return [float(e) for e in np.linspace(lo, hi, n + 1)]


def _is_uniform(edges: Edges) -> bool:
    gaps = np.diff(edges)
    return len(edges) > 2 and bool(np.all(gaps > 0)) and np.ptp(gaps) < 0.25 * gaps.min()


def bin_number(x: Column, edges: Edges) -> Column:
    """Zero-based bin of ``x``; NULL outside the edges."""
    edges = [float(e) for e in edges]
    if len(edges) < 2 or any(b < a for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be at least two ascending numbers")
    lo, hi, last = edges[0], edges[-1], len(edges) - 2
    # the last bin takes everything up to the upper end, which the range check sets
    starts = F.array(*[F.lit(e) for e in edges[:-1]], F.lit(INF))
    x = x.cast("double")
    if _is_uniform(edges):
        # Guess by division, then settle against the exact edges.
        guess = F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(last + 1)).cast("int"), F.lit(last + 1)) - 1
        number = guess + (x >= F.get(starts, guess + 1)).cast("int") - (x < F.get(starts, guess)).cast("int")
    else:
        number = count_below(starts, x, len(edges), inclusive=True) - 1
    return F.when((x >= lo) & (x <= hi), number)


def flat_bin(axes: Mapping[str, Edges]) -> Column:
    """Row-major number over several axes (column name to edges)."""
    flat = F.lit(0)
    for name, edges in axes.items():
        flat = flat * (len(edges) - 1) + bin_number(F.col(name), edges)
    return flat.cast("int")


def n_bins(axes: Mapping[str, Edges]) -> int:
    return prod(len(e) - 1 for e in axes.values())


def with_bins(df: DataFrame, axes: Mapping[str, Edges], name: str = "bin") -> DataFrame:
    """Add the flat bin number; rows outside the grid are dropped."""
    return df.withColumn(name, F.coalesce(flat_bin(axes), F.lit(-1))).filter(F.col(name) >= 0)


def edge_table(spark: SparkSession, edges: Edges) -> DataFrame:
    """One row per bin: ``bin, lo, hi``. Grows with the binning, not with the data."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi"))
        for i, (a, b) in enumerate(zip(edges, list(edges)[1:]))
    ])
    return spark.range(1).select(F.inline(pairs))


def full_grid(spark: SparkSession, keys: Mapping[str, Sequence], bins: int) -> DataFrame:
    """Every combination of the listed key values with every bin number."""
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    for name, values in keys.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.select(*keys, "bin")
