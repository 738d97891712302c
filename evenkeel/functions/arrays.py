"""Array columns: searching, encoding, padding and pooling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_below(edges: Column, x: Column, max_size: int, inclusive: bool = False) -> Column:
    """How many entries of a sorted array are below ``x`` (``<=`` if inclusive).

    ``max_size`` is an upper bound of the array length that the caller knows. Short
    arrays are compared entry by entry, longer ones by a halving search of about
    log2(max_size) steps per row.
    """
    if max_size <= 6:
        entries = [F.get(edges, F.lit(i)) for i in range(max_size)]
        hits = [F.when(e <= x if inclusive else e < x, 1).otherwise(0) for e in entries]
        return reduce(lambda a, b: a + b, hits)
    steps = [2**k for k in range(max(max_size, 1).bit_length() - 1, -1, -1)]

    def step(pos: Column, s: Column) -> Column:
        probe = F.get(edges, pos + s - 1)
        hit = probe <= x if inclusive else probe < x
        return F.when((pos + s <= F.size(edges)) & hit, pos + s).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def above(x: Column, cut: Column) -> Column:
    """``x > cut``, false where either is NaN (which Spark orders above every number)."""
    return ~F.isnan(x) & ~F.isnan(cut) & (x > cut)


def argmax(values: Column) -> Column:
    """Zero-based position of the first largest entry."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def one_hot(label: Column, n_classes: int) -> Column:
    """0/1 array of length ``n_classes``; a label outside the range is an error."""
    checked = F.when((label >= 0) & (label < n_classes), label).otherwise(
        F.raise_error(F.concat(F.lit("label without a class: "), label.cast("string")))
    )
    return F.array(*[(checked == i).cast("int") for i in range(n_classes)])


def drop_positions(values: Column, positions: Sequence[int]) -> Column:
    """The array without the zero-based ``positions``."""
    gone = F.array(*[F.lit(int(p)) for p in positions])
    return F.filter(values, lambda _, i: ~F.array_contains(gone, i)) if positions else values


def first_k(values: Column, k: int) -> Column:
    """The first ``k`` entries."""
    return F.slice(values, 1, k)


def pad_items(items: Column, width: int, filler: Column) -> Column:
    """Cut or fill an array of structs to exactly ``width`` entries."""
    return F.slice(F.concat(items, F.array_repeat(filler, width)), 1, width)


def valid_items(items: Column, flag: str | None = "valid", probe: str | None = None) -> Column:
    """Items that are real: by their flag, else by a probe field that is not missing."""
    if flag:
        return F.filter(items, lambda x: x[flag])
    return F.filter(items, lambda x: ~(x[probe].isNull() | F.isnan(x[probe])))


def sum_pool(vectors: Column, width: int) -> Column:
    """Position-wise sum over an array of equally long arrays."""
    zeros = F.array_repeat(F.lit(0.0), width)
    return F.aggregate(vectors, zeros, lambda acc, v: F.zip_with(acc, v, lambda a, x: a + x.cast("double")))


def mean_pool(vectors: Column, width: int) -> Column:
    """Position-wise mean; zeros for an empty set."""
    n = F.size(vectors)
    return F.transform(sum_pool(vectors, width), lambda s: F.when(n > 0, s / n).otherwise(F.lit(0.0)))


def attention_pool(vectors: Column, scores: Column, width: int) -> Column:
    """Sum of the vectors weighted by the soft-max of ``scores``; zeros for an empty set."""
    top = F.array_max(scores)
    exps = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(exps, F.lit(0.0), lambda a, e: a + e)
    weighted = F.zip_with(vectors, exps, lambda v, e: F.transform(v, lambda f: f.cast("double") * e / total))
    return sum_pool(weighted, width)
