"""Rows with a nested, bounded array of items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def nest_items(flat: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], width: int | None = None,
               truncate: bool = False) -> DataFrame:
    """``(key, items)``: the items of each key as an array of structs in the order of ``order``.

    Without a ``width`` arrays hold what a key has. A ``width`` is for data whose keys may have more items than a
    row can hold: a key with more is an error, unless ``truncate`` asks for its first ``width``. The
    rank filter runs before the shuffle as well, so a key with very many items sends no more than one above
    ``width`` of them from each input partition.
    """
    if width is None:
        # sort_array compares in compiled code, array_sort calls its comparator for every pair
        sorted_ = F.sort_array(F.collect_list(F.struct(
            F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)]).alias("__o"), F.struct(*fields).alias("__f"))))
        return flat.groupBy(key).agg(sorted_.alias("__s")).select(key, F.col("__s.__f").alias("items"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    first = flat.withColumn("__rn", rank).filter(F.col("__rn") <= (width if truncate else width + 1))
    entry = F.struct("__rn", *fields)
    nested = first.groupBy(key).agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda x: F.struct(*[x[f].alias(f) for f in fields]),
        ).alias("items")
    )
    if truncate:
        return nested
    return nested.withColumn("items", F.when(F.size("items") <= width, F.col("items")).otherwise(F.raise_error(
        F.concat(F.lit(f"more than {width} items at key "), F.col(key).cast("string")))))


def row_onto_items(row_features: Sequence[Column], items: Column, features: str = "inputs", flag: str = "valid") -> Column:
    """Item inputs with the row's features in front; padding becomes zeros."""
    head = F.array(*[c.cast("double") for c in row_features])

    def join(x):
        joined = F.concat(head, x[features])
        return F.when(x[flag], joined).otherwise(F.transform(joined, lambda _: F.lit(0.0)))

    return F.transform(items, join)


def non_zero_items(features: Column) -> Column:
    """Number of items whose features do not add up to zero."""
    return F.size(F.filter(
        features, lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double")) != 0
    ))
