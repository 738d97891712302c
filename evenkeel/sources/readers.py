"""Scans over many files, and comparisons between their schemas."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def natural_key(name: str) -> tuple:
    """Sort key that puts ``part-2`` before ``part-10``."""
    return tuple(int(t) if t.isdigit() else t for t in re.split(r"(\d+)", name))


def scan(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
         required: Sequence[str] = ()) -> DataFrame:
    """Parquet rows of all paths (globs allowed), in natural file order.

    ``required`` columns (labels, cuts) join the requested ones; requested columns the
    files lack are left out with a warning.
    """
    paths = [paths] if isinstance(paths, str) else sorted(paths, key=natural_key)
    df = spark.read.parquet(*paths)
    if columns is None:
        return df
    wanted = list(dict.fromkeys([*columns, *required]))
    lacking = [c for c in wanted if c not in df.columns]
    missing_required = [c for c in lacking if c in required]
    if missing_required:
        raise KeyError(f"required columns are missing: {missing_required}")
    if lacking:
        import warnings

        warnings.warn(f"columns not in the files: {lacking}", stacklevel=2)
    return df.select(*[c for c in wanted if c in df.columns])


def row_range(ranked: DataFrame, lo: int, hi: int, rank: str = "rank_no") -> DataFrame:
    """Rows numbered ``[lo, hi)`` from zero; ``rank`` is a one-based position column."""
    if not 0 <= lo <= hi:
        raise ValueError("the row range has to be ascending and not negative")
    return ranked.filter((F.col(rank) > lo) & (F.col(rank) <= hi))


def label_by_source(sources: Mapping[str, DataFrame], name: str = "label") -> DataFrame:
    """Union of several reads, each with its own literal label, on their common columns."""
    return union_common([df.withColumn(name, F.lit(label)) for label, df in sources.items()])


def common_columns(frames: Sequence[DataFrame]) -> tuple[list[str], list[str]]:
    """Columns all frames share, and the others (each in first-seen order)."""
    seen = list(dict.fromkeys(c for df in frames for c in df.columns))
    common = [c for c in seen if all(c in df.columns for df in frames)]
    return common, [c for c in seen if c not in common]


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    """Union restricted to the columns all frames share."""
    common, _ = common_columns(frames)
    return reduce(lambda a, b: a.unionByName(b), [df.select(*common) for df in frames])


def compare_columns(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(column, n_present, common, n_values)``: schema comparison with filled-row counts."""
    parts = []
    for df in frames.values():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in df.columns
        ]))))
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("column").agg(
        F.count(F.lit(1)).cast("int").alias("n_present"),
        (F.count(F.lit(1)) == len(frames)).alias("common"),
        F.sum("n").cast("bigint").alias("n_values"),
    )


def strict_union(sources: Mapping[str, DataFrame], arrays: Sequence[str] = (), name: str = "source") -> DataFrame:
    """Append sources that must agree in column names, types and array widths."""
    frames = list(sources.values())
    first = {f.name: f.dataType for f in frames[0].schema}
    for label, df in sources.items():
        if {f.name: f.dataType for f in df.schema} != first:
            raise ValueError(f"columns of {label} differ from the first source")
    merged = reduce(
        lambda a, b: a.unionByName(b), [df.withColumn(name, F.lit(label)) for label, df in sources.items()]
    )
    if not arrays:
        return merged
    # one scan for all widths; an array of unequal ones is an error before anything is appended
    widths = merged.agg(*[F.min(F.size(a)).alias(f"lo_{a}") for a in arrays], *[F.max(F.size(a)).alias(f"hi_{a}") for a in arrays]).first()
    for a in arrays:
        if widths[f"lo_{a}"] != widths[f"hi_{a}"]:
            raise ValueError(f"array {a} has different widths")
    return merged


def source_ranges(merged: DataFrame, order: Sequence[str], name: str = "source", totals: Mapping[str, Column] | None = None) -> DataFrame:
    """``(source, first_row, last_row)`` each source occupies in the appended table, and ``totals`` of its rows."""
    counts = merged.groupBy(name).agg(F.count(F.lit(1)).alias("n"), *[c.alias(t) for t, c in (totals or {}).items()])
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(name))
    last = F.sum("n").over(W.orderBy(place).rowsBetween(W.unboundedPreceding, W.currentRow))  # one row per source
    return counts.select(name, (last - F.col("n")).cast("bigint").alias("first_row"), last.cast("bigint").alias("last_row"), *(totals or {}))


def read_json(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table that ``write_json`` wrote, with the columns and types of ``like``."""
    return spark.read.schema(like.schema).json(path)
