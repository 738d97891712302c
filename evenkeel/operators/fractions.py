"""Largest row counts that respect target fractions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_fractions(fractions: Mapping[str, float]) -> None:
    """Target fractions must add up to one."""
    if abs(sum(fractions.values()) - 1.0) > 1e-8:
        raise ValueError("the target fractions have to add up to 1")


def with_fraction(counts: DataFrame, name: str, fractions: Mapping[str, float]) -> DataFrame:
    """Attach the target fraction of every value of column ``name``."""
    check_fractions(fractions)
    table = F.create_map(*[F.lit(x) for pair in fractions.items() for x in pair])
    return counts.withColumn("fraction", F.try_element_at(table, F.col(name)))


def correct_fractions(counts: DataFrame, groups: Sequence[str] = (), available: str = "n") -> DataFrame:
    """Add ``target``: the largest whole counts in proportion to ``fraction``.

    The scarcest entry fixes the scale ``min(n / fraction)``. An entry without rows
    is an error.
    """
    n = F.col(available)
    checked = F.when(n > 0, n).otherwise(F.raise_error(F.lit("every count needs to be above zero")))
    scale = counts.groupBy(*groups).agg(F.min(checked / F.col("fraction")).alias("__k"))
    joined = counts.join(scale, list(groups)) if groups else counts.crossJoin(scale)
    return joined.withColumn(
        "target", F.floor(F.col("__k") * F.col("fraction") + F.lit(1e-9)).cast("bigint")
    ).drop("__k")
