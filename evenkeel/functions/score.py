"""The log-ratio discriminant of a multi-class classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: keeps numerator and denominator away from zero.
EPSILON = 1e-10


def _total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def discriminant(
    probs: Mapping[str, Column],
    main_classes: Sequence[str],
    fractions: Mapping[str, Column | float],
    as_float: bool = False,
) -> Column:
    """``ln((sum of main probabilities + e) / (weighted background sum + e))``.

    ``probs`` maps class to probability column in class order; every background
    class needs a fraction.
    """
    background = [c for c in probs if c not in main_classes]
    lacking = [c for c in background if c not in fractions]
    if lacking or not main_classes:
        raise KeyError(f"no fraction for background classes {lacking}")
    num = _total([probs[c] for c in main_classes]) + F.lit(EPSILON)
    weighted = [
        (fractions[c] if isinstance(fractions[c], Column) else F.lit(float(fractions[c]))) * probs[c]
        for c in background
    ]
    den = _total(weighted) + F.lit(EPSILON)
    value = F.ln(num / den)
    return value.cast("float") if as_float else value


def probability_columns(df_columns: Sequence[str], classifier: str, suffixes: Mapping[str, str]) -> dict[str, Column]:
    """Class to probability column of one classifier; absent outputs count as zero."""
    return {
        cls: F.col(f"{classifier}_{suffix}") if f"{classifier}_{suffix}" in df_columns else F.lit(0.0)
        for cls, suffix in suffixes.items()
    }
