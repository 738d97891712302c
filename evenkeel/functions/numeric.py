"""Arithmetic with explicit rules for zero denominators, NaN and infinity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAN = float("nan")
INF = float("inf")


def safe_divide(num: Column, den: Column, default: float | None = 1.0) -> Column:
    """``num / den``, or ``default`` where the denominator is zero."""
    return F.when(den != 0, num.cast("double") / den).otherwise(F.lit(default).cast("double"))


def is_missing(x: Column) -> Column:
    """True for NULL and NaN."""
    return x.isNull() | F.isnan(x)


def is_finite(x: Column) -> Column:
    """True for numbers that are neither NULL, NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(INF))


def finite_or(x: Column, default: Column | float | None) -> Column:
    """``x`` where finite, else ``default`` (NULL when that is None)."""
    other = default if isinstance(default, Column) else F.lit(default).cast("double")
    return F.when(is_finite(x), x.cast("double")).otherwise(other)


def missing_to(x: Column, value: float = 0.0) -> Column:
    """NULL and NaN become ``value``; other values keep their type."""
    return F.when(is_missing(x), F.lit(value)).otherwise(x)


_FOLDS = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": lambda a, b: safe_divide(a, b, 0.0),
}


def derived(names: Sequence[str], op: str) -> tuple[Column, Column]:
    """A variable computed from other columns, with the filter that goes with it.

    ``op`` is ``+ - * /`` (fold from the first column on) or ``log`` (one column).
    Missing inputs count as zero; rows whose inputs are all missing are to be
    dropped with the second returned column. The logarithm of a value that is not
    positive is NULL.
    """
    present = ~reduce(lambda a, b: a & b, [is_missing(F.col(n)) for n in names])
    values = [missing_to(F.col(n)) for n in names]
    if op == "log":
        if len(names) != 1:
            raise ValueError("log takes exactly one column")
        return F.when(values[0] > 0, F.ln(values[0])), present
    if op not in _FOLDS:
        raise KeyError(f"unknown operation {op!r}; use one of + - * / log")
    return reduce(_FOLDS[op], values), present


@F.pandas_udf(T.FloatType())
def half_precision(x: pd.Series) -> pd.Series:
    """Round to the nearest half-precision value, kept in a float column."""
    return pd.Series(x.to_numpy(dtype="float64").astype(np.float16).astype("float32"))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def half_precision_array(x: pa.Array) -> pa.Array:
    """Element-wise ``half_precision`` for feature arrays: all values of a batch at once."""
    values = x.flatten()
    half = values.to_numpy(zero_copy_only=False).astype("float64").astype(np.float16).astype("float32")
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False))])
    flat = pa.array(half, pa.float32(), mask=values.is_null().to_numpy(zero_copy_only=False))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat, mask=x.is_null())


def to_precision(x: Column, precision: str, array: bool = False) -> Column:
    """Narrow to ``float64``, ``float32`` or ``float16`` values."""
    if precision == "float16":
        return (half_precision_array if array else half_precision)(x)
    kind = {"float32": "float", "float64": "double"}[precision]
    return x.cast(f"array<{kind}>" if array else kind)
