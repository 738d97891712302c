"""Training rows straight from a resampled table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.arrays import drop_positions
from evenkeel.operators.features import training_rows
from evenkeel.operators.item_arrays import ItemFeatures, item_arrays
from evenkeel.operators.resampling import ResamplingOptions, weight_rows
from evenkeel.operators.scaling import lenient_scaled_columns


def training_feed(
    df: DataFrame, variables: Sequence[str], stats: Mapping[str, Mapping], options: ResamplingOptions,
    excluded: Sequence[str] = (), keys: Sequence[str] = ("row_key",), precision: str = "float64",
    items: Mapping[str, ItemFeatures] | None = None,
) -> DataFrame:
    """Bin weights on the original values, then scaling, one-hot labels, excluded features dropped.

    ``items`` names array columns of items; each becomes its scaled inputs, valid flags and labels.
    """
    weighted = weight_rows(df, options)
    collections = {}
    for name, features in (items or {}).items():
        weighted = item_arrays(weighted, name, features)
        collections[name] = tuple(F.col(f"{name}_{part}") for part in ("inputs", "valid", "labels"))
    scaled = list(lenient_scaled_columns(variables, stats).values())
    training = training_rows(weighted, scaled, len(options.classes), keys, items=collections, weight="weight", precision=precision)
    gone = [list(variables).index(v) for v in excluded]
    return training.withColumn("inputs", drop_positions(F.col("inputs"), gone))
