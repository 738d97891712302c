"""From selected rows to training rows, batches and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.arrays import one_hot
from evenkeel.functions.keys import shuffled
from evenkeel.functions.numeric import missing_to, to_precision
from evenkeel.operators.ranking import first_n, global_rank
from evenkeel.session import cut_lineage


def training_rows(
    df: DataFrame, features: Sequence[Column], n_classes: int, keys: Sequence[str] = (),
    add_labels: Sequence[str] = (), items: Mapping[str, tuple[Column, Column, Column | None]] | None = None,
    weight: str | None = None, precision: str = "float64",
) -> DataFrame:
    """``inputs, label, label_one_hot, weight`` plus extra labels and item arrays.

    ``items`` maps a collection name to its inputs, valid flags and labels. A missing
    weight column counts as 1; extra labels keep their type, missing values become 0.
    """
    inputs = to_precision(F.array(*[f.cast("double") for f in features]), precision, array=True)
    w = F.col(weight).cast("double") if weight and weight in df.columns else F.lit(1.0)
    columns = [
        *[F.col(k) for k in keys], inputs.alias("inputs"), F.col("label"),
        one_hot(F.col("label"), n_classes).alias("label_one_hot"), w.alias("weight"),
        *[missing_to(F.col(c), 0.0).cast(df.schema[c].dataType).alias(f"label_{c}") for c in add_labels],
    ]
    for name, (values, valid, labels) in (items or {}).items():
        columns += [values.alias(f"{name}_inputs"), valid.alias(f"{name}_valid")]
        if labels is not None:
            columns.append(labels.alias(f"{name}_labels"))
    return df.select(*columns)


def dimensions(training: DataFrame, items: str | None = None) -> DataFrame:
    """One row: rows, features, classes, items per row, features per item."""
    aggs = [
        F.count(F.lit(1)).alias("n_rows"), F.max(F.size("inputs")).alias("n_features"),
        F.max(F.size("label_one_hot")).alias("n_classes"),
    ]
    if items:
        aggs += [
            F.max(F.size(f"{items}_inputs")).alias("n_items"),
            F.max(F.size(F.get(f"{items}_inputs", F.lit(0)))).alias("n_item_features"),
        ]
    return training.agg(*aggs)


def flat_record(training: DataFrame, items: str, keys: Sequence[str]) -> DataFrame:
    """One flat float list per row for the row inputs, the items and the label."""
    return training.select(
        *keys, F.col("inputs").cast("array<float>").alias("row_values"),
        F.flatten(f"{items}_inputs").cast("array<float>").alias("item_values"), "label_one_hot", "weight",
    )


def in_random_order(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """Zero-based place of every row in a global shuffle."""
    hashed = df.withColumn("_hash", shuffled(F.col(key), seed))
    return global_rank(hashed, name, "_hash").withColumn(name, F.col(name) - 1).drop("_hash")


def in_block_order(df: DataFrame, key: str, seed: int, block: int, name: str = "position") -> DataFrame:
    """Zero-based place when whole blocks of consecutive rows are shuffled, then each block.

    Rows are consecutive in key order; keys are unique. The order hash is that of the block, followed by
    that of the row within it. Keys alone are ranked, twice; whole rows are read once, to join their places.
    """
    ranked = global_rank(df.select(key), "__at", key)
    number = F.floor((F.col("__at") - 1) / block)
    hashed = cut_lineage(ranked.select(key, F.concat(shuffled(number.cast("string"), seed), shuffled(F.col(key), seed)).alias("_hash")))
    placed = global_rank(hashed, name, "_hash").select(key, (F.col(name) - 1).alias(name))
    return placed if df.columns == [key] else df.join(placed, key).select(*df.columns, name)


def batches(df: DataFrame, key: str, seed: int, batch_size: int, n_rows: int | None = None) -> DataFrame:
    """Add ``batch`` and ``step``: consecutive batches of a shuffled set, optionally cut to ``n_rows``."""
    chosen = df
    if n_rows is not None:
        hashed = df.withColumn("_hash", shuffled(F.col(key), seed))
        chosen = first_n(hashed, n_rows, "_hash").drop("_hash")
    return (
        in_random_order(chosen, key, seed, "__at")
        .withColumn("batch", F.floor(F.col("__at") / batch_size).cast("bigint"))
        .withColumn("step", (F.col("__at") % batch_size).cast("int")).drop("__at")
    )
