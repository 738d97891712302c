"""Item features as number arrays, computed a batch at a time.

One Arrow pass takes all items of a batch apart into one number column per field, scales the
columns, and puts the result together again; whether an item is real travels as a flag beside it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.scaling import _usable


@dataclass(frozen=True)
class ItemFeatures:
    """What becomes of a collection of items.

    Features come in the order ``no_norm``, ``log``, ``joint``; log features are scaled after the logarithm, which
    ``strict`` demands to exist. Lenient scaling reads statistics named shift/scale or
    mean/std, takes (0, 1) for unknown features and 0 for values that are not finite.
    """

    no_norm: Sequence[str] = ()
    log: Sequence[str] = ()
    joint: Sequence[str] = ()
    stats: Mapping[str, Mapping] = field(default_factory=dict)
    labels: Sequence[str] = ()
    flag: str = "valid"
    strict: bool = True

    @property
    def names(self) -> list[str]:
        return [*self.no_norm, *self.log, *self.joint]

    def shift_and_scale(self, name: str) -> tuple[float, float]:
        if name in self.no_norm:
            return 0.0, 1.0
        if self.strict:
            if name not in self.stats:
                raise KeyError(f"no scaling statistics for {name}")
            return _usable(name, self.stats[name])
        s = self.stats.get(name, {})
        return float(s.get("shift", s.get("mean", 0.0))), float(s.get("scale", s.get("std", 1.0)))


def scaled_fields(values: Mapping[str, np.ndarray], valid: np.ndarray, features: ItemFeatures) -> np.ndarray:
    """(items, features): scaled where valid; missing values of other items are 0."""
    out = np.empty((len(valid), len(features.names)))
    for at, name in enumerate(features.names):
        x = values[name].astype(float)
        if name in features.log:
            if features.strict and (x <= 0).any():
                raise ValueError(f"{name} is used in log and must be positive")
            with np.errstate(divide="ignore", invalid="ignore"):
                x = np.where(x <= 0, np.nan, np.log(x))
        shift, scale = features.shift_and_scale(name)
        x = np.where(valid, (x - shift) / scale, x)
        x = np.where(~valid & np.isnan(x), 0.0, x)
        if features.strict and not np.isfinite(x).all():
            raise ValueError(f"value of {name} is not finite after scaling")
        out[:, at] = np.where(np.isfinite(x), x, 0.0)
    return out


def _numbers(column: pa.Array) -> np.ndarray:
    """A field as doubles, missing values as NaN."""
    return pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)


def _nested(matrix: np.ndarray, ends: pa.Array, kind: pa.DataType, present: pa.Array) -> pa.Array:
    """Rows of lists of equally long lists."""
    inner = pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel(), kind))
    return pa.ListArray.from_arrays(ends, inner, mask=pc.invert(present))


def item_arrays(
    df: DataFrame, items: str, features: ItemFeatures, name: str | None = None, row_features: Sequence[Column] = (), keep: Sequence[str] | None = None,
) -> DataFrame:
    """``keep`` columns (all others by default) and ``<name>_inputs``, ``<name>_valid``, ``<name>_labels``.

    ``row_features`` are repeated in front of the inputs of every valid item, zeros of every other. Labels
    are whole numbers, 0 where missing. Rows without an array keep none; an unset flag counts as not valid.
    """
    name = name or items
    kept = [c for c in df.columns if c != items] if keep is None else list(keep)
    outputs = [f"{name}_inputs", f"{name}_valid", f"{name}_labels"]
    schema = T.StructType([df.schema[c] for c in kept]).add(outputs[0], T.ArrayType(T.ArrayType(T.DoubleType()))).add(
        outputs[1], T.ArrayType(T.BooleanType())).add(outputs[2], T.ArrayType(T.ArrayType(T.IntegerType())))
    for feature in features.names:
        features.shift_and_scale(feature)  # unusable statistics are found here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            flat = lists.flatten()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            present = lists.is_valid()
            get = lambda f: flat.field(flat.type.get_field_index(f))
            valid = pc.fill_null(get(features.flag), False).to_numpy(zero_copy_only=False).astype(bool)
            inputs = scaled_fields({n: _numbers(get(n)) for n in set(features.names)}, valid, features)
            head = np.stack([_numbers(batch.column(len(kept) + 1 + i)) for i in range(n_heads)], axis=1) if n_heads else np.zeros((len(sizes), 0))
            inputs = np.hstack([np.where(valid[:, None], np.repeat(head, sizes, axis=0), 0.0), inputs])
            if n_heads:
                inputs[~valid] = 0.0
            labels = np.stack([np.nan_to_num(_numbers(get(n))) for n in features.labels], axis=1) if features.labels else np.zeros((len(valid), 0))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(kept)], _nested(inputs, ends, pa.float64(), present),
                pa.ListArray.from_arrays(ends, pa.array(valid), mask=pc.invert(present)), _nested(labels.astype(np.int32), ends, pa.int32(), present),
            ], [*kept, *outputs])

    n_heads = len(row_features)
    heads = [c.cast("double").alias(f"__row_{i}") for i, c in enumerate(row_features)]
    return df.select(*kept, items, *heads).mapInArrow(run, schema)


def pooled_items(df: DataFrame, vectors: Column, width: int, scores: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and ``sum_pool``, ``mean_pool``, ``attention_pool`` of each row's vectors, all of ``width`` numbers.

    Attention weighs the vectors by the soft-max of their ``scores``. Zeros for a row without vectors. All rows of a batch are
    added up at once.
    """
    outputs = ["sum_pool", "mean_pool", "attention_pool"]
    schema = T.StructType([df.schema[c] for c in keep])
    for name in outputs:
        schema = schema.add(name, T.ArrayType(T.DoubleType()))

    def listed(matrix: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, given = batch.column(n_keep), batch.column(n_keep + 1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten().flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
            score = given.flatten().to_numpy(zero_copy_only=False) if has_scores else np.zeros(len(values))
            filled = np.flatnonzero(size)
            starts = (np.cumsum(size) - size)[filled]
            total, attended = np.zeros((len(size), width)), np.zeros((len(size), width))
            if len(filled):
                owner = np.repeat(np.arange(len(filled)), size[filled])
                weight = np.exp(score - np.maximum.reduceat(score, starts)[owner])
                weight /= np.add.reduceat(weight, starts)[owner]
                total[filled] = np.add.reduceat(values, starts)
                attended[filled] = np.add.reduceat(values * weight[:, None], starts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_keep], listed(total), listed(total / np.maximum(size, 1)[:, None]), listed(attended)], [*keep, *outputs])

    n_keep, has_scores = len(keep), scores is not None
    given = scores.cast("array<double>") if has_scores else F.lit(None).cast("array<double>")
    return df.select(*keep, vectors.alias("__vectors"), given.alias("__scores")).mapInArrow(run, schema)
