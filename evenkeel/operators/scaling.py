"""Scaling statistics: computing, merging, checking, applying and exporting them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.numeric import finite_or, is_finite, missing_to

# Fixed value: added to an item value before its logarithm when statistics are taken.
LOG_OFFSET = 1e-8


def is_flag(name: str) -> bool:
    """Default-value flags are neither filled nor scaled."""
    return "isDefaults" in name


def is_unscaled(name: str) -> bool:
    return is_flag(name) or "weight" in name


def finite_statistics(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``(variable, shift, scale, n, n_rows)`` of the finite values, in a single scan."""
    values = [finite_or(F.col(v), None) for v in variables]
    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[a for i, x in enumerate(values) for a in (
            F.count(x).alias(f"__c{i}"), F.avg(x).alias(f"__m{i}"), F.stddev_pop(x).alias(f"__s{i}"))],
    )
    entries = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(f"__m{i}").alias("shift"), F.col(f"__s{i}").alias("scale"),
                 F.col(f"__c{i}").alias("n"))
        for i, v in enumerate(variables)
    ])
    return row.select("n_rows", F.inline(entries)).select("variable", "shift", "scale", "n", "n_rows")


def fill_statistics(finite: DataFrame, defaults: Mapping[str, float] | None = None) -> DataFrame:
    """``(variable, shift, scale, default, n)`` after non-finite values take the default.

    The default is the given one or the mean of the finite values. Mean and deviation
    of the filled column follow exactly from those of its finite part.
    """
    given = F.lit(None).cast("double")
    for v, d in (defaults or {}).items():
        given = F.when(F.col("variable") == v, F.lit(float(d))).otherwise(given)
    n, c = F.col("n_rows").cast("double"), F.col("n").cast("double")
    default = F.coalesce(given, F.col("shift"))
    # a column without any finite value is all default
    mean, scale = F.coalesce(F.col("shift"), default), F.coalesce(F.col("scale"), F.lit(0.0))
    shift = mean + F.try_divide((n - c) * (default - mean), n)
    spread = c * (F.pow(scale, 2.0) + F.pow(mean - shift, 2.0)) + (n - c) * F.pow(default - shift, 2.0)
    return finite.select(
        "variable", shift.alias("shift"), F.sqrt(F.try_divide(spread, n)).alias("scale"), default.alias("default"),
        F.col("n_rows").alias("n"),
    )


def row_statistics(df: DataFrame, variables: Sequence[str], defaults: Mapping[str, float] | None = None) -> DataFrame:
    """Scaling statistics of row variables.

    NaN and infinity take the default; shift and scale are mean and population
    deviation. Flags get (0, 1, no default); labels and weights are left out.
    """
    used = [v for v in variables if "weight" not in v and "label" not in v]
    measured = [v for v in used if not is_flag(v)]
    flags = [v for v in used if is_flag(v)]
    out = fill_statistics(finite_statistics(df, measured), defaults)
    if flags:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        names = F.explode(F.array(*[F.lit(v) for v in flags]))
        out = out.unionByName(counted.select(
            names.alias("variable"), F.lit(0.0).alias("shift"), F.lit(1.0).alias("scale"),
            F.lit(None).cast("double").alias("default"), "n",
        ))
    return out


def item_statistics(df: DataFrame, items: str, variables: Sequence[str], log_variables: Sequence[str] = (),
                    flag: str = "valid") -> DataFrame:
    """``(variable, shift, scale, n)`` over valid items; log variables use ln(x + 1e-8)."""
    fields = df.select(F.explode(F.filter(F.col(items), lambda x: x[flag])).alias("i"))
    value = {
        v: F.ln(F.col(f"i.{v}").cast("double") + F.lit(LOG_OFFSET)) if v in log_variables else F.col(f"i.{v}").cast("double")
        for v in variables
    }
    row = fields.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.avg(c).alias(f"__m_{v}") for v, c in value.items()],
        *[F.stddev_pop(c).alias(f"__s_{v}") for v, c in value.items()],
    )
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(v).alias("variable"), F.col(f"__m_{v}").alias("shift"), F.col(f"__s_{v}").alias("scale"),
            F.col("__n").alias("n"),
        )
        for v in variables
    ])))


def merge_statistics(parts: DataFrame, keys: Sequence[str] = ("variable",), totals: Sequence[str] = ()) -> DataFrame:
    """One statistic per variable from any number of partial ones (n, shift, scale).

    Further count columns named in ``totals`` are added up.
    """
    keys, totals = list(keys), list(totals)
    n = F.col("n").cast("double")
    means = parts.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("__total"), F.try_divide(F.sum(n * F.col("shift")), F.sum(n)).alias("__mean"),
    )
    spread = n * (F.pow(F.col("scale"), 2.0) + F.pow(F.col("shift") - F.col("__mean"), 2.0))
    return (
        parts.join(means, keys).groupBy(*keys, "__mean", "__total")
        .agg(F.sum(spread).alias("__spread"), *[F.sum(t).cast("bigint").alias(t) for t in totals])
        .select(
            *keys, F.col("__mean").alias("shift"), F.sqrt(F.try_divide(F.col("__spread"), F.col("__total"))).alias("scale"),
            F.col("__total").alias("n"), *totals,
        )
    )


def label_weights(df: DataFrame, label: Column, ignore=-1) -> DataFrame:
    """``(value, n, weight)``: total / count for every label value but the ignored one."""
    counts = (
        df.select(label.alias("value")).filter(F.col("value") != ignore)
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n").alias("__t"))
    return counts.crossJoin(F.broadcast(total)).select(
        "value", "n", (F.col("__t") / F.col("n")).alias("weight")
    )


def check_statistics(stats: DataFrame) -> DataFrame:
    """The same rows; an unusable shift or scale is an error when they are read."""
    bad = ~is_finite(F.col("shift")) | ~is_finite(F.col("scale")) | (F.col("scale") == 0)
    message = F.concat(F.lit("unusable scaling statistics for "), F.col("variable"))
    return stats.withColumn("scale", F.when(bad, F.raise_error(message).cast("double")).otherwise(F.col("scale")))


def collect_statistics(stats: DataFrame) -> dict[str, dict]:
    """The statistics as a dictionary: one entry per variable, never per data row."""
    return {
        r["variable"]: {"shift": r["shift"], "scale": r["scale"], "default": r["default"] if "default" in r else None}
        for r in stats.collect()
    }


def _usable(name: str, stat: Mapping) -> tuple[float, float]:
    shift, scale = float(stat["shift"]), float(stat["scale"])
    if scale == 0 or scale in (float("inf"), float("-inf")) or scale != scale:
        raise ValueError(f"scale of {name} is {scale}")
    return shift, scale


def _finite_result(x: Column, name: str) -> Column:
    return F.when(is_finite(x), x).otherwise(F.raise_error(F.lit(f"value of {name} is not finite after scaling")).cast("double"))


def scaled_columns(variables: Sequence[str], stats: Mapping[str, Mapping]) -> dict[str, Column]:
    """Scaled expression of every variable; flags and weights pass through.

    Non-finite values take the default first. A variable without statistics is an
    error, as is a result that is not finite.
    """
    out = {}
    for v in variables:
        if is_unscaled(v):
            out[v] = F.col(v)
            continue
        if v not in stats:
            raise KeyError(f"no scaling statistics for {v}")
        shift, scale = _usable(v, stats[v])
        value = (finite_or(F.col(v), stats[v].get("default")) - F.lit(shift)) / F.lit(scale)
        out[v] = _finite_result(value, v)
    return out


def apply_row_scaling(df: DataFrame, variables: Sequence[str], stats: Mapping[str, Mapping], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and the scaled variables, nothing else."""
    return df.select(*keep, *[c.alias(v) for v, c in scaled_columns(variables, stats).items()])


def lenient_scaled_columns(variables: Sequence[str], stats: Mapping[str, Mapping]) -> dict[str, Column]:
    """On-the-fly scaling: statistics may be named mean/std, unknown variables use (0, 1, 0)."""
    out = {}
    for v in variables:
        s = stats.get(v, {})
        shift, scale = s.get("shift", s.get("mean", 0.0)), s.get("scale", s.get("std", 1.0))
        out[v] = (finite_or(F.col(v), s.get("default") or 0.0) - F.lit(float(shift))) / F.lit(float(scale))
    return out


def unscaled(x: Column, stat: Mapping) -> Column:
    """Back from the scaled to the original value."""
    return x * F.lit(float(stat["scale"])) + F.lit(float(stat["shift"]))


def scaled_items(items: Column, no_norm: Sequence[str], log: Sequence[str], joint: Sequence[str],
                 stats: Mapping[str, Mapping], flag: str = "valid", strict: bool = True) -> Column:
    """Feature arrays of the items, fields in the order no_norm, log, joint.

    Log fields must be positive (``strict``); only valid items are scaled; missing
    values of padding become 0.
    """
    def feature(x, name):
        value = x[name].cast("double")
        if name in log:
            floor = F.raise_error(F.lit(f"{name} is used in log and must be positive")).cast("double") if strict else F.lit(None).cast("double")
            value = F.when(value <= 0, floor).otherwise(F.ln(value))
        if name not in no_norm:
            shift, scale = _usable(name, stats[name]) if strict else (
                float(stats.get(name, {}).get("shift", 0.0)), float(stats.get(name, {}).get("scale", 1.0)))
            value = F.when(x[flag], (value - F.lit(shift)) / F.lit(scale)).otherwise(value)
        value = F.when(~x[flag], missing_to(value)).otherwise(value)
        return _finite_result(value, name) if strict else finite_or(value, 0.0)

    return F.transform(items, lambda x: F.array(*[feature(x, n) for n in [*no_norm, *log, *joint]]))


def item_labels(items: Column, names: Sequence[str]) -> Column:
    """Unscaled item labels as arrays; missing values become 0."""
    return F.transform(items, lambda x: F.array(*[missing_to(x[n].cast("double")).cast("int") for n in names]))


def export_statistics(stats: DataFrame, renames: Mapping[str, str] | None = None, log: Sequence[str] = (),
                      no_norm: Sequence[str] = ()) -> DataFrame:
    """``(name, offset, scale, default)`` for use outside: offset = -shift, scale = 1/scale."""
    name = F.col("variable")
    for old, new in (renames or {}).items():
        name = F.when(F.col("variable") == old, F.lit(new)).otherwise(name)
    if log:
        name = F.when(F.col("variable").isin(list(log)), F.concat(F.lit("log_"), name)).otherwise(name)
    plain = F.col("variable").isin(list(no_norm)) if no_norm else F.lit(False)
    return stats.select(
        name.alias("name"),
        F.when(plain, 0.0).otherwise(-F.col("shift")).alias("offset"),
        F.when(plain, 1.0).otherwise(1.0 / F.col("scale")).alias("scale"),
        F.coalesce(F.col("default"), F.lit(0.0)).alias("default") if "default" in stats.columns else F.lit(0.0).alias("default"),
    )
