"""Histograms with uncertainties, their ratios, and descriptive tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.numeric import INF, is_missing, missing_to, safe_divide
from evenkeel.operators.binning import Edges, bin_number, full_grid
from evenkeel.session import small


def histogram(df: DataFrame, value: Column, edges: Edges, keys: Mapping[str, Sequence] | None = None,
              normed: bool = True) -> DataFrame:
    """``(*keys, bin, count, hist, unc, band)`` including empty bins.

    ``unc`` is the square root of the count. Normalisation divides by *all* entries
    of the key, also those outside the edges; ``band`` is ``hist - unc``. ``keys``
    maps key columns to the values expected in them.
    """
    keys = dict(keys or {})
    names, bins = list(keys), len(edges) - 1
    groups = 1
    for values in keys.values():
        groups *= len(values)
    cells = df.select(*names, bin_number(value, edges).alias("bin")).groupBy(*names, "bin").agg(
        F.count(F.lit(1)).alias("__c")
    )
    return finish_histogram(cells, keys, bins, groups, normed)


def finish_histogram(cells: DataFrame, keys: Mapping[str, Sequence], bins: int, groups: int,
                     normed: bool = True) -> DataFrame:
    """Grid, uncertainty and normalisation for counted cells ``(*keys, bin, __c)``."""
    names = list(keys)
    total = cells.groupBy(*names).agg(F.sum("__c").alias("__n"))
    grid = full_grid(cells.sparkSession, keys, bins)
    out = grid.join(small(cells, groups * (bins + 1)), [*names, "bin"], "left")
    out = out.join(small(total, groups), names, "left") if names else out.crossJoin(total)
    count = F.coalesce(F.col("__c"), F.lit(0)).cast("bigint")
    n = F.coalesce(F.col("__n"), F.lit(0)) if normed else F.lit(1)
    hist = safe_divide(count, n, 0.0)
    unc = safe_divide(F.sqrt(count.cast("double")), n, 0.0)
    return out.select(
        *names, "bin", count.alias("count"), hist.alias("hist"), unc.alias("unc"), (hist - unc).alias("band")
    )


def histogram_ratio(num: DataFrame, den: DataFrame, on: Sequence[str], step: bool = True) -> DataFrame:
    """``(*on, ratio, ratio_unc)`` of two histograms joined on ``on`` (last entry: the bin).

    A zero denominator gives 1 (relative uncertainty 0); without ``step`` both become
    infinite. With ``step`` the first bin is repeated as bin -1 for step lines.
    """
    d = den.select(*on, F.col("hist").alias("__d"), F.col("unc").alias("__du"))
    joined = num.select(*on, F.col("hist").alias("__n"), F.col("unc").alias("__nu")).join(d, list(on))
    ratio = safe_divide(F.col("__n"), F.col("__d"), 1.0 if step else INF)
    rest = 0.0 if step else INF
    rel = F.sqrt(
        F.pow(safe_divide(F.col("__nu"), F.col("__n"), rest), 2.0)
        + F.pow(safe_divide(F.col("__du"), F.col("__d"), rest), 2.0)
    )
    out = joined.select(*on, ratio.alias("ratio"), (ratio * rel).alias("ratio_unc"))
    if not step:
        return out
    which = on[-1]
    twice = F.explode(F.when(F.col(which) == 0, F.array(F.lit(-1), F.lit(0))).otherwise(F.array(F.col(which))))
    return out.select(*[twice.alias(c) if c == which else F.col(c) for c in on], "ratio", "ratio_unc")


def variable_histograms(df: DataFrame, keys: Mapping[str, Sequence], variables: Mapping[str, tuple[Column, Edges]],
                        normed: bool = True) -> DataFrame:
    """Histograms of many variables, each with its own edges, in one scan.

    Missing values count as zero.
    """
    numbered = {n: bin_number(missing_to(c.cast("double")), e) for n, (c, e) in variables.items()}
    entries = F.array(*[F.struct(F.lit(n).alias("variable"), b.alias("bin")) for n, b in numbered.items()])
    cells = df.select(*keys, F.inline(entries)).groupBy(*keys, "variable", "bin").agg(
        F.count(F.lit(1)).alias("__c")
    )
    all_keys = {**keys, "variable": list(variables)}
    groups = len(variables)
    for v in keys.values():
        groups *= len(v)
    most = max(len(e) for _, e in variables.values()) - 1
    widths = F.create_map(*[x for n, (_, e) in variables.items() for x in (F.lit(n), F.lit(len(e) - 1))])
    full = finish_histogram(cells, all_keys, most, groups, normed)
    return full.filter(F.col("bin") < F.element_at(widths, F.col("variable")))


def copies_histogram(df: DataFrame, record: Sequence[str], cls: str = "class") -> DataFrame:
    """How often records occur: ``(class, copies, records, total)``."""
    copies = df.groupBy(cls, *record).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy(cls, "copies").agg(F.count(F.lit(1)).alias("records")).withColumn(
        "total", F.col("copies") * F.col("records")
    )


def has_duplicates(df: DataFrame, record: Sequence[str]) -> DataFrame:
    """One row: does any record occur more than once, and how many rows are surplus."""
    return df.groupBy(*record).agg(F.count(F.lit(1)).alias("c")).agg(
        (F.max("c") > 1).alias("has_duplicates"), F.sum(F.col("c") - 1).cast("bigint").alias("surplus"),
    )


def correlations(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``(var_x, var_y, corr)`` for every pair (both orders and the diagonal), one scan.

    Rows where either variable is missing (null or NaN) do not count for the pair.
    """
    pairs = list(combinations(variables, 2))
    both = lambda a, b, x: F.when(~F.isnan(a) & ~F.isnan(b), F.col(x))
    row = df.agg(*[F.corr(both(a, b, a), both(a, b, b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [(a, b, F.col(f"c{i}")) for i, (a, b) in enumerate(pairs)]
    entries += [(b, a, c) for a, b, c in entries] + [(v, v, F.lit(1.0)) for v in variables]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), c.alias("corr")) for a, b, c in entries
    ])))


def drop_outliers(df: DataFrame, variables: Sequence[str], k: float = 3.0) -> DataFrame:
    """Rows without missing values whose population z-score is below ``k`` everywhere."""
    whole = df
    for v in variables:
        whole = whole.filter(~is_missing(F.col(v)))
    stats = whole.agg(
        *[F.avg(v).alias(f"__m_{v}") for v in variables], *[F.stddev_pop(v).alias(f"__s_{v}") for v in variables]
    )
    out = whole.crossJoin(F.broadcast(stats))
    for v in variables:
        out = out.filter(F.abs(F.col(v) - F.col(f"__m_{v}")) < F.lit(float(k)) * F.col(f"__s_{v}"))
    return out.drop(*[f"__{p}_{v}" for p in "ms" for v in variables])


def pair_densities(df: DataFrame, axes: Mapping[str, Edges], cls: str = "class") -> DataFrame:
    """2-D counts ``(class, var_x, var_y, bin_x, bin_y, n)`` for every pair of variables."""
    numbers = {v: bin_number(F.col(v), e) for v, e in axes.items()}
    binned = df.select(cls, *[c.alias(f"__b_{v}") for v, c in numbers.items()])
    entries = F.array(*[
        F.struct(
            F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
            F.col(f"__b_{a}").alias("bin_x"), F.col(f"__b_{b}").alias("bin_y"),
        )
        for a, b in combinations(axes, 2)
    ])
    return (
        binned.select(cls, F.inline(entries))
        .filter(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
        .groupBy(cls, "var_x", "var_y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))
    )


# --------------------------------------------------------------------- item arrays

def real_items(items: Column, probe: str, origin_field: str | None = None, origin_values: Sequence | None = None) -> Column:
    """How many items have their probe field, optionally of some types only."""
    def real(x):
        keep = ~is_missing(x[probe])
        return keep & x[origin_field].isin(list(origin_values)) if origin_field else keep

    return F.size(F.filter(items, real))


def items_per_row(df: DataFrame, items: str, keys: Sequence[str], probe: str, origin_field: str | None = None,
                  origin_values: Sequence | None = None) -> DataFrame:
    """``keys`` and ``n_items``: items whose probe field is not missing, optionally of some types."""
    return df.select(*keys, real_items(F.col(items), probe, origin_field, origin_values).alias("n_items"))


def nth_item(items: Column, by: str, n: int | None) -> Column:
    """The n-th item (from 0) by a field, largest first, missing last; all items if None."""
    if n is None:
        return items

    def larger_first(a, b):
        return (
            F.when(is_missing(a[by]) & is_missing(b[by]), 0).when(is_missing(a[by]), 1).when(is_missing(b[by]), -1)
            .when(a[by] > b[by], -1).when(a[by] < b[by], 1).otherwise(0)
        )

    return F.slice(F.array_sort(items, larger_first), n + 1, 1)
