"""Resampling with replacement toward a target density."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.functions.arrays import above, count_below
from evenkeel.functions.keys import shuffled
from evenkeel.functions.numeric import safe_divide
from evenkeel.operators.binning import Edges, edge_table, flat_bin, full_grid, n_bins
from evenkeel.operators.fractions import correct_fractions, with_fraction
from evenkeel.operators.ranking import running_sum_in, sparse_digits
from evenkeel.session import BROADCAST_ROWS, cut_lineage, small, small_counted

# Weights between two powers of two become whole numbers of this size at least, so that running
# sums do not depend on order.
WEIGHT_UNIT = 1 << 20
# Powers of two that part the positive doubles. They part weights times this factor: weights that should
# be 1 or 2 but for rounding would else fall on both sides of an edge.
STRATA = 2_100
OFF_EDGE = 0.7


def sample_counts(df: DataFrame, axes: Mapping[str, Edges]) -> DataFrame:
    """``(origin, class, bin, n)``; a NULL bin for the rows outside the grid."""
    return df.withColumn("bin", flat_bin(axes)).groupBy("origin", "class", "bin").agg(F.count(F.lit(1)).alias("n"))


def sample_histograms(df: DataFrame, origins: Sequence[str], classes: Sequence[str], axes: Mapping[str, Edges]) -> DataFrame:
    """``(origin, class, bin, n)`` on the full grid."""
    return complete_histograms(sample_counts(df, axes), origins, classes, axes)


def complete_histograms(counts: DataFrame, origins: Sequence[str], classes: Sequence[str], axes: Mapping[str, Edges]) -> DataFrame:
    """``sample_counts`` without the rows outside the grid, empty bins filled in."""
    bins = n_bins(axes)
    counted = counts.filter(F.col("bin").isNotNull())
    grid = full_grid(counts.sparkSession, {"origin": origins, "class": classes}, bins)
    rows = bins * len(origins) * len(classes)
    return grid.join(small(counted, rows), ["origin", "class", "bin"], "left").na.fill(0, ["n"])


def target_numbers(counts: DataFrame, target_class: str, fractions: Mapping[str, float], n_rows: int = -1) -> DataFrame:
    """Rows to draw per origin: ``(origin, available, fraction, target)``.

    ``counts`` is (origin, class, n). The target class's rows fix the corrected
    numbers, which are then scaled up or down to ``n_rows`` in total (-1: as is).
    """
    first = counts.filter(F.col("class") == target_class).select("origin", F.col("n").alias("available"))
    sized = correct_fractions(with_fraction(first, "origin", fractions), available="available")
    if n_rows == -1:
        return sized
    total = sized.agg(F.sum("target").alias("__total"))
    return sized.crossJoin(total).withColumn(
        "target", F.floor(F.col("target") * (F.lit(float(n_rows)) / F.col("__total"))).cast("bigint")
    ).drop("__total")


def numbers_per_sample(
    counts: DataFrame, targets: DataFrame,
    max_upsampling: Mapping[tuple[str, str], float] | None = None,
    sampling_fraction: Mapping[tuple[str, str], float] | None = None,
) -> DataFrame:
    """``(origin, class, available, asked, n_draw)`` after the upsampling limits.

    A class with a limited sample is corrected back to the origin fractions as a
    whole; a sampling fraction then scales its own sample.
    """
    def lookup(table, default):
        value = F.lit(default).cast("double")
        for (origin, cls), v in (table or {}).items():
            value = F.when((F.col("origin") == origin) & (F.col("class") == cls), F.lit(float(v))).otherwise(value)
        return value

    limited = sorted({cls for _, cls in (max_upsampling or {})})
    asked = counts.withColumnRenamed("n", "available").join(
        targets.select("origin", "fraction", "target"), "origin"
    )
    limit = lookup(max_upsampling, None)
    cap = F.floor(F.col("available") * limit).cast("bigint")
    asked = asked.withColumn("asked", F.when(limit < F.col("target") / F.col("available"), cap).otherwise(F.col("target")))
    free = asked.filter(~F.col("class").isin(limited)) if limited else asked
    numbers = free.withColumn("n_draw", F.col("asked"))
    if limited:
        fixed = correct_fractions(
            asked.filter(F.col("class").isin(limited)).drop("target"), ["class"], available="asked"
        ).withColumnRenamed("target", "n_draw")
        cols = ["origin", "class", "available", "asked", "n_draw"]
        numbers = numbers.select(*cols).unionByName(fixed.select(*cols))
    return numbers.select(
        "origin", "class", "available", "asked",
        F.floor(F.col("n_draw") * lookup(sampling_fraction, 1.0)).cast("bigint").alias("n_draw"),
    )


def density_ratios(hists: DataFrame, target: DataFrame) -> DataFrame:
    """``(origin, class, bin, n, n_target, ratio)``: target over own, 0 in empty bins.

    ``target`` is (origin, bin, n_target).
    """
    return hists.join(target, ["origin", "bin"]).withColumn(
        "ratio", safe_divide(F.col("n_target"), F.col("n"), 0.0)
    )


def target_of_class(hists: DataFrame, target_class: str) -> DataFrame:
    """The target histogram of every origin: that of one class."""
    return hists.filter(F.col("class") == target_class).select("origin", "bin", F.col("n").alias("n_target"))


def target_of_function(
    spark: SparkSession, axes: Mapping[str, Edges], origins: Sequence[str],
    density: Callable[[Column, Column], Column],
) -> DataFrame:
    """A target histogram from a user function of the two bin centres."""
    (_, xs), (_, ys) = axes.items()
    x = edge_table(spark, xs).select(F.col("bin").alias("ix"), ((F.col("lo") + F.col("hi")) / 2).alias("x"))
    y = edge_table(spark, ys).select(F.col("bin").alias("iy"), ((F.col("lo") + F.col("hi")) / 2).alias("y"))
    cells = x.crossJoin(y).withColumn("bin", (F.col("ix") * (len(ys) - 1) + F.col("iy")).cast("int"))
    return cells.select(
        F.explode(F.array(*[F.lit(o) for o in origins])).alias("origin"), "bin",
        density(F.col("x"), F.col("y")).cast("double").alias("n_target"),
    )


def bin_centres(spark: SparkSession, axes: Mapping[str, Edges]) -> DataFrame:
    """``(axis, bin, centre)`` of every axis."""
    parts = [
        edge_table(spark, e).select(F.lit(a).alias("axis"), "bin", ((F.col("lo") + F.col("hi")) / 2).alias("centre"))
        for a, e in axes.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- smooth ratios

def spline_knots(edges: Edges) -> np.ndarray:
    """Breakpoints of the interpolating cubic spline through the bin centres.

    Not-a-knot: the second and second-last centre are no breakpoints; the outer
    breakpoints are the ends of the binned range.
    """
    edges = np.asarray(edges, dtype=float)
    centres = (edges[:-1] + edges[1:]) / 2
    return np.concatenate([[edges[0]], centres[2:-2], [edges[-1]]])


def _basis(knots: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values of all cubic B-splines on ``knots`` (outer ones repeated) at ``x``."""
    t = np.concatenate([[knots[0]] * 3, knots, [knots[-1]] * 3])
    cell = np.clip(np.searchsorted(knots, x, side="right") - 1, 0, len(knots) - 2) + 3
    b = np.zeros((len(x), len(t) - 1))
    b[np.arange(len(x)), cell] = 1.0
    for k in range(1, 4):
        nxt = np.zeros((len(x), len(t) - 1 - k))
        for i in range(len(t) - 1 - k):
            left, right = t[i + k] - t[i], t[i + k + 1] - t[i + 1]
            if left > 0:
                nxt[:, i] += (x - t[i]) / left * b[:, i]
            if right > 0:
                nxt[:, i] += (t[i + k + 1] - x) / right * b[:, i + 1]
        b = nxt
    return b


# Nodes per cell from which the local cubic is read off.
_NODES = np.array([0.0, 1 / 3, 2 / 3, 1.0])
_TO_POWERS = np.linalg.inv(np.vander(_NODES, 4, increasing=True))


def _cell_matrix(edges: Edges) -> np.ndarray:
    """(cells, 4, bins): bin values to the powers of the local coordinate in each cell."""
    edges = np.asarray(edges, dtype=float)
    knots, centres = spline_knots(edges), (edges[:-1] + edges[1:]) / 2
    solve = np.linalg.inv(_basis(knots, centres))
    out = []
    for a, b in zip(knots, knots[1:]):
        inside = a + (b - a) * _NODES
        # stay inside the cell so that the basis belongs to it
        inside[-1] = np.nextafter(b, a)
        out.append(_TO_POWERS @ _basis(knots, inside) @ solve)
    return np.stack(out)


def spline_cells(ratios: DataFrame, axes: Mapping[str, Edges]) -> DataFrame:
    """``(origin, class, cell, coefs)``: the smooth ratio as a bicubic per cell.

    One small grid per (origin, class) is solved in a grouped task; its size is fixed
    by the binning.
    """
    (_, xs), (_, ys) = axes.items()
    nx, ny = len(xs) - 1, len(ys) - 1
    mx, my = _cell_matrix(xs), _cell_matrix(ys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros(nx * ny)
        grid[pdf["bin"].to_numpy()] = pdf["ratio"].to_numpy()
        coefs = np.einsum("apx,xy,bqy->abpq", mx, grid.reshape(nx, ny), my)
        flat = coefs.reshape(-1, 16)
        return pd.DataFrame({
            "origin": pdf["origin"].iloc[0], "class": pdf["class"].iloc[0],
            "cell": np.arange(len(flat), dtype="int32"), "coefs": list(flat),
        })

    return ratios.select("origin", "class", "bin", "ratio").groupBy("origin", "class").applyInPandas(
        fit, "origin string, class string, cell int, coefs array<double>"
    )


def _locate(x: Column, knots: np.ndarray) -> tuple[Column, Column]:
    """Cell number and local coordinate in [0, 1]; values outside move to the border."""
    table = F.array(*[F.lit(float(k)) for k in knots])
    held = F.greatest(F.least(x.cast("double"), F.lit(float(knots[-1]))), F.lit(float(knots[0])))
    cell = F.greatest(F.least(count_below(table, held, len(knots), inclusive=True) - 1, F.lit(len(knots) - 2)), F.lit(0))
    left, right = F.get(table, cell), F.get(table, cell + 1)
    return cell, (held - left) / (right - left)


def smooth_weights(df: DataFrame, ratios: DataFrame, axes: Mapping[str, Edges], name: str = "weight") -> DataFrame:
    """Evaluate the smooth ratio at every row; negative values become 0.

    The fit is a small table of polynomial pieces, so the evaluation is a broadcast
    join and plain arithmetic. It needs a grid of 4 x 4 bins or more; for smaller ones
    the caller chooses ``step_weights``.
    """
    (xn, xs), (yn, ys) = axes.items()
    if len(xs) < 5 or len(ys) < 5:
        raise ValueError("a smooth ratio needs at least 4 x 4 bins")
    kx, ky = spline_knots(xs), spline_knots(ys)
    ix, u = _locate(F.col(xn), kx)
    iy, v = _locate(F.col(yn), ky)
    cells = spline_cells(ratios, axes)
    located = df.withColumns({"__ix": ix, "__iy": iy, "__u": u, "__v": v}).withColumn(
        "cell", F.col("__ix") * (len(ky) - 1) + F.col("__iy")
    )
    joined = located.join(small_counted(cells), ["origin", "class", "cell"], "left")
    value = F.lit(0.0)
    for p in range(3, -1, -1):
        inner = F.lit(0.0)
        for q in range(3, -1, -1):
            inner = inner * F.col("__v") + F.get("coefs", F.lit(4 * p + q))
        value = value * F.col("__u") + inner
    return joined.withColumn(name, F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))).drop(
        "__ix", "__iy", "__u", "__v", "cell", "coefs"
    )


def step_weights(df: DataFrame, ratios: DataFrame, axes: Mapping[str, Edges], name: str = "weight") -> DataFrame:
    """The ratio of the row's own bin; rows outside the grid weigh nothing."""
    table = ratios.select("origin", "class", "bin", F.col("ratio").alias(name))
    return (
        df.withColumn("bin", flat_bin(axes))
        .join(small_counted(table), ["origin", "class", "bin"], "left")
        .withColumn(name, F.coalesce(name, F.lit(0.0)))
        .drop("bin")
    )


# ------------------------------------------------------------- drawing with copies

def power_of_two(x: Column) -> Column:
    """The exponent e of a positive number with 2^e <= x < 2^(e+1), exact also where logarithms round."""
    near = F.floor(F.log2(x)).cast("int")
    return F.when(F.pow(F.lit(2.0), near) > x, near - 1).when(F.pow(F.lit(2.0), near + 1) <= x, near + 1).otherwise(near)


def deal_draws(strata: DataFrame, groups: Sequence[str], seed: int) -> DataFrame:
    """Add ``n_here``: ``n_draw`` dealt to the strata of a group in proportion to their weight, the heaviest first.

    ``strata`` is (*groups, __e, __total, n_draw), ``__total`` in units of the stratum's own power of two.
    """
    per_group = W.partitionBy(*groups)
    in_turn = per_group.orderBy(F.col("__e").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    mass = F.col("__total") * F.pow(F.lit(2.0), F.col("__e") - F.max("__e").over(per_group))
    upto = F.floor(F.col("n_draw") * (F.sum("__mass").over(in_turn) / F.sum("__mass").over(per_group)) + F.lit(seed % 1000 / 1000)).cast("bigint")
    dealt = strata.withColumn("__mass", mass).withColumn("__upto", upto)
    before = F.lag("__upto", 1, 0).over(per_group.orderBy(F.col("__e").desc()))
    return dealt.withColumn("n_here", F.col("__upto") - before).drop("__mass", "__upto")


def drawn_keys(
    df: DataFrame, numbers: DataFrame, groups: Sequence[str], max_groups: int,
    weight: str = "weight", key: str = "row_key", seed: int = 42,
) -> DataFrame:
    """``(key, weight, multiplicity)`` of the drawn rows: exactly ``n_draw`` draws per group, in proportion to weight.

    Weights may differ by any factor. A group's rows form strata of weights that differ by a factor
    of two at most; the draws are dealt to the strata by their weight. Within a stratum weights are whole
    numbers of 21 binary digits or more, and sampling is systematic along the hash order: row i covers the stretch of the running
    weight between C(i-1) and C(i), and receives the marks that fall on it.

    The rows are read once for a thin written table (key, stratum, weight) on which all this runs. Ranges of the hash order without a
    mark are only added up; rows of the others are sorted. Keys must be unique. A group with draws but without weight is an
    error, so is an infinite weight.
    """
    groups = list(groups)
    positive = df.filter(above(F.col(weight), F.lit(0.0)))
    sound = F.when(F.col(weight) == F.lit(float("inf")), F.raise_error(F.lit("an infinite weight"))).otherwise(F.col(weight)).cast("double")
    exponent = power_of_two(F.col("__weight") * OFF_EDGE)
    units = F.round(F.col("__weight") / F.pow(F.lit(2.0), F.col("__e")) * WEIGHT_UNIT).cast("bigint")
    thin = cut_lineage(positive.select(*groups, key, sound.alias("__weight")).withColumn("__e", exponent).withColumn("__w", units))
    # one row per group and power of two
    totals = thin.groupBy(*groups, "__e").agg(F.sum("__w").alias("__total"), F.count(F.lit(1)).alias("__rows"))
    strata = cut_lineage(numbers.select(*groups, "n_draw").join(totals, groups, "left"))
    lacking = strata.filter("n_draw > 0 AND __total IS NULL").select(*groups).head()
    if lacking:
        raise ValueError(f"draws from a group without weight: {', '.join(map(str, lacking))}")
    plan = cut_lineage(deal_draws(strata.filter("__total IS NOT NULL"), groups, seed).filter("n_here > 0").drop("n_draw"))
    size = plan.agg(F.sum("__rows"), F.count(F.lit(1)), F.max("n_here"), F.sum(F.col("n_here").cast("decimal(38,0)"))).first()
    n_rows, n_strata, most_marks, n_draws = (int(x or 0) for x in size)
    per_stratum = [*groups, "__e"]
    dealt = small(plan.drop("__rows"), max_groups * STRATA)
    drawable = thin.join(dealt, per_stratum).withColumn("_hash", shuffled(F.col(key), seed))
    phase = F.expr(f"(cast(__total as decimal(25,0)) * {seed % 1000}) div 1000").cast("decimal(20,0)")

    def whole(x: Column) -> Column:
        return x.cast("decimal(19,0)")

    def marks(upto: Column) -> Column:
        return F.call_function("div", whole(F.col("n_here")) * whole(upto) + phase, whole(F.col("__total")))

    def marks_on(first: Column, stop: Column) -> Column:
        return (marks(stop) - marks(first)).cast("bigint")

    def near(upto: Column, off: int) -> Column:
        # marks in doubles, moved by more than their error
        n = F.col("n_here").cast("double")
        return F.floor(n * (upto / F.col("__total")) + F.lit(seed % 1000 / 1000) + off * (n * 1e-12 + 1e-6))

    def marked(ranges: DataFrame) -> DataFrame:
        return ranges.join(dealt, per_stratum).filter(marks_on(F.col("__offset"), F.col("__offset") + F.col("__s")) > 0)

    summed = running_sum_in(
        drawable, per_stratum, F.col("__w"), "__c", marked, n_draws, least=sparse_digits(n_rows, n_strata, most_marks))
    # exact marks only where a mark may be
    likely = summed.filter(near(F.col("__c"), 1) > near(F.col("__c") - F.col("__w"), -1))
    picked = likely.select(key, F.col("__weight").alias(weight), marks_on(F.col("__c") - F.col("__w"), F.col("__c")).alias("multiplicity"))
    picked = picked.filter(F.col("multiplicity") > 0)
    return small(cut_lineage(picked), n_draws) if n_draws <= BROADCAST_ROWS else picked


def draw_with_replacement(
    df: DataFrame, numbers: DataFrame, groups: Sequence[str], max_groups: int,
    weight: str = "weight", key: str = "row_key", seed: int = 42,
) -> DataFrame:
    """Add ``multiplicity`` to the rows that ``drawn_keys`` names; the others are dropped.

    The rows are read once more to join the drawn keys: by broadcast, unless the draws are too many for it.
    """
    picked = drawn_keys(df, numbers, groups, max_groups, weight, key, seed)
    return df.join(picked.drop(weight), key).select(*df.columns, "multiplicity")


def repeat_rows(df: DataFrame, multiplicity: str = "multiplicity") -> DataFrame:
    """One row per copy, numbered from 1."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(multiplicity)))
    return df.filter(F.col(multiplicity) > 0).withColumn("copy", copies).drop(multiplicity)


def gather_rows(rows: DataFrame, index: DataFrame, key: str = "row_key") -> DataFrame:
    """Rows named by an index table (key, multiplicity), repeated as often as listed."""
    return repeat_rows(rows.join(index.select(key, "multiplicity"), key))
