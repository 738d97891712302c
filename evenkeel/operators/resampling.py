"""Balancing by undersampling and by weights.

Selection is repeatable: rows are taken in the md5 order of (seed, row key). Every
selecting step turns the hash to get its own order; reusing one would favour rows of
bins that an earlier step thinned out.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.keys import shuffled, turned
from evenkeel.functions.numeric import safe_divide
from evenkeel.operators.binning import Edges, flat_bin, full_grid, n_bins, with_bins
from evenkeel.operators.fractions import check_fractions, correct_fractions, with_fraction
from evenkeel.operators.ranking import below_thresholds, keep_smallest, smallest_thresholds
from evenkeel.session import cut_lineage, small

METHODS = ("count", "importance", "weighting", "pdf")


@dataclass(frozen=True)
class ResamplingOptions:
    """What to balance and how far.

    ``n_rows`` is the requested total, -1 for as many as possible; ``split`` chooses
    the training or validation part of a prepared table.
    """

    method: str
    classes: Sequence[str]
    axes: Mapping[str, Edges]
    n_rows: int = -1
    fractions: Mapping[str, float] = field(default_factory=dict)
    target_class: str | None = None
    seed: int = 42
    split: str | None = None
    key: str = "row_key"

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method {self.method!r} is not one of {METHODS}")
        if self.n_rows != -1 and self.n_rows <= 0:
            raise ValueError("n_rows has to be positive, or -1 for as many as possible")
        if self.n_rows == -1 and self.method == "count":
            raise ValueError("the count method needs a requested number of rows")
        if self.method in ("count", "pdf"):
            if not self.fractions:
                raise ValueError(f"the {self.method} method needs origin fractions")
            check_fractions(self.fractions)
        if self.method in ("importance", "weighting") and self.target_class not in self.classes:
            raise ValueError("the target class has to be one of the classes")


def choose_split(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """The rows of the configured split, when one is set."""
    return df if options.split is None else df.filter(F.col("split") == options.split)


def bin_counts(binned: DataFrame, classes: Sequence[str], bins: int) -> DataFrame:
    """``(class, bin, n)`` for the full grid, empty bins included."""
    return complete_counts(binned.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n")), classes, bins)


def complete_counts(counts: DataFrame, classes: Sequence[str], bins: int) -> DataFrame:
    """Counts per (class, bin) with the empty bins of the grid filled in."""
    grid = full_grid(counts.sparkSession, {"class": classes}, bins)
    return grid.join(small(counts, bins * len(classes)), ["class", "bin"], "left").na.fill(0, ["n"])


def sampling_ratios(counts: DataFrame, target_class: str, bins: int) -> DataFrame:
    """Add ``ratio`` = target count / own count per class and bin, 0 in empty bins."""
    target = counts.filter(F.col("class") == target_class).select("bin", F.col("n").alias("n_target"))
    return counts.join(small(target, bins), "bin").withColumn(
        "ratio", safe_divide(F.col("n_target"), F.col("n"), 0.0)
    )


def bin_weights(counts: DataFrame, target_class: str, bins: int) -> DataFrame:
    """``(class, bin, weight)`` that gives every class the target's binned shape."""
    return sampling_ratios(counts, target_class, bins).select("class", "bin", F.col("ratio").alias("weight"))


def attach_weights(df: DataFrame, weights: DataFrame, max_rows: int, name: str = "weight") -> DataFrame:
    """Weight by (class, bin); no bin or a zero weight gives 1."""
    table = weights.select("class", "bin", F.col("weight").alias("__w"))
    return (
        df.join(small(table, max_rows), ["class", "bin"], "left")
        .withColumn(name, F.coalesce(F.nullif(F.col("__w"), F.lit(0.0)), F.lit(1.0)))
        .drop("__w")
    )


# The selecting steps and how far each turns the hash.
BIN_STEP, ORIGIN_STEP, SIZE_STEP = 0, 1, 2


def with_hash(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """Add ``_hash``, the random order all selecting steps start from."""
    return df.withColumn("_hash", shuffled(F.col(options.key), options.seed))


@dataclass(frozen=True)
class Selection:
    """One selecting step: the written thresholds and how to apply them to hashed rows."""

    step: int
    groups: Sequence[str]
    thresholds: DataFrame
    max_groups: int
    counts: DataFrame

    def apply(self, hashed: DataFrame) -> DataFrame:
        own = hashed.withColumn("_own", turned(F.col("_hash"), self.step))
        return below_thresholds(own, self.groups, self.thresholds, self.max_groups, "_own").drop("_own")


def plan_selection(hashed: DataFrame, step: int, groups: Sequence[str], limits_of: Callable[[DataFrame], DataFrame],
                   max_groups: int) -> Selection:
    """Find a step's thresholds; ``limits_of`` turns (*groups, n) into (*groups, limit).

    The rows are read twice, group columns and hash only.
    """
    counts = cut_lineage(hashed.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")))
    limits = limits_of(counts).select(*groups, F.col("limit").cast("bigint"))
    own = hashed.select(*groups, turned(F.col("_hash"), step).alias("_own"))
    thresholds = smallest_thresholds(own, groups, limits, max_groups, "_own", counts)
    return Selection(step, groups, thresholds, max_groups, counts)


class Resampled(NamedTuple):
    """Resampled rows, and ``(class, requested, available, taken)``."""

    rows: DataFrame
    report: DataFrame


def size_report(selection: Selection, options: ResamplingOptions) -> DataFrame:
    """``(class, requested, available, taken)`` of the final size step, from its written counts.

    A warning tells of a total that the balanced classes cannot give; the rows there are taken then.
    """
    per_class = options.n_rows // len(options.classes)
    found = full_grid(selection.counts.sparkSession, {"class": options.classes}, 1).select("class").join(
        small(selection.counts, len(options.classes)), "class", "left").na.fill(0, ["n"])
    report = found.select(
        "class", F.lit(per_class).cast("bigint").alias("requested"), F.col("n").alias("available"),
        F.least(F.col("n"), F.lit(per_class)).cast("bigint").alias("taken"))
    total = report.agg(F.sum("taken")).first()[0]
    if total < per_class * len(options.classes):
        warnings.warn(f"{options.n_rows} rows were asked for, {total} are available", stacklevel=3)
    return report


def cap_samples(df: DataFrame, groups: Sequence[str], caps: DataFrame, max_groups: int,
                key: str = "row_key", seed: int = 42) -> DataFrame:
    """At most ``limit`` random rows of each sample, before any resampling."""
    hashed = df.withColumn("_hash", shuffled(F.col(key), seed))
    return keep_smallest(hashed, groups, caps, max_groups).drop("_hash")


def size_selection(df: DataFrame, options: ResamplingOptions) -> Selection:
    """The final size: requested total // number of classes for every class."""
    per_class = options.n_rows // len(options.classes)

    def limits(_: DataFrame) -> DataFrame:
        return full_grid(df.sparkSession, {"class": options.classes}, 1).select("class", F.lit(per_class).alias("limit"))

    return plan_selection(df, SIZE_STEP, ["class"], limits, len(options.classes))


def origin_selection(df: DataFrame, options: ResamplingOptions) -> Selection:
    """Origin fractions within every class, sized on the first listed class."""
    def limits(counts: DataFrame) -> DataFrame:
        reference = counts.filter(F.col("class") == options.classes[0]).select("origin", "n")
        sized = correct_fractions(with_fraction(reference, "origin", options.fractions))
        per_class = F.explode(F.array(*[F.lit(c) for c in options.classes]))
        return sized.select(per_class.alias("class"), "origin", F.col("target").alias("limit"))

    groups = len(options.classes) * len(options.fractions)
    return plan_selection(df, ORIGIN_STEP, ["class", "origin"], limits, groups)


def bin_selection(binned: DataFrame, options: ResamplingOptions, minima_of: Callable[[DataFrame], DataFrame]) -> Selection:
    """The same number of rows of every class in a bin; ``minima_of`` maps counts to (bin, limit)."""
    bins = n_bins(options.axes)

    def limits(counts: DataFrame) -> DataFrame:
        minima = minima_of(complete_counts(counts, options.classes, bins))
        return full_grid(binned.sparkSession, {"class": options.classes}, bins).join(small(minima, bins), "bin")

    return plan_selection(binned, BIN_STEP, ["class", "bin"], limits, bins * len(options.classes))


def cap_classes(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """At most the final size of every class; all rows when no total is requested."""
    if options.n_rows == -1:
        return df
    return cap_classes_reported(df, options).rows


def cap_classes_reported(df: DataFrame, options: ResamplingOptions) -> Resampled:
    """At most the final size of every class, and what was there."""
    hashed = with_hash(df, options)
    by_size = size_selection(hashed, options)
    return Resampled(by_size.apply(hashed).drop("_hash"), size_report(by_size, options))


def count_undersample(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """The rows of ``count_undersample_reported``."""
    return count_undersample_reported(df, options).rows


def count_undersample_reported(df: DataFrame, options: ResamplingOptions) -> Resampled:
    """Equal counts per bin for all classes, then origin fractions, then the total.

    The full rows are read twice: once to write a thin table of hash, class, origin and
    bin, on which all steps find their thresholds, and once for the final filters.
    """
    binned = with_hash(with_bins(choose_split(df, options), options.axes), options)
    thin = cut_lineage(binned.select("_hash", "class", "origin", "bin"))
    by_bin = bin_selection(thin, options, lambda counts: counts.groupBy("bin").agg(F.min("n").alias("limit")))
    even = by_bin.apply(thin)
    by_origin = origin_selection(even, options)
    by_size = size_selection(by_origin.apply(even), options)
    return Resampled(by_size.apply(by_origin.apply(by_bin.apply(binned))).drop("_hash"), size_report(by_size, options))


def importance_minima(counts: DataFrame, target_class: str, bins: int) -> DataFrame:
    """Rows every class can give per bin when scaled below the target's shape."""
    ratios = sampling_ratios(counts, target_class, bins)
    peak = ratios.groupBy("class").agg(F.max("ratio").alias("peak"))
    scaled = ratios.join(peak, "class").withColumn(
        "scaled", safe_divide(F.col("n"), F.col("peak"), 0.0) * F.col("ratio")
    )
    return scaled.groupBy("bin").agg(F.floor(F.min("scaled")).cast("bigint").alias("limit"))


def importance_undersample(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """The rows of ``importance_undersample_reported``; no report where no total is requested."""
    return importance_undersample_reported(df, options).rows


def importance_undersample_reported(df: DataFrame, options: ResamplingOptions) -> Resampled:
    """Every class drawn, without replacement, into the target class's binned shape.

    The report is None where no total is requested.
    """
    bins = n_bins(options.axes)
    binned = with_hash(with_bins(choose_split(df, options), options.axes), options)
    thin = cut_lineage(binned.select("_hash", "class", "bin"))
    by_bin = bin_selection(thin, options, lambda counts: importance_minima(counts, options.target_class, bins))
    kept = by_bin.apply(binned)
    if options.n_rows == -1:
        return Resampled(kept.drop("_hash"), None)
    by_size = size_selection(by_bin.apply(thin), options)
    return Resampled(by_size.apply(kept).drop("_hash"), size_report(by_size, options))


def weight_rows(df: DataFrame, options: ResamplingOptions) -> DataFrame:
    """All rows, each with the weight of its (class, bin). They are read once for the counts, when the function is called."""
    bins = n_bins(options.axes)
    binned = choose_split(df, options).withColumn("bin", flat_bin(options.axes))
    counts = cut_lineage(bin_counts(binned.filter(F.col("bin").isNotNull()), options.classes, bins))
    return attach_weights(binned, bin_weights(counts, options.target_class, bins), bins * len(options.classes))
