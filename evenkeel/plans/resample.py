"""The four resampling methods behind one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators import density, resampling as rs
from evenkeel.session import cut_lineage


def run_resampling(df: DataFrame, options: rs.ResamplingOptions, origins: Sequence[str] = (), **pdf) -> DataFrame:
    """Resample labelled rows (``class``, ``origin`` and a unique key) by the chosen method."""
    if options.method == "count":
        return rs.count_undersample(df, options)
    if options.method == "importance":
        return rs.importance_undersample(df, options)
    if options.method == "weighting":
        return rs.weight_rows(df, options)
    return pdf_resample(df, options, list(origins or options.fractions), **pdf)


def pdf_resample(
    df: DataFrame, options: rs.ResamplingOptions, origins: Sequence[str], smooth: bool = True,
    max_upsampling: Mapping[tuple[str, str], float] | None = None,
    sampling_fraction: Mapping[tuple[str, str], float] | None = None,
    target: DataFrame | None = None,
) -> DataFrame:
    """Every (origin, class) drawn with replacement into the target class's density.

    All samples go through one plan. The rows are read three times: for their counts per bin, which are written, for
    the drawn keys, and to join these. ``target`` replaces the class density.
    """
    rows = rs.choose_split(df, options)
    target_class = options.target_class or options.classes[0]
    counted = cut_lineage(density.sample_counts(rows, options.axes))
    counts = counted.groupBy("origin", "class").agg(F.sum("n").alias("n"))
    hists = cut_lineage(density.complete_histograms(counted, origins, options.classes, options.axes))
    ratios = density.density_ratios(hists, target if target is not None else density.target_of_class(hists, target_class))
    targets = density.target_numbers(counts, target_class, options.fractions, options.n_rows)
    numbers = density.numbers_per_sample(counts, targets, max_upsampling, sampling_fraction)
    weigh = density.smooth_weights if smooth else density.step_weights
    picked = density.drawn_keys(
        weigh(rows, ratios, options.axes), numbers, ["origin", "class"], len(origins) * len(options.classes),
        key=options.key, seed=options.seed,
    )
    return density.repeat_rows(rows.join(picked, options.key))
