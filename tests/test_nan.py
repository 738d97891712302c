"""Scores and probabilities that are NaN."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.operators import evaluation as ev
from evenkeel.operators import histograms as h


def test_nan_scores_pass_no_cut(spark):
    rows = [("net", "b", 0.1 * i) for i in range(7)] + [("net", "b", math.nan)] * 3
    scores = spark.createDataFrame(rows, "classifier string, class string, score double")
    for n_cuts in (1, 9):
        cuts = spark.createDataFrame([("net", i, 0.5, 0.55 + 2 * (i > 0)) for i in range(n_cuts)], "classifier string, eff_no int, eff double, cut double")
        got = ev.pass_counts(scores, cuts, n_cuts).collect()
        assert {(r["eff_no"], r["n"], r["n_pass"]) for r in got} == {(i, 10, int(i == 0)) for i in range(n_cuts)}
    bins = scores.withColumn("v", F.lit(0.5))
    row = ev.efficiency_vs_variable(bins, "score", "v", [0.0, 1.0], ["s"], cut=0.55).first()
    assert (row["n"], row["n_pass"]) == (10, 1)


def test_nan_differences_exceed_no_threshold(spark):
    df = spark.createDataFrame([(0.5, math.nan), (0.5, 0.25)], "a double, b double")
    got = [(r["threshold"], r["n_above"]) for r in ev.score_agreement(df, "a", "b", [0.1, 0.3]).collect()]
    assert got == [(0.1, 1), (0.3, 0)]


def test_nan_probability_makes_the_loss_nan(spark):
    df = spark.createDataFrame([(0, 0.2, 0.8), (1, 0.2, math.nan)], "label int, p0 double, p1 double")
    assert math.isnan(ev.quality(df, [F.col("p0"), F.col("p1")]).first()["loss"])
    assert ev.quality(df.limit(1), [F.col("p0"), F.col("p1")]).first()["loss"] == pytest.approx(-math.log(0.2))


def test_correlations_skip_missing_pairs(spark):
    x, y = np.arange(6.0), np.array([1.0, 3.0, 2.0, 5.0, 4.0, 9.0])
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(math.nan, 7.0), (3.0, None), (None, math.nan)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {(r["var_x"], r["var_y"]): r["corr"] for r in h.correlations(df, ["x", "y"]).collect()}
    assert got["x", "y"] == pytest.approx(np.corrcoef(x, y)[0, 1]) and got["x", "x"] == 1.0
