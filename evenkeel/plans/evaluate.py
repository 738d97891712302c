"""Evaluation of stored classifier outputs, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.cuts import apply_cuts
from evenkeel.operators import evaluation as ev
from evenkeel.operators.labels import rows_per_class


def evaluate(
    df: DataFrame, classifiers: Sequence[ev.Classifier], main: Sequence[str], effs: Sequence[float],
    fraction_grid: Sequence[dict] | None = None, working_point: float = 0.77, keep: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Score table, class counts, rejection per efficiency and per fraction combination."""
    tables = {
        "scores": ev.score_table(df, classifiers, main, keep),
        "counts": rows_per_class(df),
        "rejection_per_efficiency": ev.rejection_per_efficiency(ev.scores_long(df, classifiers, main), effs, main),
    }
    if fraction_grid:
        tables["rejection_per_fraction"] = ev.rejection_per_fraction(df, classifiers, main, fraction_grid, working_point)
    return tables


def flagship(spark: SparkSession, sf: str, eff: float = 0.77) -> DataFrame:
    """Read rows, apply cuts, label classes, score, report every background's rejection."""
    from evenkeel.operators.labels import label_classes
    from evenkeel.queries.base import CLASSES, MAIN, NET, TREE, rows, with_probabilities

    kept = apply_cuts(rows(spark, sf), [
        {"price": {"operator": "<=", "condition": 90000}}, {"mass": {"operator": ">=", "condition": 0.01}}], ["price"])
    scores = ev.scores_long(with_probabilities(label_classes(kept, CLASSES)), [NET, TREE], MAIN)
    return ev.rejection_at(scores, eff, MAIN).select(
        "classifier", "class", F.round("cut", 6).alias("cut"), "n", "n_pass", F.round("rejection", 6).alias("rejection"))
