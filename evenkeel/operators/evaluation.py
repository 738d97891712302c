"""Classifier quality from stored class probabilities.

A classifier is described by a ``Classifier``: its name, its probability columns in
class order and its background fractions. Scores are computed once in long form
``(class, classifier, score)``; cuts for all working points come from one exact
quantile run, and all working points are answered by one counting scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.functions.arrays import above, argmax, count_below
from evenkeel.functions.numeric import NAN, safe_divide
from evenkeel.functions.score import discriminant, probability_columns
from evenkeel.operators.binning import Edges, bin_number
from evenkeel.operators.histograms import histogram
from evenkeel.operators.quantiles import exact_quantiles, quantile_arrays
from evenkeel.session import cut_lineage, small, small_counted

# Fixed value: keeps the class size away from zero.
EPSILON = 1e-10


@dataclass(frozen=True)
class Classifier:
    """Name, class-to-suffix map in class order, and background fractions."""

    name: str
    suffixes: Mapping[str, str]
    fractions: Mapping[str, float] = field(default_factory=dict)

    def probabilities(self, columns: Sequence[str]) -> dict[str, Column]:
        return probability_columns(columns, self.name, self.suffixes)

    def is_absent(self, columns: Sequence[str]) -> bool:
        """No output column at all: the classifier is to be skipped."""
        return not any(f"{self.name}_{s}" in columns for s in self.suffixes.values())

    def score(self, columns: Sequence[str], main: Sequence[str], fractions=None) -> Column:
        return discriminant(self.probabilities(columns), main, fractions or self.fractions)


def present(classifiers: Sequence[Classifier], columns: Sequence[str]) -> list[Classifier]:
    return [c for c in classifiers if not c.is_absent(columns)]


def scores_long(df: DataFrame, classifiers: Sequence[Classifier], main: Sequence[str], keys: Sequence[str] = ("class",)) -> DataFrame:
    """``(*keys, classifier, score)`` for every classifier that has outputs, in one scan."""
    entries = [
        F.struct(F.lit(c.name).alias("classifier"), c.score(df.columns, main).alias("score"))
        for c in present(classifiers, df.columns)
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def score_table(df: DataFrame, classifiers: Sequence[Classifier], main: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, label, all probabilities and one ``disc_<name>`` per classifier."""
    there = present(classifiers, df.columns)
    probs = [
        p.alias(f"{c.name}_{c.suffixes[cls]}") for c in there for cls, p in c.probabilities(df.columns).items()
    ]
    return df.select(*keep, "label", *probs, *[c.score(df.columns, main).alias(f"disc_{c.name}") for c in there])


def class_scores(df: DataFrame, classifier: Classifier, main: Sequence[str], only: Sequence[str]) -> DataFrame:
    """Scores of the rows of some classes: ``(class, score)``."""
    return df.filter(F.col("class").isin(list(only))).select(
        "class", classifier.score(df.columns, main).alias("score")
    )


# ------------------------------------------------------------- cuts and rejections

def working_points(scores: DataFrame, effs: Sequence[float], main: Sequence[str],
                   keys: Sequence[str] = ("classifier",), max_groups: int = 10_000) -> DataFrame:
    """``(*keys, eff_no, eff, cut)``: the score a share ``eff`` of the main classes exceeds."""
    signal = scores.filter(F.col("class").isin(list(main)))
    found = exact_quantiles(signal, "score", [1.0 - e for e in effs], keys, max_groups)
    number = F.array(*[F.lit(float(e)) for e in effs])
    return found.select(*keys, F.col("prob_no").alias("eff_no"), F.get(number, F.col("prob_no")).alias("eff"), F.col("quantile").alias("cut"))


def pass_counts(scores: DataFrame, cuts: DataFrame, n_cuts: int, keys: Sequence[str] = ("classifier",),
                split: Sequence[str] = ("class",), max_groups: int = 10_000) -> DataFrame:
    """``(*keys, *split, eff_no, eff, cut, n, n_pass)`` for every cut, from one scan.

    Each score is placed among its group's sorted cuts; counts per place are then added
    up from the top, which gives the number strictly above each cut. A NaN score counts
    in ``n`` and passes no cut.
    """
    keys, split = list(keys), list(split)
    ladder = F.array_sort(F.collect_list(F.struct("cut", "eff_no", "eff")))
    frame = cuts.groupBy(*keys).agg(ladder.alias("__l")).withColumn("__cuts", F.transform("__l", lambda x: x["cut"]))
    frame = cut_lineage(frame)
    place = F.when(F.isnan("score"), 0).otherwise(count_below(F.col("__cuts"), F.col("score"), n_cuts))
    placed = _on(scores, small(frame.select(*keys, "__cuts"), max_groups), keys).select(
        *keys, *split, place.alias("__pos")
    )
    counts = placed.groupBy(*keys, *split, "__pos").agg(F.count(F.lit(1)).alias("__c"))
    # one short array of (place, count) per group and class
    per = counts.groupBy(*keys, *split).agg(
        F.collect_list(F.struct("__pos", "__c")).alias("__h"), F.sum("__c").alias("n")
    )
    out = _on(per, small(frame.select(*keys, "__l"), max_groups), keys).select(
        *keys, *split, "n", "__h", F.posexplode("__l").alias("__i", "__e")
    )
    passing = F.aggregate("__h", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["__pos"] > F.col("__i"), x["__c"]).otherwise(0))
    return out.select(
        *keys, *split, F.col("__e.eff_no").alias("eff_no"), F.col("__e.eff").alias("eff"),
        F.col("__e.cut").alias("cut"), "n", passing.alias("n_pass"),
    )


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys)) if keys else left.crossJoin(right)


def rejection(n_pass: Column, n: Column) -> Column:
    """``1 / (n_pass / (n + e))``; NaN when nothing passes."""
    return F.when(n_pass > 0, F.lit(1.0) / (n_pass / (n + F.lit(EPSILON)))).otherwise(F.lit(NAN))


def rejection_per_efficiency(scores: DataFrame, effs: Sequence[float], main: Sequence[str],
                             keys: Sequence[str] = ("classifier",), max_groups: int = 10_000) -> DataFrame:
    """``(*keys, class, eff_no, eff, cut, n, n_pass, rejection)`` for the background classes."""
    cuts = working_points(scores, effs, main, keys, max_groups)
    background = scores.filter(~F.col("class").isin(list(main)))
    counts = pass_counts(background, cuts, len(effs), keys, max_groups=max_groups)
    return counts.withColumn("rejection", rejection(F.col("n_pass"), F.col("n")))


def rejection_at(scores: DataFrame, eff: float, main: Sequence[str], keys: Sequence[str] = ("classifier",),
                 max_groups: int = 10_000) -> DataFrame:
    """Rejection of every background class at one working point."""
    return rejection_per_efficiency(scores, [eff], main, keys, max_groups).drop("eff_no", "eff")


def efficiency_grid(lo: float = 0.49, hi: float = 1.0, n: int = 100) -> list[float]:
    """Evenly spaced signal efficiencies."""
    return [lo + (hi - lo) * i / (n - 1) for i in range(n)]


def roc_table(rejections: DataFrame, reference: str) -> DataFrame:
    """Rejection curve with its binomial error and the ratio to a reference classifier."""
    share = safe_divide(F.col("n_pass"), F.col("n"), 0.0)
    error = F.pow("rejection", 2.0) * F.sqrt(F.abs(share * (1.0 - share)) / F.col("n"))
    curves = rejections.withColumn("rejection_err", error)
    ref = curves.filter(F.col("classifier") == reference).select("class", "eff_no", F.col("rejection").alias("__ref"))
    return curves.join(F.broadcast(ref), ["class", "eff_no"]).withColumn(
        "ratio", F.col("rejection") / F.col("__ref")
    ).drop("__ref")


# ------------------------------------------------------------------ fraction grid

def fraction_grid(background: Sequence[str], lo: float, hi: float, step: float) -> list[dict[str, float]]:
    """Ordered tuples of distinct step values that add up to one.

    Shares are whole numbers of ten-thousandths, so no tuple is lost to rounding; the last
    share is what the others leave, and only sums that can still reach one are followed.
    """
    whole = 10_000
    # as many as numpy.arange(lo, hi + step, step) has, without its rounding: one beyond hi if step does not divide the range
    count = math.ceil((hi + step - lo) / step - 1e-9)
    shares = [round((lo + i * step) * whole) for i in range(count)]
    allowed = set(shares)

    def tuples(taken: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        rest = whole - sum(taken)
        open_places = len(background) - len(taken)
        if open_places == 1:
            if rest in allowed and rest not in taken:
                yield (*taken, rest)
            return
        for share in shares:
            if share not in taken and share + (open_places - 1) * shares[0] <= rest:
                yield from tuples((*taken, share))

    grid = [{name: share / whole for name, share in zip(background, t)} for t in tuples(())] if shares else []
    if not grid:
        raise ValueError("no tuple of distinct fractions adds up to 1")
    return grid


def scores_per_fraction(df: DataFrame, classifiers: Sequence[Classifier], main: Sequence[str],
                        grid: Sequence[Mapping[str, float]]) -> DataFrame:
    """``(class, classifier, combo, score)``: every row's score under every combination.

    The combinations are a literal array in the projection; the long rows only ever
    feed map-side aggregations.
    """
    names = list(grid[0])
    combos = F.array(*[
        F.struct(F.lit(i).alias("combo"), *[F.lit(float(g[c])).alias(f"f_{c}") for c in names])
        for i, g in enumerate(grid)
    ])
    there = present(classifiers, df.columns)
    sums = []
    for c in there:
        probs = c.probabilities(df.columns)
        sums.append(F.struct(F.lit(c.name).alias("classifier"), *[p.cast("double").alias(f"p_{n}") for n, p in probs.items()]))
    base = df.select("class", F.inline(F.array(*sums))).select("*", F.inline(combos))
    classes = list(there[0].suffixes)
    score = discriminant({c: F.col(f"p_{c}") for c in classes}, main, {c: F.col(f"f_{c}") for c in names})
    return base.select("class", "classifier", "combo", score.alias("score"))


def rejection_per_fraction(df: DataFrame, classifiers: Sequence[Classifier], main: Sequence[str],
                           grid: Sequence[Mapping[str, float]], eff: float, block: int = 50) -> DataFrame:
    """``(classifier, combo, class, cut, n, n_pass, rejection, f_*)`` at one working point."""
    parts = []
    for start in range(0, len(grid), block):
        part = grid[start:start + block]
        scores = scores_per_fraction(df, classifiers, main, part)
        rej = rejection_at(scores, eff, main, ["classifier", "combo"], len(part) * len(classifiers))
        fractions = {
            c: F.get(F.array(*[F.lit(float(g[c])) for g in part]), F.col("combo")) for c in part[0]
        }
        parts.append(rej.select("*", *[v.alias(f"f_{c}") for c, v in fractions.items()])
                     .withColumn("combo", F.col("combo") + start))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fraction_contour(rejections: DataFrame, classifier: str, along: str, fixed: Mapping[str, float],
                     rej_x: str, rej_y: str, marked: float | None = None) -> DataFrame:
    """``(f_<along>, rej_x, rej_y, marked)`` along one fraction with others fixed.

    A marked fraction that is not on the line is an error.
    """
    line = rejections.filter(F.col("classifier") == classifier)
    for c, v in fixed.items():
        line = line.filter(F.abs(F.col(f"f_{c}") - F.lit(float(v))) < 1e-9)
    pivot = line.groupBy(f"f_{along}").agg(
        F.max(F.when(F.col("class") == rej_x, F.col("rejection"))).alias("rej_x"),
        F.max(F.when(F.col("class") == rej_y, F.col("rejection"))).alias("rej_y"),
    )
    if marked is None:
        return pivot.withColumn("marked", F.lit(False))
    out = pivot.withColumn("marked", F.abs(F.col(f"f_{along}") - F.lit(float(marked))) < 1e-9)
    hits = out.agg(F.max("marked").alias("__hit"))
    checked = F.when(F.col("__hit"), F.col("marked")).otherwise(
        F.raise_error(F.lit("the marked fraction is not on the line")).cast("boolean"))
    return out.crossJoin(F.broadcast(hits)).withColumn("marked", checked).drop("__hit")


# ------------------------------------------------------------- confusion, vs variable

def confusion_matrix(df: DataFrame, probs: Sequence[Column], n_classes: int) -> DataFrame:
    """``(label, predicted, n, share)``: first largest probability, shares per true class."""
    predicted = argmax(F.array(*[p.cast("double") for p in probs]))
    counts = (
        df.filter(F.col("label") < n_classes).select("label", predicted.alias("predicted"))
        .groupBy("label", "predicted").agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(W.partitionBy("label"))
    return counts.withColumn("share", F.col("n") / total)


def efficiency_vs_variable(df: DataFrame, score: str, variable: str, edges: Edges, main: Sequence[str],
                           eff: float | None = None, cut: float | None = None, per_bin: bool = False) -> DataFrame:
    """``(class, bin, cut, n, n_pass, efficiency, error, rejection)``.

    The cut is given, or taken from all main-class rows at ``eff``, or (``per_bin``)
    from those of each bin so that the signal efficiency is constant.
    """
    binned = df.select("class", F.col(score).alias("score"), F.col(variable).alias("__v")).withColumn(
        "bin", bin_number(F.col("__v"), edges)).drop("__v")
    inside = binned.filter(F.col("bin").isNotNull())
    signal = F.col("class").isin(list(main))
    if cut is not None:
        joined = inside.withColumn("cut", F.lit(float(cut)))
    elif per_bin:
        cuts = exact_quantiles(inside.filter(signal), "score", [1.0 - eff], ["bin"], len(edges))
        joined = inside.join(small(cuts.select("bin", F.col("quantile").alias("cut")), len(edges)), "bin")
    else:
        cuts = exact_quantiles(binned.filter(signal), "score", [1.0 - eff])
        joined = inside.crossJoin(F.broadcast(cuts.select(F.col("quantile").alias("cut"))))
    counted = joined.groupBy("class", "bin", "cut").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(above(F.col("score"), F.col("cut")), 1)).alias("n_pass"),
    )
    share = F.col("n_pass") / F.col("n")
    return counted.select(
        "class", "bin", "cut", "n", "n_pass", share.alias("efficiency"),
        F.sqrt(share * (1.0 - share) / F.col("n")).alias("error"),
        rejection(F.col("n_pass"), F.col("n")).alias("rejection"),
    )


def score_histograms(scores: DataFrame, classifiers: Sequence[str], classes: Sequence[str], edges: Edges) -> DataFrame:
    """Normalised score histograms per classifier and class."""
    return histogram(scores, F.col("score"), edges, {"classifier": classifiers, "class": classes})


# ----------------------------------------------------------- quality per data set

def quality(df: DataFrame, probs: Sequence[Column], keys: Sequence[str] = (), eps: float = 1e-7) -> DataFrame:
    """``(*keys, n, loss, accuracy)``: categorical cross entropy and share of right arg-max.

    A NaN probability of the true class makes the loss of its group NaN.
    """
    values = F.array(*[p.cast("double") for p in probs])
    given = F.get(values, F.col("label"))
    true = F.when(F.isnan(given), F.lit(NAN)).otherwise(F.least(F.greatest(given, F.lit(eps)), F.lit(1.0 - eps)))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(-F.ln(true)).alias("loss"),
        F.avg((argmax(values) == F.col("label")).cast("double")).alias("accuracy"),
    )


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Records of both tables; where both have a key, the new values win."""
    a, b = existing.select(*keys, *[F.col(v).alias(f"__o_{v}") for v in values]), new.select(*keys, *values)
    return a.join(b, list(keys), "full").select(
        *keys, *[F.coalesce(F.col(v), F.col(f"__o_{v}")).alias(v) for v in values]
    )


def store_records(new: DataFrame, path: str, part: str, keys: Sequence[str], values: Sequence[str]) -> None:
    """Upsert ``new`` into the table at ``path``, which has one folder for each value of ``part`` (an epoch).

    Only the folders of values that ``new`` has are read, merged and replaced; all others stay as they are.
    The merged records are written before a folder is replaced, so a failed run leaves either the old or the new ones.
    """
    spark = new.sparkSession
    columns = [part, *keys, *values]
    new = cut_lineage(new.select(*columns))
    merged = new
    if _has_files(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        touched = old.join(small_counted(new.select(part).distinct()), part, "left_semi")
        merged = cut_lineage(upsert(touched, new, [part, *keys], values).select(*columns))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def _has_files(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def metric_series(table: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                  constants: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """``(*keys, metric, value)`` for line plots; constants repeat at every key."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    for name, values in (constants or {}).items():
        entries += [F.struct(F.lit(f"{name}_{m}").alias("metric"), F.lit(float(v)).alias("value")) for m, v in values.items()]
    return table.select(*keys, F.inline(F.array(*entries)))


# ------------------------------------------------------------ comparing classifiers

# The ladder of score differences.
DIFFERENCE_LADDER = (1e-6, 2e-6, 3e-6, 4e-6, 5e-6, 1e-5, 2e-5, 3e-5, 4e-5, 5e-5, 1e-4, 2e-4, 3e-4, 4e-4, 5e-4,
                     1e-3, 2e-3, 3e-3, 4e-3, 5e-3, 1e-2, 2e-2, 3e-2, 4e-2, 5e-2, 1e-1, 2e-1, 3e-1, 4e-1, 5e-1)


def score_agreement(df: DataFrame, a: str, b: str, ladder: Sequence[float] = DIFFERENCE_LADDER, n_items: str | None = None,
                    below_items: int | None = None) -> DataFrame:
    """``(threshold, n_above, share)`` up to and including the first threshold whose share is 0.00 per cent.

    With ``below_items``, only rows whose ``n_items`` is smaller take part.
    """
    gap = F.abs(F.col(a) - F.col(b))
    chosen = df if below_items is None else df.filter(F.col(n_items) < below_items)
    row = chosen.select(gap.alias("__d")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(above(F.col("__d"), F.lit(t)), 1)).alias(f"__{i}") for i, t in enumerate(ladder)],
    )
    entries = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"__{i}").alias("n_above"),
                 (F.lit(True) if i == 0 else F.round(F.col(f"__{i - 1}") * 100 / F.col("__n"), 2) > 0).alias("__shown"))
        for i, t in enumerate(ladder)
    ])
    return row.select("__n", F.inline(entries)).filter("__shown").select(
        "threshold", "n_above", safe_divide(F.col("n_above"), F.col("__n"), 0.0).alias("share")
    )


def worst_rows(df: DataFrame, a: str, b: str, key: str, n: int) -> DataFrame:
    """The rows on which two scores differ most."""
    return df.select(key, a, b, F.abs(F.col(a) - F.col(b)).alias("difference")).orderBy(
        F.col("difference").desc(), F.col(key)
    ).limit(n)


def selection_summary(df: DataFrame, score: str, n_items: str, exact: int, effs: Sequence[float], classes: Sequence[str],
                      features: Sequence[str]) -> DataFrame:
    """Per class, working point and pass/fail: rows with exactly ``exact`` items, and feature means.

    The cut is taken from the class's own scores. The columns in use are written first, as they are read several times.
    """
    df = cut_lineage(df.select(*dict.fromkeys(["class", score, n_items, *features])))
    cuts = quantile_arrays(df, score, [1.0 - e for e in effs], ["class"], len(classes))
    chosen = df.filter(F.col(n_items) == exact).join(small(cuts, len(classes)), "class")
    numbered = chosen.select(
        "class", score, *features, F.posexplode("quantiles").alias("eff_no", "cut")
    ).withColumn("passed", F.when(above(F.col(score), F.col("cut")), True).when(above(F.col("cut"), F.col(score)), False))
    return numbered.filter(F.col("passed").isNotNull()).groupBy(
        "class", F.get(F.array(*[F.lit(float(e)) for e in effs]), F.col("eff_no")).alias("eff"), "passed"
    ).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"mean_{f}") for f in features])
