"""Exact interpolated quantiles for groups of any size.

First scan: a quantile sketch per group brackets every wanted order statistic with a
guaranteed rank error. Second scan: rows between brackets are only counted, rows
inside a bracket are counted per value. Both are map-side aggregations, so no raw
rows are shuffled and no group is gathered in one place; the ranks found in the
brackets are exact. Both scans run when the function is called: their small results
are written, so the rows are read exactly twice.

The values inside a bracket are ranked by one window, so a bracket may not hold many of them. Where
the size of a group lets it (above ``BRACKET_VALUES * accuracy / 8`` rows), brackets are narrowed first: a sketch of the
rows inside cuts each into ``GRID`` parts of about equal size, the rows of the parts are
counted, and the parts around the wanted ranks are the next bracket, until few enough rows are inside
or the bracket is a single value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.functions.arrays import count_below
from evenkeel.functions.numeric import INF
from evenkeel.session import cut_lineage, small

# Rank error of the sketch is n / ACCURACY; smaller groups are counted value by value.
ACCURACY = 20_000
# Distinct values a bracket may hold, and the parts a larger one is cut into.
BRACKET_VALUES = 1_000_000
GRID = 128


def narrowed(rows: DataFrame, frame: DataFrame, groups: list[str], rising: list[float], max_groups: int,
             accuracy: int, bracket_values: int) -> DataFrame:
    """``frame`` (*groups, __n, __lo, __hi) with brackets of ``bracket_values`` values at most between their ends."""
    m, x, key = len(rising), F.col("__x"), [*groups, "__j"]
    # the first brackets hold four rank errors on either side
    if (frame.agg(F.max("__n")).first()[0] or 0) * 8 <= bracket_values * accuracy:
        return frame
    first, stop = count_below(F.col("__hi"), x, m), count_below(F.col("__lo"), x, m, inclusive=True)
    located = _on(rows, small(frame, max_groups), groups).select(*groups, "__x", first.alias("__i"), stop.alias("__k"))
    # the rows inside, once for each bracket they are in; all rounds read these alone
    brackets = F.explode(F.sequence(F.col("__i"), F.col("__k") - 1)).alias("__j")
    inside = cut_lineage(located.filter(F.col("__i") < F.col("__k")).select(*groups, "__x", brackets))
    counts = cut_lineage(located.groupBy(*groups, F.col("__k").alias("__b")).agg(F.count(F.lit(1)).alias("__c")))
    number = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("__j")
    each = frame.select("*", number).select(
        *groups, "__n", "__j", F.get("__lo", F.col("__j")).alias("lo"), F.get("__hi", F.col("__j")).alias("hi"),
        (F.floor((F.col("__n") - 1) * F.get(F.array(*[F.lit(p) for p in rising]), F.col("__j"))) + 1).alias("k"))
    # a row with b bracket starts at or below it is below the brackets from number b on
    fewer = _on(each, counts, groups).groupBy(*key).agg(F.sum(F.when(F.col("__b") <= F.col("__j"), F.col("__c")).otherwise(0)).alias("below"))
    state = cut_lineage(each.join(small(fewer, max_groups * m), key).withColumn("last", F.least(F.col("k") + 1, F.col("__n"))))
    while True:
        held = inside.join(small(state.select(*key, "lo", "hi"), max_groups * m), key).filter((x >= F.col("lo")) & (x <= F.col("hi")))
        between = F.when((x > F.col("lo")) & (x < F.col("hi")), x)
        grid = F.percentile_approx(between, [i / GRID for i in range(GRID + 1)], accuracy)
        sketch = cut_lineage(held.groupBy(*key, "lo", "hi").agg(F.count(between).alias("size"), grid.alias("grid")))
        if not sketch.filter(F.col("size") > bracket_values).head(1):
            ends = F.array_sort(F.collect_list(F.struct("__j", "lo", "hi")))
            return state.groupBy(*groups, "__n").agg(ends.alias("__z")).select(
                *groups, "__n", F.col("__z.lo").alias("__lo"), F.col("__z.hi").alias("__hi"))
        # part 2 i + 1 is the i-th cut itself, part 2 i + 2 what lies between it and the next
        cuts = F.array_distinct(F.concat(F.array("lo"), F.coalesce("grid", F.array().cast("array<double>")), F.array("hi")))
        table = small(sketch.select(*key, cuts.alias("cuts")), max_groups * m)
        part = count_below(F.col("cuts"), x, GRID + 3) + count_below(F.col("cuts"), x, GRID + 3, inclusive=True)
        parts = held.join(table, key).groupBy(*key, part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
        in_turn = W.partitionBy(*key).orderBy("part")
        ranked = parts.withColumns({
            "upto": F.sum("c").over(in_turn.rowsBetween(W.unboundedPreceding, W.currentRow)),
            # the cut that opens a part stays in the bracket
            "cut": F.when((F.col("part") % 2 == 0) & (F.lag("part", 1).over(in_turn) == F.col("part") - 1), F.lag("c", 1).over(in_turn)).otherwise(0),
        }).join(small(state, max_groups * m), key).join(table, key)
        upto, from_ = F.col("below") + F.col("upto"), F.col("below") + F.col("upto") - F.col("c")
        has_k = (from_ < F.col("k")) & (F.col("k") <= upto)
        has_last = (from_ < F.col("last")) & (F.col("last") <= upto)
        low, high = F.get("cuts", F.floor((F.col("part") - 1) / 2).cast("int")), F.get("cuts", F.floor(F.col("part") / 2).cast("int"))
        state = cut_lineage(ranked.groupBy(*key, "__n", "k", "last").agg(
            F.max(F.when(has_k, low)).alias("lo"), F.max(F.when(has_last, high)).alias("hi"), F.max(F.when(has_k, from_ - F.col("cut"))).alias("below")))


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
    max_groups: int = 10_000, accuracy: int = ACCURACY, bracket_values: int = BRACKET_VALUES,
) -> DataFrame:
    """``(*groups, prob_no, prob, quantile)`` with linear interpolation between ranks.

    ``max_groups`` bounds the number of groups; missing values are left out. No window is
    longer than the ``bracket_values`` of a bracket for each of ``probs``.
    """
    groups, probs = list(groups), [float(p) for p in probs]
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    rising = [probs[i] for i in order]
    m, margin = len(rising), 3.0 / accuracy
    x = F.col("__x")
    rows = df.select(*groups, F.col(value).cast("double").alias("__x")).filter(x.isNotNull() & ~F.isnan(x))

    lows = [max(p - margin, 0.0) for p in rising]
    highs = [min(p + margin, 1.0) for p in rising]
    sketch = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__x", lows + highs, accuracy).alias("__s"),
    )
    whole = F.col("__n") <= accuracy

    def bracket(start: int, open_end: list[bool], infinite: float):
        opened = F.array(*[F.lit(o) for o in open_end])
        return F.transform(
            F.slice("__s", start + 1, m),
            lambda v, i: F.when(whole | F.get(opened, i), F.lit(infinite)).otherwise(v),
        )

    frame = sketch.select(
        *groups, "__n",
        bracket(0, [p <= 0.0 for p in lows], -INF).alias("__lo"),
        bracket(m, [p >= 1.0 for p in highs], INF).alias("__hi"),
    )
    frame = narrowed(rows, cut_lineage(frame), groups, rising, max_groups, accuracy, bracket_values)
    joined = _on(rows, small(frame.select(*groups, "__lo", "__hi"), max_groups), groups)
    below_hi = count_below(F.col("__hi"), x, m)
    from_lo = count_below(F.col("__lo"), x, m, inclusive=True)
    cells = (
        joined.select(*groups, "__x", below_hi.alias("__seg"), from_lo.alias("__b"))
        .select(*groups, "__seg", F.when(F.col("__seg") < F.col("__b"), F.col("__x")).alias("__v"))
        .groupBy(*groups, "__seg", "__v").agg(F.count(F.lit(1)).alias("__c"))
    )
    cells = cut_lineage(cells)
    per_seg = cells.groupBy(*groups, "__seg").agg(F.sum("__c").alias("__t"))
    prior = W.partitionBy(*groups).orderBy("__seg").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_seg.select(*groups, "__seg", F.coalesce(F.sum("__t").over(prior), F.lit(0)).alias("__off"))
    inside = (
        W.partitionBy(*groups, "__seg").orderBy(F.col("__v").asc_nulls_first())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    ranked = (
        cells.withColumn("__cum", F.sum("__c").over(inside))
        .filter(F.col("__v").isNotNull())
        .join(small(offsets, max_groups * (m + 1)), [*groups, "__seg"])
        .select(
            *groups, "__v",
            (F.col("__off") + F.col("__cum") - F.col("__c")).alias("__before"),
            (F.col("__off") + F.col("__cum")).alias("__upto"),
        )
    )
    # Wanted one-based ranks: the two neighbours of every interpolated position.
    asked = F.array(*[F.lit(p) for p in rising])
    below = F.transform(asked, lambda p: F.floor((F.col("__n") - 1) * p) + 1)
    wanted = frame.select(
        *groups,
        F.sort_array(F.array_distinct(F.concat(
            below, F.transform(below, lambda k: F.least(k + 1, F.col("__n")))
        ))).alias("__ks"),
    )
    first = count_below(F.col("__ks"), F.col("__before"), 2 * m, inclusive=True)
    stop = count_below(F.col("__ks"), F.col("__upto"), 2 * m, inclusive=True)
    found = (
        _on(ranked, small(wanted, max_groups), groups)
        .select(*groups, "__v", "__ks", first.alias("__i"), stop.alias("__j"))
        .filter(F.col("__i") < F.col("__j"))
        .select(*groups, "__v", F.explode(F.slice("__ks", F.col("__i") + 1, F.col("__j") - F.col("__i"))).alias("__k"))
    )
    by_rank = found.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("__k", "__v"))).alias("__at"))
    numbers = F.array(*[F.lit(o) for o in order])
    position = (F.col("__n") - 1) * F.col("prob")
    targets = (
        frame.select(*groups, "__n", F.posexplode(asked).alias("__i", "prob"))
        .select(
            *groups, F.get(numbers, F.col("__i")).alias("prob_no"), "prob",
            (F.floor(position) + 1).alias("__l"),
            F.least(F.floor(position) + 2, F.col("__n")).alias("__r"),
            (position - F.floor(position)).alias("__f"),
        )
    )
    ends = _on(targets, small(by_rank, max_groups), groups)

    def at(rank: str):
        hit = F.try_element_at(F.col("__at"), F.col(rank))
        return F.coalesce(hit, F.raise_error(F.lit("order statistic outside its bracket")).cast("double"))

    lo_v, hi_v = at("__l"), at("__r")
    return ends.select(
        *groups, "prob_no", "prob",
        (lo_v + (hi_v - lo_v) * F.col("__f")).alias("quantile"),
    )


def _on(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> DataFrame:
    return left.join(right, list(groups)) if groups else left.crossJoin(right)


def quantile_arrays(
    df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (), max_groups: int = 10_000,
) -> DataFrame:
    """``(*groups, quantiles)``: one array per group in the order of ``probs``."""
    long = exact_quantiles(df, value, probs, groups, max_groups)
    pairs = F.array_sort(F.collect_list(F.struct("prob_no", "quantile")))
    return long.groupBy(*groups).agg(F.transform(pairs, lambda p: p["quantile"]).alias("quantiles"))
