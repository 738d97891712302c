"""Selections, ranks and running sums in hash order without a single global sort task.

Selections find one hash threshold per group and then only filter. For ranks and sums
a hash order is split into ordered ranges by its leading digits: counts or sums per range
give every range its offset, and windows run only inside a range. The number of digits
follows the counted rows of the fullest range, so that a range holds ``RANGE_ROWS`` rows
at most, whatever a group holds (windows name it before the groups, as it tells more rows apart); offsets of many ranges are summed by leading digits in turn, so no
window over ranges is longer than ``16**OFFSET_DIGITS`` either. Counting the rows runs when
the function is called.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.functions.keys import RANGE_DIGITS, hash_range
from evenkeel.session import BROADCAST_ROWS, cut_lineage, small

_RANGE = "__range"
# Rows of a range, the digits that may split it, and those whose ranges one window adds up.
RANGE_ROWS = 500_000
MOST_DIGITS = 16
OFFSET_DIGITS = 4


def range_totals(
    keyed: DataFrame, groups: Sequence[str], hashed: str, amount: Column, range_rows: int | None = None, least: int = RANGE_DIGITS,
) -> tuple[DataFrame, int]:
    """``(*groups, range, rows, total of amount)`` and the digits of the ranges.

    One scan is enough unless some range turns out to hold more than ``range_rows`` rows; then one more
    with as many digits as evenly spread hashes need, and so on for others, up to ``MOST_DIGITS``.
    """
    limit, digits = range_rows or RANGE_ROWS, least
    while True:
        ranged = keyed.groupBy(*groups, hash_range(F.col(hashed), digits).alias(_RANGE))
        found = cut_lineage(ranged.agg(F.count(F.lit(1)).alias("__n"), F.sum(amount).alias("__s")))
        worst = found.agg(F.max("__n")).first()[0] or 0
        if worst <= limit or digits >= MOST_DIGITS:
            return found, digits
        more = 1
        while worst > limit * 16**more:
            more += 1
        digits = min(MOST_DIGITS, digits + more)


def range_offsets(totals: DataFrame, groups: Sequence[str], digits: int, step: int | None = None) -> DataFrame:
    """``(*groups, range, own sum, offset)``: what a range and what the ranges before it add up to.

    Ranges are summed within their leading digits, and the leading digits in the same way.
    """
    step = step or OFFSET_DIGITS
    head = max(digits - step, 0)
    lead = F.substring(_RANGE, 1, head) if head else F.lit("")
    before = W.partitionBy(*groups, "__lead").orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    led = totals.withColumn("__lead", lead)
    own = led.select(*groups, _RANGE, "__lead", "__s", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__offset"))
    if not head:
        return own.drop("__lead")
    upper = led.groupBy(*groups, F.col("__lead").alias(_RANGE)).agg(F.sum("__s").alias("__s"))
    upper = range_offsets(upper, groups, head, step).select(*groups, F.col(_RANGE).alias("__lead"), F.col("__offset").alias("__base"))
    return own.join(upper, [*groups, "__lead"]).select(*groups, _RANGE, "__s", (F.col("__offset") + F.col("__base")).alias("__offset"))


def smallest_thresholds(
    df: DataFrame, groups: Sequence[str], limits: DataFrame, max_groups: int,
    hashed: str = "_hash", counts: DataFrame | None = None, sigmas: float = 8.0,
) -> DataFrame:
    """Per group, the hash up to which rows belong to the ``limit`` smallest.

    ``limits`` holds ``(*groups, limit)``, ``counts`` the group sizes ``(*groups, n)`` if
    already known. The result is ``(*groups, limit, threshold)``; a NULL threshold means
    the whole group fits.

    Hashes are spread evenly, so the k-th of n lies close to the share k / n. One scan
    counts what is below a narrow bracket around that share and keeps the hashes inside
    it, about ``2 * sigmas * sqrt(n)`` per group. The rank found there is exact; a group
    whose rank is not in its bracket sends all groups through the range counts instead.
    """
    groups = list(groups)
    if counts is None:
        counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    sized = _join(limits.select(*groups, "limit"), small(counts.select(*groups, "n"), max_groups), groups)
    cut_off = (F.col("limit") > 0) & (F.col("limit") < F.col("n"))
    partial = sized.filter(cut_off)
    share = F.col("limit") / F.col("n")
    margin = F.lit(sigmas) * (F.sqrt(share * (1.0 - share) / F.col("n")) + 1.0 / F.col("n")) if sigmas else F.lit(0.0)
    bounds = partial.select(*groups, _digits(share - margin).alias("__lo"), _digits(share + margin).alias("__hi"))
    own = F.col(hashed)
    cells = (
        _join(df.select(*groups, hashed), small(bounds, max_groups), groups).filter(own < F.col("__hi"))
        .groupBy(*groups, F.when(own >= F.col("__lo"), own).alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    )
    upto = W.partitionBy(*groups).orderBy(F.col("__at").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = cells.withColumn("__upto", F.sum("__n").over(upto)).filter(F.col("__at").isNotNull())
    found = _join(ranked, small(partial, max_groups), groups).filter(F.col("__upto") == F.col("limit"))
    out = cut_lineage(_join(sized, small(found.select(*groups, F.col("__at").alias("threshold")), max_groups), groups, how="left"))
    if out.filter(cut_off & F.col("threshold").isNull()).head(1):
        found = _thresholds_by_range(df, groups, partial, max_groups, hashed)
        out = cut_lineage(_join(sized, small(found, max_groups), groups, how="left"))
    return out.drop("n")


def _digits(share: Column) -> Column:
    """A share of the hash space as eight leading hex digits (``g`` beyond its end)."""
    scaled = F.floor(F.greatest(share, F.lit(0.0)) * F.lit(float(16**8))).cast("bigint")
    return F.when(share >= 1.0, F.lit("g")).otherwise(F.lpad(F.lower(F.hex(scaled)), 8, "0"))


def _thresholds_by_range(
    df: DataFrame, groups: Sequence[str], limits: DataFrame, max_groups: int, hashed: str, digits: int = RANGE_DIGITS,
) -> DataFrame:
    """``(*groups, threshold)`` found by counting hash ranges and sorting one range per group."""
    keyed = df.select(*groups, hashed).withColumn(_RANGE, hash_range(F.col(hashed), digits))
    counts = keyed.groupBy(*groups, _RANGE).agg(F.count(F.lit(1)).alias("__n"))
    upto = W.partitionBy(*groups).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = _join(counts.withColumn("__upto", F.sum("__n").over(upto)), small(limits, max_groups), groups)
    edge = running.filter(
        (F.col("__upto") >= F.col("limit")) & (F.col("__upto") - F.col("__n") < F.col("limit"))
    ).select(*groups, _RANGE, (F.col("limit") - F.col("__upto") + F.col("__n")).alias("__need"))
    order = W.partitionBy(*groups, _RANGE).orderBy(hashed)
    in_edge = keyed.join(small(edge, max_groups), [*groups, _RANGE]).withColumns(
        {"__rn": F.row_number().over(order), "__next": F.lead(hashed).over(order)})
    # a threshold that the next row shares would take more rows than asked
    own = F.when(F.col("__next") == F.col(hashed), F.raise_error(F.lit("rows share a hash: their keys are not unique")).cast("string")).otherwise(F.col(hashed))
    return in_edge.filter(F.col("__rn") == F.col("__need")).select(*groups, own.alias("threshold"))


def _join(left: DataFrame, right: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, list(groups), how) if groups else left.join(right, how=how, on=F.lit(True))


def keep_smallest(
    df: DataFrame, groups: Sequence[str], limits: DataFrame, max_groups: int,
    hashed: str = "_hash",
) -> DataFrame:
    """The ``limit`` rows of every group that come first in hash order.

    Hashes must be unique within a group: rows that share the hash at the limit are an error. Groups without a limit are dropped.
    """
    return below_thresholds(df, groups, smallest_thresholds(df, groups, limits, max_groups, hashed), max_groups, hashed)


def below_thresholds(
    df: DataFrame, groups: Sequence[str], thresholds: DataFrame, max_groups: int, hashed: str = "_hash",
) -> DataFrame:
    """Rows up to their group's threshold: a filter against a small table, no shuffle of rows."""
    kept = _join(df, small(thresholds.withColumnRenamed("limit", "__limit"), max_groups), groups)
    return kept.filter(
        (F.col("__limit") > 0) & (F.col("threshold").isNull() | (F.col(hashed) <= F.col("threshold")))
    ).drop("__limit", "threshold")


def first_n(df: DataFrame, n: int, hashed: str) -> DataFrame:
    """The first ``n`` rows in hash order."""
    limits = df.sparkSession.range(1).select(F.lit(int(n)).cast("bigint").alias("limit"))
    return keep_smallest(df, [], limits, 1, hashed)


def capped_rows(df: DataFrame, n: int, hashed: str) -> DataFrame:
    """The first ``n`` rows in hash order with ``requested`` and ``available``; a warning if there are fewer."""
    counts = cut_lineage(df.agg(F.count(F.lit(1)).alias("n")))
    available = counts.first()[0]
    if available < n:
        warnings.warn(f"{n} rows were asked for, {available} are available", stacklevel=2)
    limits = df.sparkSession.range(1).select(F.lit(int(n)).cast("bigint").alias("limit"))
    thresholds = smallest_thresholds(df, [], limits, 1, hashed, counts)
    return below_thresholds(df, [], thresholds, 1, hashed).withColumns(
        {"requested": F.lit(n).cast("bigint"), "available": F.lit(available).cast("bigint")})


def running_sum(
    df: DataFrame, groups: Sequence[str], amount: Column, name: str, max_groups: int,
    hashed: str = "_hash", range_rows: int | None = None,
) -> DataFrame:
    """Inclusive running sum of an integer ``amount`` in hash order within groups.

    Hashes must be spread evenly and, for a repeatable result, be unique within a group.
    """
    groups = list(groups)
    totals, digits = range_totals(df, groups, hashed, amount, range_rows)
    offsets = range_offsets(totals, groups, digits).drop("__s")
    inside = W.partitionBy(_RANGE, *groups).orderBy(hashed).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        df.withColumn(_RANGE, hash_range(F.col(hashed), digits)).withColumn("__inside", F.sum(amount).over(inside))
        .join(_if_small(offsets, max_groups, digits), [*groups, _RANGE])
        .withColumn(name, F.col("__offset") + F.col("__inside"))
        .drop(_RANGE, "__inside", "__offset")
    )


def running_sum_in(
    df: DataFrame, groups: Sequence[str], amount: Column, name: str, wanted: Callable[[DataFrame], DataFrame], most: int,
    hashed: str = "_hash", range_rows: int | None = None, least: int = RANGE_DIGITS,
) -> DataFrame:
    """``running_sum`` for the rows of some ranges alone: all others are counted, but neither shuffled nor sorted.

    ``wanted`` filters ``(*groups, __range, __s, __offset)``, a range's own sum and that of the ranges before it, to
    ``most`` ranges at most.
    """
    groups = list(groups)
    totals, digits = range_totals(df, groups, hashed, amount, range_rows, least)
    kept = wanted(range_offsets(totals, groups, digits)).select(*groups, _RANGE, "__offset")
    inside = W.partitionBy(_RANGE, *groups).orderBy(hashed).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        df.withColumn(_RANGE, hash_range(F.col(hashed), digits)).join(small(kept, most), [*groups, _RANGE])
        .withColumn(name, F.col("__offset") + F.sum(amount).over(inside)).drop(_RANGE, "__offset")
    )


def sparse_digits(rows: int, groups: int, marks: int) -> int:
    """Digits that make ranges so short that few of them hold one of ``marks`` per group, but hold some rows each."""
    digits = RANGE_DIGITS
    while 16**digits < 8 * marks < rows and rows >= 4 * groups * 16 ** (digits + 1):
        digits += 1
    return digits


def global_rank(
    df: DataFrame, name: str = "rank_no", hashed: str = "_hash",
    groups: Sequence[str] = (), max_groups: int = 1, range_rows: int | None = None,
) -> DataFrame:
    """One-based position in hash order, over all rows or within groups."""
    return running_sum(df, groups, F.lit(1).cast("bigint"), name, max_groups, hashed, range_rows)


def _if_small(offsets: DataFrame, max_groups: int, digits: int) -> DataFrame:
    """Offsets for a broadcast join where they are few; else they meet the rows, dealt by group and range already."""
    bound = max_groups * 16**digits
    return small(offsets, bound) if bound <= BROADCAST_ROWS else offsets.hint("merge")
