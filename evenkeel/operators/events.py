"""Sampling and merging by event (a group of rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.keys import shuffled
from evenkeel.operators.ranking import first_n, global_rank
from evenkeel.session import cut_lineage, small


def rows_of_events(df: DataFrame, events: DataFrame, event: str = "event") -> DataFrame:
    """Rows whose event is in ``events``."""
    return df.join(events.select(event), event, "left_semi")


def distinct_events(df: DataFrame, event: str = "event") -> DataFrame:
    return df.select(event).distinct()


def event_summary(df: DataFrame, source: str = "source", event: str = "event") -> DataFrame:
    """``(source, n_events, n_rows)``."""
    per_event = df.groupBy(source, event).agg(F.count(F.lit(1)).alias("__n"))
    return per_event.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("__n").cast("bigint").alias("n_rows"))


def merge_events(a: DataFrame, b: DataFrame, ratio: float, event: str = "event", seed: int = 42) -> DataFrame:
    """All rows of ``a`` and the rows of ``len(events of a) / ratio`` random events of ``b``.

    Too few events in ``b`` is an error. The two event counts are the only values that
    reach the driver.
    """
    wanted = int(distinct_events(a, event).count() / ratio)
    events = cut_lineage(distinct_events(b, event))  # counted, then chosen from
    have = events.count()
    if wanted > have:
        raise ValueError(f"{wanted} events asked from a source that has {have}")
    hashed = events.withColumn("_hash", shuffled(F.col(event).cast("string"), seed))
    chosen = first_n(hashed, wanted, "_hash")
    return a.unionByName(rows_of_events(b, chosen, event))


def assign_files(df: DataFrame, n_files: int, groups: list[str], hashed: str, max_groups: int) -> DataFrame:
    """Add ``file_no`` 0..n-1: every group is split evenly, earlier files get one row more.

    Works on ranks, so one large source is spread over many tasks.
    """
    ranked = global_rank(df, "__rank", hashed, groups, max_groups)
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    sized = ranked.join(small(counts, max_groups), groups) if groups else ranked.crossJoin(F.broadcast(counts))  # one row
    base = F.floor(F.col("__n") / n_files)
    more = F.col("__n") % n_files
    at = F.col("__rank") - 1
    number = F.when(at < more * (base + 1), F.floor(at / (base + 1))).otherwise(
        more + F.floor((at - more * (base + 1)) / F.greatest(base, F.lit(1)))
    )
    return sized.withColumn("file_no", number.cast("int")).drop("__rank", "__n")
