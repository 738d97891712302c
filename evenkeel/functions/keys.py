"""Row keys and the repeatable pseudo-random order derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading hex digits that split a hash order into 16**3 = 4096 ordered ranges.
RANGE_DIGITS = 3


def row_key(*parts: Column) -> Column:
    """md5 of the identifying columns; use integers, strings and dates only."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def shuffled(key: Column, seed: int | str) -> Column:
    """Position of a row in the random order of ``seed``: independent of partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key))


def turned(hashed: Column, step: int) -> Column:
    """An independent order from the same hash: its digits turned round by 10 per step.

    Unique where the hash is, and led by digits no earlier step was led by (three
    steps fit into the 32 digits of an md5).
    """
    if not 0 <= step <= 2:
        raise ValueError("one hash serves three steps")
    if step == 0:
        return hashed
    return F.concat(F.substring(hashed, 10 * step + 1, 32), F.substring(hashed, 1, 10 * step))


def hash_range(hashed: Column, digits: int = RANGE_DIGITS) -> Column:
    """The ordered range a hash falls into: its leading digits."""
    return F.substring(hashed, 1, digits)
