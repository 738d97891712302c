"""Preparation: cuts, split, class labels, caps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.cuts import apply_cuts, cut_predicate
from evenkeel.functions.keys import shuffled
from evenkeel.operators.binning import full_grid
from evenkeel.operators.labels import ClassDef
from evenkeel.operators.ranking import first_n
from evenkeel.session import small

TRAIN_SPLIT, VALIDATION_SPLIT, TEST_SPLIT = "train", "validation", "test"


def split_cuts(column: str, modulus: int = 10) -> dict[str, list[dict]]:
    """Modulo cuts of the three splits: the last two remainders validate and test."""
    mod = f"mod_{modulus}_"
    return {
        TRAIN_SPLIT: [{column: {"operator": f"{mod}<=", "condition": modulus - 3}}],
        VALIDATION_SPLIT: [{column: {"operator": f"{mod}==", "condition": modulus - 2}}],
        TEST_SPLIT: [{column: {"operator": f"{mod}==", "condition": modulus - 1}}],
    }


def tag_split(df: DataFrame, column: str, modulus: int = 10, name: str = "split") -> DataFrame:
    """Name the split of every row, so that one pass serves all three."""
    tag = F.lit(None).cast("string")
    for split, cuts in split_cuts(column, modulus).items():
        tag = F.when(cut_predicate(cuts, df.schema), split).otherwise(tag)
    return df.withColumn(name, tag)


@dataclass(frozen=True)
class Sample:
    """A sample to extract: its cuts, its class (None: all classes) and an optional size."""

    name: str
    origin: str
    cls: ClassDef | None = None
    cuts: Sequence = field(default_factory=tuple)
    n_rows: int | None = None
    shuffle_seed: int = 42


def extract_sample(df: DataFrame, sample: Sample, key: str = "row_key", origin: str = "origin") -> DataFrame:
    """Rows of the sample's origin that pass its own and its class's cuts, capped at random."""
    cuts = [list(sample.cuts), list(sample.cls.cuts) if sample.cls else None]
    kept = apply_cuts(df.filter(F.col(origin) == sample.origin), cuts)
    if sample.n_rows is None:
        return kept
    hashed = kept.withColumn("_hash", shuffled(F.col(key), sample.shuffle_seed))
    return first_n(hashed, sample.n_rows, "_hash").drop("_hash")


def requested_plan(tagged: DataFrame, requested: Mapping[str, int], origins: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """``(step, origin, class, requested, available)`` for every planned sample, found in one pass."""
    counts = tagged.groupBy(F.col("split").alias("step"), "origin", "class").agg(F.count(F.lit(1)).alias("available"))
    plan = full_grid(tagged.sparkSession, {"step": list(requested), "origin": origins, "class": classes}, 1).drop("bin")
    wanted = F.create_map(*[F.lit(x) for pair in requested.items() for x in pair])
    return (
        plan.join(small(counts, len(requested) * len(origins) * len(classes)), ["step", "origin", "class"], "left")
        .na.fill(0, ["available"])
        .withColumn("requested", F.element_at(wanted, F.col("step")).cast("bigint"))
    )
