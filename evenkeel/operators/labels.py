"""Class definitions and class labelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.cuts import cut_predicate


@dataclass(frozen=True)
class ClassDef:
    """A class: its name, the cuts that select it and its probability suffix."""

    name: str
    cuts: tuple = field(default_factory=tuple)
    suffix: str = ""

    def predicate(self, schema=None) -> Column:
        return cut_predicate(self.cuts, schema)


def class_number(classes: Sequence[ClassDef], schema=None) -> Column:
    """Position of the last class in the list that matches; NULL when none does."""
    number = F.lit(None).cast("int")
    for i, cls in enumerate(classes):
        number = F.when(cls.predicate(schema), F.lit(i)).otherwise(number)
    return number


def label_classes(df: DataFrame, classes: Sequence[ClassDef], keep_unlabelled: bool = False) -> DataFrame:
    """Add ``label`` and ``class``; rows of no class are dropped."""
    names = F.array(*[F.lit(c.name) for c in classes])
    number = class_number(classes, df.schema)
    if keep_unlabelled:
        return df.withColumn("label", number).withColumn("class", F.get(names, F.col("label")))
    # columns that are never NULL save null checks wherever they become join keys
    out = df.withColumn("label", F.coalesce(number, F.lit(-1))).filter(F.col("label") >= 0)
    return out.withColumn("class", F.coalesce(F.get(names, F.col("label")), F.lit("")))


def label_columns(classes: Sequence[ClassDef]) -> list[str]:
    """Columns the class definitions read, in first-use order."""
    return list(dict.fromkeys(name for c in classes for cut in c.cuts for name in cut))


def suffixes(classes: Sequence[ClassDef]) -> dict[str, str]:
    """Class name to probability suffix."""
    return {c.name: c.suffix for c in classes}


def probability_names(classes: Sequence[ClassDef], classifiers: Sequence[str]) -> list[str]:
    """Probability column names of every classifier, in class order."""
    return [f"{t}_{c.suffix}" for t in classifiers for c in classes]


def label_agreement(a: DataFrame, b: DataFrame, key: str, label: str = "label") -> DataFrame:
    """``(n, n_different, n_missing)``: keys whose two labels differ, and keys that only one side has."""
    left = a.select(key, F.col(label).alias("__a"), F.lit(True).alias("__in_a"))
    right = b.select(key, F.col(label).alias("__b"), F.lit(True).alias("__in_b"))
    both = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()
    return left.join(right, key, "full").agg(
        F.count(F.when(both, 1)).alias("n"), F.count(F.when(both & ~F.col("__a").eqNullSafe(F.col("__b")), 1)).alias("n_different"),
        F.count(F.when(~both, 1)).alias("n_missing"))


def rows_per_class(df: DataFrame, keys: Sequence[str] = ("class",)) -> DataFrame:
    """Row counts per class (and further keys)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def classes_per_origin(df: DataFrame, origin: str = "origin", cls: str = "class") -> DataFrame:
    """Sorted classes every origin offers, and whether all origins agree."""
    per = (
        df.select(origin, cls).distinct()
        .groupBy(origin).agg(F.array_join(F.sort_array(F.collect_list(cls)), ",").alias("classes"))
    )
    verdict = per.agg((F.count_distinct("classes") == 1).alias("consistent"))
    return per.crossJoin(F.broadcast(verdict))


def select_features(columns: Sequence[str], excluded: Sequence[str], groups: Mapping[str, Sequence[str]] | None = None):
    """Split feature names into kept and excluded, with positions of the excluded ones.

    An excluded name may be a group, which stands for all its members.
    """
    gone = [m for e in excluded for m in (groups or {}).get(e, [e])]
    unknown = [g for g in gone if g not in columns]
    if unknown:
        raise KeyError(f"not a feature: {unknown}")
    kept = [c for c in columns if c not in gone]
    out = [c for c in columns if c in gone]
    return kept, out, [list(columns).index(c) for c in out]
