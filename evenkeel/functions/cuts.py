"""The declarative cut language, compiled to one filter expression.

A cut is ``{column: {"operator": op, "condition": value}}`` with ``op`` one of
``== != > >= < <=`` or ``mod_N_<op>`` (remainder by N, then compare). Cuts state
what *removes* a row, so a missing value passes every comparison except ``==``;
``"NaNcheck": True`` lets it pass that one as well.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPERATORS = ("==", "!=", ">", ">=", "<", "<=")


def _compare(x: Column, op: str, value) -> Column:
    return {
        "==": x == value, "!=": x != value,
        ">": x > value, ">=": x >= value,
        "<": x < value, "<=": x <= value,
    }[op]


def _flatten(entries) -> Iterable[dict]:
    for entry in entries:
        if isinstance(entry, (list, tuple)):
            yield from _flatten(entry)
        elif entry is not None:
            yield entry


def _with_missing(x: Column, cond: Column, floating: bool) -> Column:
    """Let missing values through.

    Spark ranks NaN above every number, but column statistics may not count it, so a
    bare ``x > c`` could skip a whole block that holds NaN. The explicit test keeps
    such a comparison from being answered by statistics.
    """
    return x.isNull() | F.isnan(x) | cond if floating else x.isNull() | cond


def one_cut(entry: dict, floating: bool = True, complete: bool = False) -> Column:
    """The predicate for a single cut entry; ``complete`` columns hold no missing values."""
    if len(entry) != 1:
        raise KeyError("a cut entry holds exactly one column")
    (name, spec), = entry.items()
    op, value = spec["operator"], spec["condition"]
    x = F.col(name)
    if op.startswith("mod_"):
        found = re.fullmatch(r"mod_(\d+)_(==|!=|>=|<=|>|<)", op)
        if not found:
            raise RuntimeError(f"modulo cut {op!r} is not of the form mod_N_op")
        rest = F.pmod(x, F.lit(int(found[1])))
        kept = _compare(rest, found[2], value)
        return kept if found[2] == "==" else _with_missing(rest, kept, floating)
    if op not in OPERATORS:
        raise KeyError(f"operator {op!r} is not one of {OPERATORS}")
    if complete and not isinstance(value, (list, tuple)):
        return _compare(x, op, float(value) if floating else value)
    if isinstance(value, (list, tuple)):
        if op == "==":
            return F.coalesce(x.isin(list(value)), F.lit(False))
        if op == "!=":
            return _with_missing(x, ~x.isin(list(value)), floating)
        return reduce(lambda a, b: a | b, [_with_missing(x, _compare(x, op, v), floating) for v in value])
    kept = _compare(x, op, float(value) if floating else value)
    if op == "==":
        if not spec.get("NaNcheck", False):
            return kept
        return _with_missing(x, kept, floating)
    return _with_missing(x, kept, floating)


def cut_predicate(cuts: Sequence, schema: T.StructType | None = None, complete: Collection[str] = ()) -> Column:
    """All cuts of a (possibly nested) list joined by AND; None entries are skipped.

    With a schema, whole-number columns get plain comparisons, which the Parquet
    reader can evaluate on row-group statistics; so do the columns named ``complete``,
    for which the caller vouches that no value is missing.
    """
    def floating(entry: dict) -> bool:
        if schema is None or len(entry) != 1:
            return True
        return isinstance(schema[next(iter(entry))].dataType, (T.FloatType, T.DoubleType))

    return reduce(lambda a, b: a & b, [one_cut(e, floating(e), next(iter(e)) in complete) for e in _flatten(cuts)], F.lit(True))


def apply_cuts(df: DataFrame, cuts: Sequence, complete: Collection[str] = ()) -> DataFrame:
    """Rows that survive every cut."""
    return df.filter(cut_predicate(cuts, df.schema, complete))


def check_complete(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """``df`` itself, after one scan of ``columns`` that raises ValueError if any value is missing.

    For columns that cuts call complete: a missing value there would be dropped instead of kept.
    """
    floating = {c for c in columns if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))}
    missing = {c: F.col(c).isNull() | F.isnan(F.col(c)) if c in floating else F.col(c).isNull() for c in columns}
    counts = df.agg(*[F.count(F.when(m, 1)).alias(c) for c, m in missing.items()]).first().asDict()
    lacking = {c: n for c, n in counts.items() if n}
    if lacking:
        raise ValueError(f"missing values in columns named complete: {lacking}")
    return df


def category_cut(label_column: str, label_value, op: str = "==") -> list[dict]:
    """The cut list of a class given by one label column."""
    if isinstance(label_value, (list, tuple)) and op not in ("==", "!="):
        raise ValueError("a list of label values takes == or !=")
    return [{label_column: {"operator": op, "condition": label_value}}]


def text_predicate(text: str) -> Column:
    """A class predicate written as text, such as ``truth == 5`` or ``truth in [5, 54]``."""
    return F.expr(text.replace("[", "(").replace("]", ")"))
